import hashlib
import random
import zlib

import pytest

from dcflow.llm import trie as T

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    seqs = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in convs.items()}
    out = {}
    for c in seqs:
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = seqs.get(c - c % 100, [])[:h] + seqs[c][h:]
    return out


def brute(convs):
    members = {}
    for c, s in convs.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        ks = kids.get(p, [])
        leaves[p] = 1 if not ks else sum(leaves[k] for k in ks)
        saved[p] = (len(members[p]) - 1) * len(p[-1][1] if p else "") + sum(saved[k] for k in ks)
    out = []
    for p, cs in members.items():
        ends = ",".join(map(str, sorted(c for c in cs if len(convs[c]) == len(p))))
        out.append((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(rnd, n, words, longest):
    rows = []
    for c in range(n):
        base = random.Random(c % 9)
        for k in range(rnd.randint(1, longest)):
            own = rnd.random() < 0.1
            rows.append((c, k, "user", (rnd if own else base).choice(words) * (k % 3 + 1)))
    return rows


@pytest.mark.parametrize("chunk,batch,runs", [(128, 512, 10_000), (4, 7, 3), (1, 2, 1)])
def test_equals_brute_force(spark, monkeypatch, chunk, batch, runs):
    rnd = random.Random(chunk)
    rows = rows_of(rnd, 240, ["a", "bé", "ccc"], 14)
    rows += [(300, 0, None, None), (300, 1, "", ""), (301, 5, "user", "x"), (301, 5, "user", "x"), (402, None, "user", "n"), (402, 1, "a", "b" * 50000),
             (None, 0, "user", "no id"), (None, 1, "user", "more"), (599, 0, "user", "short"), (600, 1, "z", "😀"), (600, 1, "z", "é")]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(5)
    out = run(spark, df, chunk, batch, runs)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=str) == brute(rebuilt(rows))


def run(spark, df, chunk=T.CHUNK, batch=T.BATCH, runs=T.RUN_IDS):
    return T.prefix_trie(*T.branched(df, 100, 6), chunk=chunk, batch=batch, run_ids=runs)


def test_one_long_conversation_and_copies(spark):
    rows = [(7, k, "user", f"turn {k}") for k in range(700)] + [(c, k, "user", f"turn {k}") for c in range(100, 160) for k in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = run(spark, df)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in out.collect()), key=str) == brute(rebuilt(rows))


def test_empty_table(spark):
    assert run(spark, spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


@pytest.mark.parametrize("fan", [1, 3, 4, 5, 16, 17, 48, 49, 200, 256])
def test_nodes_grow(fan):
    rnd = random.Random(fan)
    first = rnd.sample(range(256), fan)
    keys = [bytes([1, 2, 3, b]) + bytes(rnd.randrange(256) for _ in range(12)) for b in first]
    root = T.Node(b"")
    for i, k in enumerate(keys):
        T.insert(root, k, i)
    found = []

    def walk(node, so_far):
        for b in range(256):
            kid = node.child(b)
            if kid:
                walk(kid, so_far + bytes([b]) + kid.skip)
        if node.row >= 0:
            found.append((so_far, node.row))

    walk(root, b"")
    assert sorted(found) == sorted((k, i) for i, k in enumerate(keys))
    below = root.child(1)
    assert (below.room if fan > 1 else 0) == (0 if fan == 1 else 4 if fan <= 4 else 16 if fan <= 16 else 48 if fan <= 48 else 256)
    if fan > 1:
        assert below.skip == bytes([2, 3]) and [n.row for n in below.children()] == [first.index(b) for b in sorted(first)]
