import random

import numpy as np
import xxhash

from dcflow.llm import simhash as S


def brute_fp(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    sh = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    hs = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def brute_components(rows):
    """rows: (doc_id, fp) -> component_id per row."""
    n, root = len(rows), list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(n):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= 4:
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(find(i), []).append(d)
    return [min((x for x in least[find(i)] if x is not None), default=None) for i in range(n)]


def test_fingerprint_equals_brute_force():
    rnd = random.Random(1)
    cases = [None, "", " \n", "One", "a B c", "A b c D", "É Ü x y", "same same same same same same"]
    cases += [" ".join(rnd.choice(["Aa", "b", "çÇ", "d\te"]) for _ in range(rnd.randint(1, 60))) for _ in range(60)]
    for t in cases:
        assert S.fingerprint(t) == brute_fp(t), t
    long = " ".join(str(i) for i in range(3000))
    assert S.fingerprint(long, chunk=100) == brute_fp(long)


def planted(rnd, n):
    base = [rnd.getrandbits(64) for _ in range(n)]
    for b in base[: n // 3]:
        x = b
        for _ in range(rnd.randint(1, 6)):  # chains reach farther than one link
            for bit in rnd.sample(range(64), rnd.randint(0, 5)):
                x ^= 1 << bit
            base.append(x)
    return base


def test_links_span_the_brute_force_components(spark):
    rnd = random.Random(5)
    fps = sorted(set(planted(rnd, 300)) | {0, 1, 2**63, 2**64 - 1, 3 << 31})
    dense = rnd.getrandbits(64)
    fps = sorted({*fps, *(dense ^ (1 << a) ^ (1 << b) for a in range(30) for b in range(a))})
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r["fp"]: r["root"] for r in S.component_roots(df).collect()}
    want = brute_components(list(zip(range(len(fps)), fps)))
    groups = {}
    for f, w in zip(signed, want):
        groups.setdefault(w, set()).add(got[f])
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)
    edges = S.links(df, node_rows=8).collect()
    assert len(edges) < 6 * len(fps)  # a forest per group, not all pairs
    assert all(bin((r["a"] ^ r["b"]) & (2**64 - 1)).count("1") <= 4 for r in edges)


def test_near_duplicates_of_a_table(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(60):
        words = [rnd.choice("abcdefghij") + str(rnd.randint(0, 50)) for _ in range(rnd.randint(0, 80))]
        rows.append((i, " ".join(words)))
        if words and i % 3 == 0:
            words[rnd.randrange(len(words))] = "edited"
            rows.append((100 + i, " ".join(words).upper()))
    rows += [(None, rows[0][1]), (None, "only null"), (207, None), (208, ""), (209, rows[9][1]), (209, rows[9][1])]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, fp string")
    got = sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in S.near_duplicates(docs).collect()), key=str)
    comp = brute_components([(i, brute_fp(t)) for i, t in rows])
    assert got == sorted(((i, f"{brute_fp(t):016x}", c) for (i, t), c in zip(rows, comp)), key=str)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(set(comp), key=str)
    assert S.near_duplicates(docs.limit(0)).count() == 0
