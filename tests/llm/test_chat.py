import random

from dcflow.llm import chat as C


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    seqs = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in convs.items()}
    key = lambda c: (c is None, c or 0)
    out = {}
    for c, s in seqs.items():
        if not any(len(o) > len(s) and o[:len(s)] == s for o in seqs.values()) and not any(o == s and key(d) < key(c) for d, o in seqs.items()):
            out[c] = (len(s), "".join(f"<|im_start|>{r}\n{x}<|im_end|>\n" for r, x in s))
    return out


def test_equals_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for c in range(150):
        base = random.Random(c % 20)
        turns = [(k, base.choice(["user", "assistant"]), base.choice("abc")) for k in range(8)][: rnd.randint(1, 8)]
        rows += [(c, *t) for t in turns]
    rows += [(200, 0, None, None), (201, 0, "", ""), (202, 5, "user", "x"), (202, 5, "user", "x"), (203, None, "user", "n"), (203, 1, "a", "b" * 50000),
             (None, 0, "user", "null id"), (None, 1, "user", "more")]
    rnd.shuffle(rows)
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, n_turns int")
    out = C.collapse(df)
    assert {r["conv_id"]: (r["n_turns"], r["text"]) for r in out.collect()} == brute(rows)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert C.collapse(df.limit(0)).count() == 0
