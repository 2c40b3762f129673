import random

from dcflow.llm import linededup as L


def brute(rows, min_words):
    """rows: (doc_id, text) in document order -> the text left of each."""
    seqs = []
    for d, t in rows:
        lines = (t or "").split("\n")
        seqs.append([(p, x) for p, x in enumerate(lines) if x.strip(" \t\n\x0b\x0c\r")])
    seen, gone = set(), [set() for _ in rows]
    for k, seq in enumerate(seqs):  # every run, of any length, at every place, in order
        for a in range(len(seq)):
            for b in range(a + 1, len(seq) + 1):
                run = tuple(x for _, x in seq[a:b])
                if sum(len(x.split()) for x in run) >= min_words and run in seen:
                    gone[k] |= {p for p, _ in seq[a:b]}
                seen.add(run)
    return [t if not g else "\n".join(x for p, x in enumerate(t.split("\n")) if p not in g) for (_, t), g in zip(rows, gone)]


def test_equals_brute_force(spark):
    rnd = random.Random(11)
    pool = ["a b c", "d e", "f", "g h i j", "k l", "m n o p q r s", "t u"]
    rows = [(None, "a b c\nd e\nf\nzz"), (1, None), (2, ""), (3, "\n\n"), (4, "f\nf\nf\nf\nf\nf\nf\nf\nf")]
    for i in range(5, 40):
        rows.append((i, "\n".join(rnd.choice([*pool, "", f"only {i}"]) for _ in range(rnd.randint(1, 14)))))
    rows += [(40, rows[9][1]), (41, rows[9][1])]
    docs = spark.createDataFrame([(i, t, "clash", 5) for i, t in rows], "doc_id long, text string, l_gone string, n_chars int")
    for min_words in (1, 4, 7, 12):
        out, p = L.dedup_lines(docs, min_words)
        got = {r["doc_id"]: r["text"] for r in out.collect()}
        assert got == dict(zip([i for i, _ in rows], brute(rows, min_words))), min_words


def test_stage_drops_emptied_documents_only(spark):
    passage = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame([(1, f"own one\n{passage}\nend", 0), (2, passage, 0), (3, f"{passage}\nkept", 0), (4, "", 0), (5, None, 7)],
                                 "doc_id long, text string, n_chars int")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in L.drop_later_copies(docs).collect()}
    assert got == {1: (f"own one\n{passage}\nend", 0), 3: ("kept", 4), 4: ("", 0), 5: (None, 7)}
    assert L.drop_later_copies(docs).columns == docs.columns
    assert L.drop_later_copies(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out, _ = L.dedup_lines(docs)
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
