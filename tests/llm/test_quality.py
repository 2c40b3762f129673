import random
import re

from dcflow.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    words = WORD.findall(t)
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    twice = {w for w in wins if wins.count(w) > 1}
    covered = {j for i, w in enumerate(wins) if w in twice for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n, rep = len(words), len(covered)
    return (n, sum(map(len, words)), sum(t.count(c) for c in "#*$%&|<>"),
            sum(x in lines[:i] for i, x in enumerate(lines)), rep, n < 50 or 100 * rep > 50 * n)


def texts():
    rnd = random.Random(3)
    out = [None, "", " \t\n\x0b\x0c\r ", "a", "a b", "a b c", "a b c a b c", "x y z " * 40, "é# ü* ß\n\né# ü* ß\n x",
           " lead\nlead\n lead\nlead", "a b \x85 c", "q " * 5000, "A!? 1 " * 20]
    for _ in range(40):
        out.append("".join(rnd.choice(["a", "b", "c", "d", "\n", " ", "\t", "#", "É", "𝄞"]) for _ in range(rnd.randint(0, 200))))
    return out


def test_base_statistics_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, q_n_words string, n_words int")
    got = {r["doc_id"]: tuple(r)[1:7] for r in Q.judge(docs, []).collect()}
    assert got == {i: brute(t) for i, t in rows}


def test_rules_reject_and_columns_pass_through(spark):
    good = " ".join(f"w{i}" for i in range(80))
    bad = " ".join(f"w{i}***" for i in range(80))
    docs = spark.createDataFrame([(i, good if i % 2 else bad, "clash") for i in range(200)] + [(None, good, "z")],
                                 "doc_id long, text string, q_kept string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 150)] + [(None, 1, 0), (3, None, None), (5, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rules = Q.learn_rules(docs, labels)
    assert rules
    kept = Q.keep_good(docs, rules)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, i) for i in range(1, 200, 2)] + [(True, 0)]
    assert Q.learn_rules(docs, labels.limit(0)) == []
    assert Q.judge(docs.limit(0), rules).count() == 0


def test_held_out_accuracy(spark):
    """Rules fitted on part of the labels agree with the others."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rules = Q.learn_rules(docs, labels.where("doc_id % 2 = 0"))
    held = Q.judge(docs, rules).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in held)
    assert right >= 0.95 * len(held)


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = Q.judge(docs, [Q.Rule((("symbol_ratio", ">", 0.0),))])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
