import random

import numpy as np

from dcflow.llm import decontam as D


def brute_sw(a, b):
    h = [[0.0] * (len(a) + 1) for _ in range(len(b) + 1)]
    for i, y in enumerate(b, 1):
        for j, x in enumerate(a, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (1 if x == y else -0.5), h[i - 1][j] - 0.5, h[i][j - 1] - 0.5)
    return max(map(max, h))


def test_alignment_equals_brute_force():
    rnd = np.random.default_rng(3)
    na, nb = rnd.integers(1, 30, 80), rnd.integers(1, 12, 80)
    a, b = rnd.integers(1, 5, (80, 30)).astype(np.uint64), rnd.integers(1, 5, (80, 12)).astype(np.uint64)
    got = D.smith_waterman(a, na, b, nb)
    assert got.tolist() == [brute_sw(x[:n], y[:m]) for x, n, y, m in zip(a, na, b, nb)]


def test_edited_copies_are_found_and_clean_texts_left(spark):
    rnd = random.Random(8)
    word = lambda: rnd.choice(["the", "of", "and", "to", "in"]) if rnd.random() < .4 else "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(rnd.randint(20, 50))) for i in range(20)] + [(50, None), (51, ""), (52, "the of"), (53, "the of and"), (None, text(30)), (3, text(40))]
    docs, want = [], set()
    for i in range(200):
        t = text(rnd.randint(0, 300))
        if i % 4 == 0:
            k, item = rnd.choice([x for x in items if x[1] and len(x[1].split()) > 10])
            words = item.split()
            for at in rnd.sample(range(len(words)), len(words) // 8):
                words[at] = "edited"
            if i % 8 == 0:
                words.insert(len(words) // 2, "added")
            t += " " + " ".join(words).upper().replace(" ", ", ") + ". " + text(40)
            want.add((i, k))
        docs.append((i, t))
    docs += [(900, None), (901, ""), (None, items[0][1]), (902, items[1][1]), (902, items[1][1])] + [(1000 + i, items[2][1] + " " + text(20)) for i in range(150)]
    want |= {(None, 0), (902, 1)} | {(1000 + i, 2) for i in range(150)}
    df = spark.createDataFrame([(*x, "clash") for x in docs], "doc_id long, text string, words string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(df, bench).collect()}
    assert got == want
    kept = D.drop_contaminated(df, bench)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, _ in docs} - {i for i, _ in want}
    assert D.contaminated(df.limit(0), bench).count() == D.contaminated(df, bench.limit(0)).count() == 0


def test_seeds_of_any_frequency_find_copies(spark):
    """An item often quoted in half: the quotes reach the threshold by frequent seeds alone."""
    item = [f"item{k}" for k in range(40)]
    docs = [(i, f"doc{i} says " + " ".join(item[:20]) + f" and{i} more") for i in range(60)]
    docs += [(100 + i, " ".join([f"doc{i}", *item])) for i in range(10)] + [(200, " ".join(item[:19])), (201, " ".join(item[:3]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r["doc_id"]: r["score"] for r in D.contaminated(df, bench).collect()}
    assert got == {i: 20.0 for i in range(60)} | {100 + i: 40.0 for i in range(10)}


def test_a_phrase_on_both_sides_makes_no_pairs(spark):
    """400 documents and 400 items share one phrase and nothing else: no window is aligned."""
    word = lambda who, i, k: f"{who}{i}x{k}"
    docs = [(i, " ".join([*(word("d", i, k) for k in range(20)), "the shared phrase", *(word("d", i, k) for k in range(20, 40))])) for i in range(400)]
    items = [(i, " ".join([*(word("q", i, k) for k in range(9)), "the shared phrase", *(word("q", i, k) for k in range(9, 18))])) for i in range(400)]
    docs += [(1000 + i, items[i][1] + " and more") for i in range(3)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found_items = D.staged(D.item_words(bench), "t-items")
    seeds = D.staged(D.item_seeds(found_items, 3), "t-seeds")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = D.staged(D.passages(df, [(0, D.key_bitmap(seeds.select("seed"), seeds.count()), 42)], 3), "t-passages")
    windows = D.windows_of(found, found_items, seeds, {0: 42}, D.THRESHOLD, D.LEAST_WORDS)
    assert windows.select("pid", "iid").distinct().count() == 3
    assert sorted((r["doc_id"], r["item_id"], r["score"]) for r in D.contaminated(df, bench).collect()) == [(1000 + i, i, 21.0) for i in range(3)]


def test_common_seeds_lose_nothing(spark):
    """The join with a rare word finds what joining every seed directly finds."""
    rnd = random.Random(17)
    words = [f"w{k}" for k in range(5)]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(5, 60)))) for i in range(60)]
    items = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(3, 14)))) for i in range(40)] + [(99, " ".join(rnd.choice(words) for _ in range(90)))]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    results = []
    for few in (0, 10**9):
        results.append(sorted((r["doc_id"], r["item_id"], r["score"]) for r in D.contaminated(df, bench, few=few).collect()))
    assert results[0] == results[1] and len(results[0]) > 20


def test_recall_against_aligning_every_pair(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    memo = D._Hashes()
    texts = [(r["doc_id"], D.word_hashes([r["text"]], memo)[0]) for r in docs.collect()]
    want = set()
    for r in bench.collect():
        item = D.word_hashes([r["text"]], memo)[0]
        if not len(item):
            continue
        for lo in range(0, len(texts), 40):
            part = texts[lo:lo + 40]
            n = np.array([len(w) for _, w in part])
            a = np.zeros((len(part), max(1, n.max())), np.uint64)
            for k, (_, w) in enumerate(part):
                a[k, :len(w)] = w
            score = D.smith_waterman(a, n, np.tile(item, (len(part), 1)), np.full(len(part), len(item)))
            want |= {(d, r["item_id"]) for (d, _), s in zip(part, score) if s >= D.THRESHOLD * max(len(item), D.LEAST_WORDS)}
    got = {(r["doc_id"], r["item_id"]) for r in D.contaminated(docs, bench).collect()}
    assert got <= want and len(got) >= 0.9 * len(want) and want, (len(got), len(want))


def test_a_long_item_does_not_widen_the_others(spark):
    long = " ".join(f"long{k}" for k in range(3000))
    short = " ".join(f"short{k}" for k in range(20))
    docs = [(1, "x " * 500 + short + " y" * 500), (2, "a " * 100 + long[:12000] + " b"), (3, " ".join(long.split()[:1600])), (4, " ".join(long.split()[:1400]))]
    bench = spark.createDataFrame([(1, long), (2, short)], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in D.contaminated(df, bench).collect()} == {(1, 2), (3, 1)}
    items = D.staged(D.item_words(bench), "t-items")
    assert {r["cls"] for r in D.item_seeds(items, 3).select("cls").distinct().collect()} == {0, 3}
