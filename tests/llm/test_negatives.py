import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dcflow.llm import negatives as N


def brute(rows, every, scale=256):
    ok = [(i, lab, [math.floor(scale * x) for x in v]) for i, v, lab in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, lab, v in ok:
        if i % every:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in ok if j != i and len(w) == len(v)))
        for s, p, _ in [x for x in scored if x[2] == lab][:5]:
            fit = [(n, j) for n, j, m in scored if m != lab and 50 * -s <= 100 * -n <= 95 * -s]
            out += [(i, p, r + 1, j, -s, -n) for r, (n, j) in enumerate(fit[:3])]
    return sorted(out)


def vectors(rnd, n, dims, labels, scale=1.0):
    centres = [rnd.normal(size=dims) for _ in range(labels)]
    rows = []
    for i in range(n):
        lab = int(rnd.integers(labels))
        v = centres[lab] * 0.7 + rnd.normal(size=dims)
        rows.append((i, [float(x) for x in v / np.linalg.norm(v) * scale * rnd.choice([1.0, 1.0, 0.5, 2.0])], lab))
    return rows


@pytest.mark.parametrize("dims,row_values,anchor_values", [(8, 1 << 17, 1 << 18), (3, 60, 30), (1, 5, 9)])
def test_equals_brute_force(spark, dims, row_values, anchor_values):
    rnd = np.random.default_rng(dims)
    rows = vectors(rnd, 400, dims, 4)
    rows += [(i, rows[0][1], 3) for i in range(400, 440)]                       # one very common vector
    rows += [(450, None, 1), (500, [0.0] * dims, 1), (505, [-0.0] * dims, 2), (550, [float("nan")] * dims, 1), (600, [0.1] * dims, None), (None, [0.1] * dims, 2),
             (650, [None] + [0.1] * (dims - 1), 1), (700, [float("inf")] * dims, 1), (750, [0.3] * (dims + 1), 1), (751, [0.3] * (dims + 1), 1),
             (752, [0.2] * (dims + 1), 2), (800, [], 1), (801, [], 2), (802, [], 1), (850, rows[50][1], 2), (850, rows[50][1], 2), (7, rows[7][1], 1)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, rank int").repartition(5)
    out = N.mine(df, F.col("vec_id") % 50 == 0, row_values=row_values, anchor_values=anchor_values)
    assert sorted(map(tuple, out.collect())) == brute(rows, 50)
    assert N.mine(df.limit(0), F.col("vec_id") % 50 == 0).collect() == []
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_large_components_are_summed_exactly(spark):
    rnd = random.Random(5)
    rows = [(i, [float(rnd.randint(-10**5, 10**5)) + rnd.random() for _ in range(4)], i % 3) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert sorted(map(tuple, N.mine(df, F.col("vec_id") % 10 == 0).collect())) == brute(rows, 10)


def test_ranges_never_lose_a_row_and_prune():
    rnd = np.random.default_rng(2)
    v = np.floor(256 * np.array([r[1] for r in vectors(rnd, 600, 6, 3)])).astype(np.int64)
    order = np.argsort(-np.linalg.norm(v, axis=1))
    b = N.Bucket(order, order % 3, v[order])
    a = N.Anchors(np.arange(50), np.zeros(50, np.int64), v[:50], 5, True)
    kept = 0
    for k in range(50):
        s = v[order] @ v[k]
        for share in (0.3, 0.7, 0.95, 1.0, 1.2):
            wanted = share * float(s.max())
            rows = b.candidates(a.unit[k], a.focus[k], a.lengths[k], wanted)
            assert set(np.nonzero(s >= wanted)[0]) <= set(rows.tolist())
            kept += len(rows)
    assert kept < 0.5 * 50 * 5 * 600
