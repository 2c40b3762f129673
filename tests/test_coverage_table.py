"""The side table of covered days equals the records' own days, through updates, late rows,
folds, and stops in the middle of a fold."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from dcflow.operators.coverage import coverage_summary, existing_dates, missing_any_set, missing_dates
from dcflow.schemas import RECORD
from dcflow.session import make_dirs
from dcflow.sources import table as T


def batch(spark, rnd, n):
    rows = []
    for _ in range(n):
        sets = rnd.sample(["a", "b", "c", "d"], rnd.randint(0, 3))
        rows.append((f"k{rnd.randint(0, 14)}", dt.datetime(2024, 1, rnd.randint(1, 9), rnd.randint(0, 23)), sets, [], [], None, [], [], [], "t", rnd.randint(0, 5), f"p{rnd.random()}"))
    df = spark.createDataFrame(rows, StructType(RECORD.fields + [StructField("at", LongType()), StructField("path", StringType())]))
    return df.withColumn("arrival", F.struct("at", "path", F.lit(0).cast("bigint").alias("pos")))


def same(spark, path):
    t, days = T.read_metadata(spark, path), T.covered_days(spark, path)
    got = {(tuple(r.header_setSpecs), r.header_datestamp.date()): r.n for r in days.collect()}
    want = {}
    for r in t.collect():
        for s in [*((x,) for x in set(r.header_setSpecs)), ()]:
            key = (s, r.header_datestamp.date())
            want[key] = want.get(key, 0) + 1
    assert got == want


@pytest.mark.parametrize("seed", [1])
def test_coverage_follows_the_records(spark, tmp_dir, seed):
    rnd, path = random.Random(seed), tmp_dir + "/t"
    T.ensure_table(spark, path, 3, track_coverage=True)
    for step in range(4):
        T.merge_into(spark, path, batch(spark, rnd, rnd.randint(0, 12)), "2024-05-01 00:00:00", ["arrival"], num_buckets=3)
        same(spark, path)
        if step in (1, 2):
            T.compact_table(spark, path, 3, max_files=0)
            same(spark, path)
    t, days = T.read_metadata(spark, path), T.covered_days(spark, path)
    for f in (lambda x: existing_dates(x, ["a", "c", "zz"], "2024-01-01", "2024-01-08"), lambda x: missing_dates(x, ["a", "zz"], "2023-12-30", "2024-01-10"),
              lambda x: missing_any_set(x, "2023-12-30", "2024-01-10"), lambda x: coverage_summary(x, ["b"], "2024-01-01", "2024-01-08")):
        assert sorted(map(tuple, f(t).collect())) == sorted(map(tuple, f(days).collect()))
    plan = missing_dates(days, ["a"], "2024-01-01", "2024-01-08")._jdf.queryExecution().executedPlan().toString()
    assert "metadata_title" not in plan and "delta" not in plan and "/coverage/" in plan


def test_a_stopped_fold_counts_once_and_is_finished(spark, tmp_dir, monkeypatch):
    rnd, path = random.Random(3), tmp_dir + "/t"
    T.ensure_table(spark, path, 2, track_coverage=True)
    for _ in range(3):
        T.merge_into(spark, path, batch(spark, rnd, 8), "2024-05-01 00:00:00", ["arrival"], num_buckets=2)
    # stops before the versions go, after some are gone, and before the new sum is in force
    for stop in ("_drop_versions", "make_dirs", "_finish_folding"):
        with monkeypatch.context() as m:
            calls = []

            def fail(*a, stop=stop, **k):
                calls.append(a)
                if stop == "make_dirs" and "folding" in a[1]:
                    return make_dirs(*a)
                if stop == "_finish_folding" and len(calls) == 1:
                    return None
                raise RuntimeError("stopped")

            m.setattr(T, stop, fail)
            with pytest.raises(RuntimeError):
                T.compact_table(spark, path, 2, max_files=0)
        same(spark, path)
        T.merge_into(spark, path, batch(spark, rnd, 5), "2024-05-01 00:00:00", ["arrival"], num_buckets=2)
        same(spark, path)
    T.compact_table(spark, path, 2, max_files=0)
    same(spark, path)
    assert T._coverage_state(spark, path)[1] == 0


def test_a_table_without_the_side_table_says_so(spark, tmp_dir):
    T.ensure_table(spark, tmp_dir + "/t", 2)
    with pytest.raises(ValueError):
        T.covered_days(spark, tmp_dir + "/t")
