"""Run ledger and request log operators, and skew-safe numbering."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from dcflow.operators.ledger import (assign_batches, batch_summary, harvest_summary,
                                     outcome_by_day, pacing_audit, resolve_attempts, run_throughput)
from dcflow.operators.numbering import number_rows

T0 = dt.datetime(2024, 1, 1)


def log(spark, rows):
    """rows: (request_id, attempt, seconds, status)"""
    data = [("c", r, a, T0 + dt.timedelta(seconds=s), st) for r, a, s, st in rows]
    return spark.createDataFrame(data, "client string, request_id string, attempt int, "
                                       "ts timestamp_ntz, status int")


def test_resolve_attempts_cases(spark):
    rows = [("ok3", 1, 0, 503), ("ok3", 2, 3, 503), ("ok3", 3, 6, 200),
            ("ok4", 1, 10, 503), ("ok4", 2, 13, 503), ("ok4", 3, 16, 503), ("ok4", 4, 19, 200),
            ("nf", 1, 30, 404), ("nf", 2, 33, 200),
            ("dead", 1, 40, 503), ("dead", 2, 43, 429)]
    got = {r.request_id: (r.succeeded, r.attempts_used, r.last_status)
           for r in resolve_attempts(log(spark, rows), 3).collect()}
    assert got["ok3"] == (True, 3, 200)
    assert got["ok4"] == (False, 3, 503)          # success only on attempt 4: failed under 3
    assert got["nf"] == (True, 2, 200)            # retry-everything rule
    assert got["dead"] == (False, 2, 429)
    legacy = {r.request_id: (r.succeeded, r.attempts_used, r.last_status)
              for r in resolve_attempts(log(spark, rows), 3, retryable=(503, 429)).collect()}
    assert legacy["nf"] == (False, 1, 404)        # 404 is final in the older client's rule
    assert legacy["ok3"] == (True, 3, 200)


def test_pacing_audit_first_and_exact_gap(spark):
    rows = [("r1", 1, 0.0, 200), ("r2", 1, 3.0, 200), ("r3", 1, 4.5, 200)]
    got = {r.request_id: (r.wait_us, r.violation) for r in pacing_audit(log(spark, rows)).collect()}
    assert got["r1"] == (0, False)                # first request: no wait
    assert got["r2"] == (0, False)                # gap exactly 3000 ms: no wait
    assert got["r3"] == (1_500_000, True)


def test_summary_throughput_outcomes(spark):
    led = spark.createDataFrame(
        [("r", "cs", dt.date(2024, 1, 1), 5, 0.0), ("r", "math", dt.date(2024, 1, 1), -1, 0.0),
         ("r2", "cs", dt.date(2024, 1, 2), -1, 2.0)],
        "run_id string, set_spec string, d date, n bigint, elapsed_s double")
    s = {r.run_id: tuple(r)[1:] for r in harvest_summary(led).collect()}
    assert s["r"] == (2, 1, 1, 5) and s["r2"] == (1, 0, 1, 0)      # all failed run
    t = {r.run_id: r.records_per_minute for r in run_throughput(led).collect()}
    assert t["r"] == 0.0                                            # elapsed 0 -> 0
    o = {(r.set_spec, r.d.day): r.outcome for r in outcome_by_day(led).collect()}
    assert o == {("cs", 1): "some", ("math", 1): "failed", ("cs", 2): "failed"}


def test_number_rows_matches_window_under_skew(spark):
    random.seed(7)
    rows = [("hot" if random.random() < 0.6 else f"g{random.randint(0, 20)}", i, random.random())
            for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, id long, v double")
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    ranged = number_rows(df, ["g"], ["v", "id"], out="rn", num_partitions=16)
    plain = number_rows(df, ["g"], ["v", "id"], out="rn")
    for got in (ranged, plain):
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_assign_batches_and_summary(spark):
    df = spark.createDataFrame([("a" if i % 4 else "b", i) for i in range(45)], "set_spec string, seq long")
    b = assign_batches(df, ["seq"], "set_spec", size=10)
    sizes = {(r.set_spec, r.batch_no): r["count"] for r in b.groupBy("set_spec", "batch_no").count().collect()}
    assert sizes[("a", 0)] == 10 and sizes[("a", 3)] == 3 and sizes[("b", 1)] == 2
    s = {r.set_spec: (r.n_records, r.n_batches, r.last_batch_size)
         for r in batch_summary(df, "set_spec", 10).collect()}
    assert s == {"a": (33, 4, 3), "b": (12, 2, 2)}


def test_adapters_conform_to_fixed_schemas(spark):
    from dcflow.operators.ledger import LEGACY_RETRYABLE
    from dcflow.plans import adapters as A
    from dcflow.plans.jobs import backfill_plan
    from dcflow.plans.catalog import SETS, stored_records
    from dcflow.schemas import LEDGER, REQUEST_LOG, REQUESTS
    sf = "/root/testdata/sf0.001"

    def conforms(df, schema):
        types = dict(df.dtypes)
        return all(types.get(f.name) == f.dataType.simpleString() for f in schema.fields)

    assert conforms(A.ledger_v(spark, sf), LEDGER)
    assert conforms(A.log_v(spark, sf), REQUEST_LOG)
    assert conforms(backfill_plan(stored_records(spark, sf), SETS, "2024-01-01", "2024-01-31"),
                    REQUESTS)
    assert LEGACY_RETRYABLE == (503, 429)
