"""Plan checks: no Cartesian products, no Python UDFs, filters reach the scan,
and every registered harvest query matches its SQL oracle (sf0.001). The queries of the
training-data operators are tested in tests/llm, which can be removed with them."""

from __future__ import annotations

import pytest

from dcflow.operators.query import list_records
from dcflow.plans.catalog import ORACLE_SQL, QUERIES, stored_records
from dcflow.plans.oracle import compare
from dcflow.session import scratch_path
from dcflow.sources.table import compact_table, merge_into, read_metadata

SF_SMALL = "/root/testdata/sf0.001"

# queries that write tables or run a stream: checked for results only
SIDE_EFFECTS = {"write_roundtrip", "stream_harvest", "landed_pages", "write_batches"}
PURE = [n for n in QUERIES if n not in SIDE_EFFECTS]


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PURE)
def test_plan_has_no_cartesian_or_python(spark, name):
    txt = plan_text(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in txt
    assert "BroadcastNestedLoopJoin" not in txt
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in txt
    # nothing funnels a whole input into one task
    assert "SinglePartition" not in txt


def test_hot_key_is_combined_before_the_shuffle(spark):
    from pyspark.sql import functions as F
    from dcflow.operators.merge import latest_per_key
    from dcflow.plans import adapters as A
    _, incoming = A.keyed_v(spark, SF_SMALL)
    hot = incoming.withColumn("header_identifier", F.lit("one-key"))   # every row, one key
    plan = latest_per_key(hot, ["ts", "event_id"])
    txt = plan._jdf.queryExecution().executedPlan().toString()
    head, _, below = txt.partition("Exchange hashpartitioning")
    assert "partial_max_by" in below          # map-side combine under the exchange
    assert plan.count() == 1


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    res = compare(df, ORACLE_SQL[name], SF_SMALL)
    assert res["match"], res


def test_filters_reach_parquet_scan(spark):
    path = scratch_path(spark, "plan-table")
    merge_into(spark, path, stored_records(spark, SF_SMALL), "2024-06-01 00:00:00",
               ["path", "pos"], num_buckets=4)
    compact_table(spark, path, 4, max_files=0)
    q = list_records(read_metadata(spark, path), "en", "2024-01-10", "2024-01-20") \
        .select("header_identifier")
    txt = plan_text(q)
    assert "PushedFilters: [IsNotNull(header_datestamp), IsNotNull(header_setSpecs), " \
           "GreaterThanOrEqual(header_datestamp" in txt
    assert "ReadSchema: struct<header_identifier:string,header_datestamp:timestamp_ntz," \
           "header_setSpecs:array<string>>" in txt


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "header_identifier"
