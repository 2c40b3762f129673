"""Laws: existing and missing days partition the spine; results do not depend
on partitioning; numbering equals row_number() for any group skew."""

from __future__ import annotations

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from dcflow.operators.coverage import existing_dates, missing_dates, set_date_spine
from dcflow.operators.merge import latest_per_key
from dcflow.operators.numbering import number_rows
from dcflow.plans.catalog import SETS, stored_records

SF = "/root/testdata/sf0.001"


def test_existing_and_missing_partition_the_spine(spark):
    recs = stored_records(spark, SF)
    lo, hi = "2023-12-20", "2024-03-10"
    spine = set_date_spine(spark, SETS, lo, hi)
    have = existing_dates(recs, SETS, lo, hi)
    miss = missing_dates(recs, SETS, lo, hi, match="exact")
    assert have.join(miss, ["set_spec", "d"]).count() == 0
    assert sorted(map(tuple, have.unionByName(miss).collect())) == sorted(map(tuple, spine.collect()))


def test_results_do_not_depend_on_partitioning(spark):
    recs = stored_records(spark, SF).select("header_identifier", "header_datestamp", "path", "pos")
    dup = recs.unionByName(recs.withColumn("pos", F.col("pos") + 1000))
    outs = []
    for n in (1, 3, 17):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        outs.append(sorted(map(tuple, latest_per_key(dup.repartition(n), ["path", "pos"]).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert outs[0] == outs[1] == outs[2]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b", None]),
                          st.integers(0, 50)), min_size=1, max_size=120),
       st.integers(1, 9))
def test_number_rows_any_skew(spark, rows, parts):
    data = [(g, v, i) for i, (g, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "g string, v int, id long")
    got = number_rows(df, ["g"], ["v", "id"], num_partitions=parts)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_reversed_and_leap_ranges(spark):
    spine = set_date_spine(spark, ["x"], "2024-03-01", "2024-02-27")
    assert [r.d for r in spine.orderBy("d").collect()] == [
        dt.date(2024, 2, 27), dt.date(2024, 2, 28), dt.date(2024, 2, 29), dt.date(2024, 3, 1)]


def test_sets_as_dataframe_equal_sets_as_list(spark):
    import pytest
    from dcflow.operators.coverage import coverage_summary, records_in_sets
    recs = stored_records(spark, SF)
    sets_df = spark.createDataFrame([(s,) for s in SETS], "name string")
    lo, hi = "2024-01-01", "2024-03-01"
    for fn in (missing_dates, existing_dates, coverage_summary):
        a = sorted(map(tuple, fn(recs, SETS, lo, hi).collect()))
        b = sorted(map(tuple, fn(recs, sets_df, lo, hi).collect()))
        assert a == b
    assert records_in_sets(recs, sets_df).count() == records_in_sets(recs, SETS).count()
    # substring matching takes a frame of names too
    assert records_in_sets(recs, sets_df, "substring").count() == records_in_sets(recs, SETS, "substring").count()
    with pytest.raises(ValueError):
        records_in_sets(recs, sets_df, "prefix")


def test_legacy_range_and_day_window_options(spark):
    from dcflow.plans.jobs import backfill_plan
    recs = stored_records(spark, SF)
    closed = missing_dates(recs, ["zz"], "2024-01-01", "2024-01-10")          # set with no records
    half = missing_dates(recs, ["zz"], "2024-01-01", "2024-01-10", end_inclusive=False)
    assert closed.count() == 10 and half.count() == 9
    plan = backfill_plan(recs, ["zz"], "2024-01-01", "2024-01-03", legacy_day_range=True)
    rows = sorted((r.from_date, r.until_date) for r in plan.collect())
    assert all((u - f).days == 1 for f, u in rows) and len(rows) == 3
    assert "&until=2024-01-02" in plan.orderBy("from_date").first().url
