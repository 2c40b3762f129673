"""A merge's rows move once on the way into the base, and once when a large delta is read over it."""

import re

import pytest
from pyspark.sql import functions as F

from dcflow.plans.jobs import ingest_pages
from dcflow.sources.pages import compact_pages
from dcflow.sources.table import compact_table, ensure_table, merge_into, read_metadata

COLS = ("header_identifier string, header_datestamp timestamp_ntz, header_setSpecs array<string>, metadata_creator array<string>, metadata_date array<string>, "
        "metadata_description string, metadata_identifier array<string>, metadata_subject array<string>, metadata_title array<string>, metadata_type string")


def _batch(spark, keys, title, at):
    rows = [(f"k{i}", None, ["s"], [], [], f"d{i}", [], [], [title], "text") for i in keys]
    return spark.createDataFrame(rows, COLS).withColumn("arrival", F.struct(
        F.lit(at).cast("long").alias("at"), F.lit("p").alias("path"), F.lit(0).cast("long").alias("pos")))


def _merged(spark, path):
    for n, (keys, title, at) in enumerate([(range(0, 40), "first", 5), (range(20, 60), "older", 3), (range(30, 70), "newer", 9)]):
        merge_into(spark, path, _batch(spark, keys, title, at), f"2024-06-0{n + 1} 00:00:00", ["arrival"], num_buckets=4)
        if n == 0:
            compact_table(spark, path, 4, max_files=0)


def _rows(df):
    return sorted(map(str, df.select("header_identifier", "metadata_title", "created_at", "updated_at", "arrival", "bucket").collect()))


def _exchanges(df):
    return len(re.findall(r"\bExchange ", df._jdf.queryExecution().executedPlan().toString()))


def test_a_delta_too_large_to_broadcast_is_one_shuffle(spark, tmp_dir):
    _merged(spark, tmp_dir + "/t")
    want = _rows(read_metadata(spark, tmp_dir + "/t"))
    assert {r.split("'")[1]: r.split("'")[3] for r in want} == {f"k{i}": "newer" if i >= 30 else "first" if i < 40 else "older" for i in range(70)}
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        read = read_metadata(spark, tmp_dir + "/t")
        assert _rows(read) == want
        assert _exchanges(read) == 1
        compact_table(spark, tmp_dir + "/t", 4, max_files=0, tasks_per_bucket=2)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert _rows(read_metadata(spark, tmp_dir + "/t")) == want


def test_sized_pages_are_archived_where_they_are(spark, tmp_dir):
    pages = spark.range(40).selectExpr("concat('p', lpad(id, 2, '0')) path", "string(id) value").repartition(4)
    compact_pages(pages, tmp_dir + "/a", merge=False)
    back = spark.read.parquet(tmp_dir + "/a").withColumn("file", F.col("_metadata.file_path"))
    assert (back.count(), back.select("file").distinct().count()) == (40, 4)


@pytest.mark.parametrize("counts", [False, True])
def test_pages_with_one_output_are_not_staged(spark, tmp_dir, monkeypatch, counts):
    from dcflow.plans import jobs

    staged = []
    monkeypatch.setattr(jobs, "written", lambda df, path, real=jobs.written: staged.append(path) or real(df, path))
    page = ("<OAI-PMH><responseDate>x</responseDate><ListRecords><record><header><identifier>k1</identifier><datestamp>2024-01-01</datestamp></header>"
            "<metadata><dc><title>t</title></dc></metadata></record></ListRecords></OAI-PMH>")
    ensure_table(spark, tmp_dir + "/t", 2)
    ingest_pages(spark, spark.createDataFrame([("p", page)], "path string, value string"), tmp_dir + "/t", "2024-06-01 00:00:00", num_buckets=2, with_counts=counts)
    assert [r.metadata_title for r in read_metadata(spark, tmp_dir + "/t").collect()] == [["t"]]
    assert len(staged) == counts
