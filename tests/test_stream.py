"""The incremental harvest equals the batch harvest; replays and late pages
merge again; created_at is kept from the first sighting."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from dcflow.plans import adapters as A
from dcflow.plans.catalog import kept_records
from dcflow.plans.jobs import ingest_pages
from dcflow.session import scratch_path
from dcflow.sources.table import read_metadata
from dcflow.streaming.harvest import land_pages, stream_harvest

SF_SMALL = "/root/testdata/sf0.001"

COLS = ["header_identifier", "header_datestamp", "metadata_description", "metadata_type"]


def test_stream_equals_batch_and_late_pages_merge(spark):
    pages = A.pages_v(spark, SF_SMALL)
    landing = scratch_path(spark, "t-landing")
    table_path = scratch_path(spark, "t-table")
    ckpt = scratch_path(spark, "t-ckpt")
    first = pages.filter(F.col("page_no") < 5)
    land_pages(first, landing)
    t1 = dt.datetime(2024, 6, 1)
    q = stream_harvest(spark, landing, table_path, ckpt, as_of=t1, max_files_per_trigger=3)
    q.awaitTermination()
    n1 = read_metadata(spark, table_path).count()
    # the rest lands later, together with a repeated copy of page 0
    land_pages(pages.filter(F.col("page_no") >= 5), landing)
    land_pages(first.filter(F.col("page_no") == 0).withColumn(
        "path", F.concat(F.col("path"), F.lit("-again"))), landing)
    t2 = dt.datetime(2024, 6, 2)
    q = stream_harvest(spark, landing, table_path, ckpt, as_of=t2, max_files_per_trigger=3)
    q.awaitTermination()
    streamed = read_metadata(spark, table_path)

    batch_path = scratch_path(spark, "t-batch")
    ingest_pages(spark, pages, batch_path, t1)
    batch = read_metadata(spark, batch_path)
    assert sorted(map(tuple, streamed.select(COLS).collect())) == \
        sorted(map(tuple, batch.select(COLS).collect()))
    assert n1 > 0 and streamed.count() > n1
    # page 0 arrived twice: updated by the replay, created at first sight
    p0 = kept_records(spark, SF_SMALL).filter(F.col("path").endswith("p0000000.xml")) \
        .select("header_identifier").first()[0]
    row = streamed.filter(F.col("header_identifier") == p0).first()
    assert row.created_at == t1 and row.updated_at == t2


def test_run_modes(spark):
    from dcflow.plans.run import main
    from dcflow.sources.pages import compact_pages

    archive = scratch_path(spark, "run-archive")
    compact_pages(A.pages_v(spark, SF_SMALL), archive)
    table_path = scratch_path(spark, "run-table")
    ledger = scratch_path(spark, "run-ledger")
    quarantine = scratch_path(spark, "run-quarantine")
    r = main(["--mode", "recent", "--table", table_path, "--page-archive", archive,
              "--as-of", "2024-06-01 00:00:00", "--ledger", ledger, "--quarantine", quarantine])
    assert r["recent"]["accepted"] == read_metadata(spark, table_path).count() > 0
    assert spark.read.parquet(quarantine).count() == r["recent"]["rejected"] > 0
    led = spark.read.parquet(ledger)
    requests = led.count()                               # no request echo: one request per page
    assert requests > 1 and led.filter("failed").count() > 0
    assert led.agg(F.sum("n")).first()[0] == r["recent"]["accepted"]
    assert led.first().run_id == r["recent"]["run_id"] != "run-landed"
    # the same run again replaces its quarantine and ledger partitions
    r2 = main(["--mode", "recent", "--table", table_path, "--page-archive", archive,
               "--as-of", "2024-06-01 00:00:00", "--ledger", ledger, "--quarantine", quarantine,
               "--compact-max-files", "1"])
    assert r2["compacted_versions"] >= 0
    assert read_metadata(spark, table_path).count() == r["recent"]["accepted"]
    assert spark.read.parquet(quarantine).count() == r["recent"]["rejected"]
    assert spark.read.parquet(ledger).count() == requests
    plan_out = scratch_path(spark, "run-plan")
    b = main(["--mode", "both", "--table", table_path, "--set-specs", "en", "fr",
              "--start-date", "2024-01-01", "--end-date", "2024-03-01", "--plan-out", plan_out,
              "--as-of", "2024-03-02 00:00:00"])
    assert b["plan"]["requests"]["recent"] == 2
    assert spark.read.parquet(plan_out).count() == sum(b["plan"]["requests"].values())


def test_stream_starts_before_anything_landed(spark):
    landing = scratch_path(spark, "t-empty-landing")
    table_path = scratch_path(spark, "t-empty-table")
    q = stream_harvest(spark, landing, table_path, as_of="2024-06-01 00:00:00")
    q.awaitTermination()
    assert read_metadata(spark, table_path).count() == 0


def test_default_as_of_is_the_landing_time(spark):
    import os
    landing = scratch_path(spark, "t-asof-landing")
    table_path = scratch_path(spark, "t-asof-table")
    land_pages(A.pages_v(spark, SF_SMALL).filter(F.col("page_no") < 2), landing)
    q = stream_harvest(spark, landing, table_path)
    q.awaitTermination()
    t = read_metadata(spark, table_path)
    local = landing.replace("file:", "")
    newest = max(os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(local)
                 for f in fs if f.endswith(".txt"))
    got = t.agg(F.max("updated_at")).first()[0]
    want = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=newest)
    assert abs((got - want).total_seconds()) < 1.0
    assert t.select("created_at").distinct().count() == 1


def test_rerun_of_the_same_pages_is_exactly_idempotent(spark):
    from dcflow.sources.pages import compact_pages, read_page_archive, read_pages
    landing = scratch_path(spark, "t-rerun-landing")
    land_pages(A.pages_v(spark, SF_SMALL).filter(F.col("page_no") < 3), landing)
    archive = scratch_path(spark, "t-rerun-archive")
    compact_pages(read_pages(spark, landing, recursive=True), archive)
    table_path = scratch_path(spark, "t-rerun-table")
    r1 = ingest_pages(spark, read_page_archive(spark, archive), table_path, None)
    first = sorted(map(tuple, read_metadata(spark, table_path).collect()))
    r2 = ingest_pages(spark, read_page_archive(spark, archive), table_path, None)
    second = sorted(map(tuple, read_metadata(spark, table_path).collect()))
    assert r1["as_of"] == r2["as_of"] and first == second and len(first) > 0


def test_polling_stream_picks_up_new_pages(spark):
    landing = scratch_path(spark, "t-poll-landing")
    table_path = scratch_path(spark, "t-poll-table")
    q = stream_harvest(spark, landing, table_path, as_of="2024-06-01 00:00:00",
                       available_now=False, processing_time="1 second")
    try:
        land_pages(A.pages_v(spark, SF_SMALL).filter(F.col("page_no") == 0), landing)
        q.processAllAvailable()
        n1 = read_metadata(spark, table_path).count()
        land_pages(A.pages_v(spark, SF_SMALL).filter(F.col("page_no") == 1), landing)
        q.processAllAvailable()
        n2 = read_metadata(spark, table_path).count()
    finally:
        q.stop()
    assert 0 < n1 < n2


def test_stream_writes_a_ledger_per_micro_batch(spark):
    landing = scratch_path(spark, "t-led-landing")
    land_pages(A.pages_v(spark, SF_SMALL), landing)
    ledger = scratch_path(spark, "t-led-ledger")
    quarantine = scratch_path(spark, "t-led-quarantine")
    q = stream_harvest(spark, landing, scratch_path(spark, "t-led-table"),
                       as_of="2024-06-01 00:00:00", max_files_per_trigger=4,
                       ledger_path=ledger, quarantine_path=quarantine)
    q.awaitTermination()
    batches = len(q.recentProgress)
    assert spark.read.parquet(ledger).select("run_id").distinct().count() == batches > 1
    assert spark.read.parquet(quarantine).count() > 0


def test_stream_compacts_every_few_batches(spark):
    from dcflow.sources.table import delta_versions
    landing = scratch_path(spark, "t-cmp-landing")
    land_pages(A.pages_v(spark, SF_SMALL), landing)
    table_path = scratch_path(spark, "t-cmp-table")
    q = stream_harvest(spark, landing, table_path, as_of="2024-06-01 00:00:00",
                       max_files_per_trigger=2, num_buckets=4, compact_every=2,
                       compact_max_files=1)
    q.awaitTermination()
    batches = len(q.recentProgress)
    assert batches >= 4
    assert len(delta_versions(spark, table_path)) == batches % 2       # compacted after every second batch
    assert read_metadata(spark, table_path).count() == \
        kept_records(spark, SF_SMALL).filter("header_datestamp IS NOT NULL").count()
