"""Whole jobs: ingest landed pages (the ``recent`` run), plan a backfill, and
plan both (U1). A plan is a DataFrame of requests; fetching is not done here.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import backfill_bounds, day_range, recent_window
from ..operators.coverage import chunk_dates, missing_dates, sets_frame
from ..operators.ledger import harvest_summary, page_ledger
from ..operators.merge import arrival_key
from ..operators.records import accepted, flatten_records, rejected, validate_records
from ..session import list_names, remove_path, scratch_path, written
from ..sources.pages import explode_records, page_status, parse_pages
from ..sources.requests import DEFAULT_BASE_URL, DEFAULT_PREFIX, build_requests
from ..sources.table import DEFAULT_BUCKETS, merge_into

PLAN_COLUMNS = ["set_spec", "from_date", "until_date", "chunk_no", "url"]
# Fixed value: missing days are requested in chunks of a week.
DEFAULT_CHUNK = 7


def backfill_plan(stored: DataFrame, sets: Sequence[str], start: str | None = None,
                  end: str | None = None, as_of: str | _dt.date | Column | None = None,
                  match: str = "exact", chunk_size: int = DEFAULT_CHUNK,
                  legacy_day_range: bool = False, end_inclusive: bool = True,
                  base_url: str = DEFAULT_BASE_URL,
                  metadata_prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """P14 -> J2 -> A1/J3 -> J1 -> W2 -> P12 -> S5: one request per missing
    (set, day), numbered in week-sized chunks, with its URL."""
    if end is None and as_of is None:
        as_of = _dt.date.today()
    lo, hi = backfill_bounds(start, end, as_of if as_of is not None else _dt.date.today())
    missing = chunk_dates(missing_dates(stored, sets, lo, hi, match, end_inclusive), chunk_size)
    f, u = day_range(F.col("d"), legacy=legacy_day_range)
    plan = missing.select("set_spec", f.alias("from_date"), u.alias("until_date"), "chunk_no")
    return build_requests(plan, base_url, metadata_prefix).select(*PLAN_COLUMNS)


def recent_plan(spark: SparkSession, sets: Sequence[str], as_of: str | _dt.date | Column,
                base_url: str = DEFAULT_BASE_URL,
                metadata_prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """P13 -> S5: one request per set for the two-day look-back window."""
    f, u = recent_window(as_of)
    plan = sets_frame(spark, sets).select("set_spec", f.alias("from_date"), u.alias("until_date"),
                                          F.lit(None).cast("bigint").alias("chunk_no"))
    return build_requests(plan, base_url, metadata_prefix).select(*PLAN_COLUMNS)


def union_runs(recent: DataFrame, backfill: DataFrame) -> DataFrame:
    """The recent run's rows followed by the backfill run's, by column name,
    tagged with ``mode``."""
    return recent.withColumn("mode", F.lit("recent")) \
                 .unionByName(backfill.withColumn("mode", F.lit("backfill")))


def both_plan(stored: DataFrame, sets: Sequence[str], as_of: str | _dt.date,
              start: str | None = None, end: str | None = None, **kw) -> DataFrame:
    """The recent requests followed by the backfill requests, with ``mode``."""
    spark = stored.sparkSession
    base_url = kw.pop("base_url", DEFAULT_BASE_URL)
    prefix = kw.pop("metadata_prefix", DEFAULT_PREFIX)
    r = recent_plan(spark, sets, as_of, base_url, prefix)
    b = backfill_plan(stored, sets, start, end, as_of, base_url=base_url, metadata_prefix=prefix, **kw)
    return union_runs(r, b).select("mode", *PLAN_COLUMNS)


def landing_time(pages: DataFrame) -> _dt.datetime:
    """The latest ``landed_at`` of the pages as a UTC wall-clock time (one
    scalar to the driver); now if the pages carry no landing time."""
    if "landed_at" in pages.columns:
        us = pages.agg(F.max(F.unix_micros("landed_at"))).first()[0]
        if us is not None:
            return _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=us)
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0)


def _replace_run(df: DataFrame, path: str, run_id: str) -> None:
    """Write one run's rows into its ``run_id`` partition, replacing it, in one pass over ``df``.
    A dynamic overwrite without rows replaces nothing, so an emptied run's old partition, whose
    files are still the ones from before, is removed."""
    spark = df.sparkSession

    def files() -> set[str]:
        mine = [n for n in list_names(spark, path) if unquote(n) == f"run_id={run_id}"]
        return {f"{n}/{f}" for n in mine for f in list_names(spark, f"{path}/{n}")}

    before = files()
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("run_id").parquet(path)
    for folder in {f.split("/", 1)[0] for f in before & files()}:
        remove_path(spark, f"{path}/{folder}")


def _ingest(spark: SparkSession, parsed: DataFrame, table_path: str, as_of, run_id, quarantine_path,
            num_buckets, with_ledger, with_counts, ledger_path, run_suffix) -> dict:
    if as_of is None:
        as_of = landing_time(parsed)
    run_id = run_id or f"run-{as_of}{run_suffix}"
    tagged = validate_records(flatten_records(explode_records(parsed))) \
        .withColumn("run_id", F.lit(run_id))
    if quarantine_path:
        _replace_run(rejected(tagged), quarantine_path, run_id)
    # arrival order: the later landing wins, so one batch gives what any micro-batches give;
    # the file name only settles pages that landed at one moment
    kept = accepted(tagged)
    res = merge_into(spark, table_path, kept.withColumn("arrival", arrival_key(kept, as_of)), as_of, ["arrival"], num_buckets)
    res["as_of"], res["run_id"] = as_of, run_id
    if with_counts:
        stats = page_status(parsed).groupBy("status").count().collect()
        res["pages"] = {r["status"]: r["count"] for r in stats}
        counts = {r["accepted"]: r["count"] for r in tagged.groupBy("accepted").count().collect()}
        res["accepted"], res["rejected"] = counts.get(True, 0), counts.get(False, 0)
    if ledger_path:
        _replace_run(page_ledger(parsed, run_id, tagged), ledger_path, run_id)
    if with_ledger:
        s = harvest_summary(page_ledger(parsed, run_id, tagged)).first()
        res.update(requests=s.sets_processed if s else 0, successful=s.successful if s else 0,
                   failed=s.failed if s else 0)
    return res


def ingest_pages(spark: SparkSession, pages: DataFrame, table_path: str,
                 as_of: str | _dt.datetime | None, run_id: str | None = None,
                 quarantine_path: str | None = None,
                 num_buckets: int = DEFAULT_BUCKETS, with_ledger: bool = False,
                 with_counts: bool = True, ledger_path: str | None = None,
                 run_suffix: str = "") -> dict:
    """The harvest job over one batch of landed pages.

    S2 -> S3 -> P1 -> F8 (tags; rejected rows go to ``quarantine_path``) ->
    W3 + K1 + K2 into the table. Pages are parsed once: the parsed pages are written to the
    shared folder as Parquet, every output reads its columns of that, and it goes at the end.
    Where the table is the only output and ``as_of`` is given, they go straight into it.
    ``as_of=None`` takes the latest ``landed_at`` of the pages (deterministic
    for a replayed batch), or the current time if pages carry no landing time.
    Returns page and record counts (``with_counts``); with ``with_ledger``
    also the run's request summary (A3 over ``page_ledger``), read from the
    same files. ``ledger_path`` keeps the run's ledger rows (one per
    request) in a ledger table, so A3/A4/A7 can run over many runs.
    Quarantine and ledger rows are partitioned by ``run_id`` (default
    ``run-<as_of><run_suffix>``) and replace that run's partition, so a
    replayed batch does not add them twice.
    """
    parsed = parse_pages(pages)
    if as_of is not None and not (quarantine_path or with_ledger or with_counts or ledger_path):
        return _ingest(spark, parsed, table_path, as_of, run_id, None, num_buckets, False, False, None, run_suffix)
    stage = scratch_path(spark, "parsed-pages")
    try:
        return _ingest(spark, written(parsed, stage), table_path, as_of, run_id, quarantine_path,
                       num_buckets, with_ledger, with_counts, ledger_path, run_suffix)
    finally:
        remove_path(spark, stage)


__all__ = ["backfill_plan", "recent_plan", "both_plan", "union_runs", "ingest_pages"]
