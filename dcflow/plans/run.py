"""Run a harvest job: ``python -m dcflow.plans.run --mode recent|backfill|both``.

* ``recent``   ingest the landed pages under ``--pages`` into ``--table``;
* ``backfill`` write the request plan for the missing days of each set to
  ``--plan-out`` (Parquet), read from ``--table``;
* ``both``     the two (pages are optional), with the plan covering the recent
  and the backfill requests.

Prints one JSON summary line: sets/requests processed, successful, failed,
records, elapsed seconds and records per minute.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
import sys
import time

from pyspark.sql import functions as F

from ..session import build_session
from ..sources.pages import read_page_archive, read_pages
from ..sources.requests import DEFAULT_BASE_URL, DEFAULT_PREFIX
from ..sources.table import DEFAULT_BUCKETS, compact_table, ensure_table, read_metadata
from .jobs import DEFAULT_CHUNK, backfill_plan, both_plan, ingest_pages

# Fixed value: the set list used when none is given.
DEFAULT_SETS = ["physics", "math", "cs", "q-bio", "q-fin", "stat", "eess", "econ"]


def main(argv: list[str] | None = None) -> dict:
    ap = argparse.ArgumentParser(prog="dcflow.plans.run")
    ap.add_argument("--mode", choices=["recent", "backfill", "both"], default="recent")
    ap.add_argument("--table", required=True)
    ap.add_argument("--pages", help="landed page files (recent/both)")
    ap.add_argument("--page-archive", help="pages archived as Parquet (path, value)")
    ap.add_argument("--quarantine", help="where rejected records are appended")
    ap.add_argument("--ledger", help="where the run's request ledger is appended")
    ap.add_argument("--plan-out", help="where the request plan is written (backfill/both)")
    ap.add_argument("--set-specs", nargs="+", default=DEFAULT_SETS)
    ap.add_argument("--start-date")
    ap.add_argument("--end-date")
    ap.add_argument("--as-of", default=None,
                    help="run time (UTC); default: the pages' latest landing time, else now")
    ap.add_argument("--buckets", type=int, default=DEFAULT_BUCKETS)
    ap.add_argument("--compact-max-files", type=int, default=None,
                    help="after ingest, fold the merged versions into the base if more than this have gathered")
    ap.add_argument("--base-url", default=DEFAULT_BASE_URL, help="endpoint of the planned requests")
    ap.add_argument("--metadata-prefix", default=DEFAULT_PREFIX)
    ap.add_argument("--match", choices=["exact", "substring"], default="exact", help="how a record belongs to a set")
    ap.add_argument("--chunk-size", type=int, default=DEFAULT_CHUNK, help="missing days per chunk")
    ap.add_argument("--end-exclusive", action="store_true", help="the end date itself is not asked for")
    ap.add_argument("--master", default=None)
    a = ap.parse_args(argv)

    spark = build_session(a.master)
    if a.mode == "recent" and not (a.pages or a.page_archive):
        ap.error("--pages or --page-archive is needed for recent")
    pages = None
    if a.page_archive:
        pages = read_page_archive(spark, a.page_archive)
    elif a.pages:
        pages = read_pages(spark, a.pages, recursive=True)
    as_of = a.as_of
    t0 = time.perf_counter()
    out: dict = {"mode": a.mode}
    total = 0
    if pages is not None:
        # as_of None: ingest takes the pages' latest landing time from its parse
        res = ingest_pages(spark, pages, a.table, as_of, quarantine_path=a.quarantine,
                           num_buckets=a.buckets, with_ledger=True, ledger_path=a.ledger)
        out["recent"] = res
        if a.compact_max_files is not None:
            out["compacted_versions"] = compact_table(spark, a.table, a.buckets,
                                                     a.compact_max_files)
        as_of = str(res["as_of"])
        total += res.get("accepted", 0)
    if as_of is None:
        as_of = str(_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None, microsecond=0))
    out["as_of"] = as_of
    if a.mode in ("backfill", "both"):
        ensure_table(spark, a.table, a.buckets)
        stored = read_metadata(spark, a.table)
        day = as_of[:10]
        options = {"base_url": a.base_url, "metadata_prefix": a.metadata_prefix, "match": a.match,
                   "chunk_size": a.chunk_size, "end_inclusive": not a.end_exclusive}
        if a.mode == "both":
            plan = both_plan(stored, a.set_specs, day, a.start_date, a.end_date, **options)
        else:
            plan = backfill_plan(stored, a.set_specs, a.start_date, a.end_date, day, **options) \
                .withColumn("mode", F.lit("backfill"))
        if a.plan_out:
            plan.write.mode("overwrite").parquet(a.plan_out)
            plan = spark.read.parquet(a.plan_out)
        counts = {r["mode"]: r["count"] for r in plan.groupBy("mode").count().collect()}
        out["plan"] = {"requests": counts, "path": a.plan_out}
    elapsed = time.perf_counter() - t0
    out.update(total_records=total, elapsed_s=round(elapsed, 3),
               records_per_minute=round(total * 60.0 / elapsed, 2) if elapsed > 0 else 0.0)
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
    sys.exit(0)
