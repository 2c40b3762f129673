"""Incremental harvest. New landed pages are picked up as a file
stream and each micro-batch is ingested with the batch job (parse, validate,
merge into the bucketed table).

There is no watermark: a late or repeated page simply merges again (the
merge is idempotent for the same batch and last-write-wins across batches),
which is how re-pulled days are made harmless in batch runs too. ``as_of`` may
be a fixed value or a function of the micro-batch id; by default it is the
latest landing time of the batch's files, so a batch Spark replays after a
failure writes exactly the same rows again.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.jobs import ingest_pages
from ..session import checkpoint_dir, make_dirs, path_exists
from ..sources.pages import ARCHIVE_SCHEMA
from ..sources.table import DEFAULT_BUCKETS, compact_table, ensure_table

AsOf = str | _dt.datetime | Callable[[int], str | _dt.datetime] | None


def land_pages(pages: DataFrame, landing_dir: str, value_col: str = "value") -> None:
    """Write each page to its own file in ``landing_dir``, as a fetcher would land raw
    responses. ``compact_pages`` lands many pages a file, which is what large runs should list."""
    (pages.select(F.col(value_col).alias("value"))
          .write.mode("append").option("maxRecordsPerFile", 1).text(landing_dir))


def page_stream(spark: SparkSession, landing_dir: str,
                max_files_per_trigger: int | None = 1000, archive: bool = False) -> DataFrame:
    """Newly landed pages as rows ``(path, landed_at, value)``: one per file or, with
    ``archive``, the rows of each newly landed ``compact_pages`` file."""
    # recursive lookup: files in any sub-folder, and no partition columns
    # inferred from folder names (a stream started on an empty folder would
    # otherwise see its schema change when the first files arrive)
    r = spark.readStream.option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if archive:
        return r.schema(ARCHIVE_SCHEMA).parquet(landing_dir)
    df = r.text(landing_dir, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"),
                     F.col("_metadata.file_modification_time").alias("landed_at"), "value")


def stream_harvest(spark: SparkSession, landing_dir: str, table_path: str,
                   checkpoint_location: str | None = None, as_of: AsOf = None,
                   max_files_per_trigger: int | None = 1000, available_now: bool = True,
                   processing_time: str | None = None, quarantine_path: str | None = None,
                   ledger_path: str | None = None,
                   num_buckets: int = DEFAULT_BUCKETS, compact_every: int = 0,
                   compact_max_files: int = 8, archive: bool = False) -> StreamingQuery:
    """Start the incremental harvest; returns the running query.

    ``available_now=True`` processes what has landed and stops (a scheduled
    run); otherwise it polls every ``processing_time``. The stream's progress
    lives in ``checkpoint_location`` (default: next to the table). Rejected
    records go to ``quarantine_path`` and each micro-batch's request ledger to
    ``ledger_path``, one ``run_id`` partition per micro-batch. Every
    ``compact_every`` micro-batches (0: never) the merged versions are folded into the base
    if more than ``compact_max_files`` have gathered. ``archive``: pages land as
    ``compact_pages`` files and not as raw responses.
    """
    checkpoint_dir(spark)
    ensure_table(spark, table_path, num_buckets)
    if not path_exists(spark, landing_dir):
        make_dirs(spark, landing_dir)        # nothing landed yet: start empty
    ckpt = checkpoint_location or table_path.rstrip("/") + "_stream_checkpoint"

    def as_of_for(batch_id: int):
        if callable(as_of):
            return as_of(batch_id)
        return as_of        # None: the batch's latest landing time (see ingest_pages)

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        ingest_pages(batch.sparkSession, batch, table_path, as_of_for(batch_id),
                     run_suffix=f"-batch-{batch_id:012d}", quarantine_path=quarantine_path,
                     ledger_path=ledger_path, num_buckets=num_buckets, with_counts=False)
        if compact_every and (batch_id + 1) % compact_every == 0:
            compact_table(batch.sparkSession, table_path, num_buckets, compact_max_files)

    w = page_stream(spark, landing_dir, max_files_per_trigger, archive).writeStream \
        .foreachBatch(run_batch).option("checkpointLocation", ckpt)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
