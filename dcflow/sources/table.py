"""The stored metadata table: Parquet, a bucketed base and the batches merged since
(S6, K2, K3, K4 and the merge that ties them together).

Layout: ``<path>/base/bucket=<b>/part-*.parquet`` with ``b = pmod(xxhash64(id), N)`` holds one
row per identifier. A merge only appends: its batch, one row per identifier, becomes the
folder ``<path>/delta/version=<v>``, and no stored file is read or rewritten, whatever the
batch's size. ``compact_table`` folds the deltas into the buckets they touch and removes them;
until then a read pays one join of the base with the rows merged since.

Every row keeps its ``arrival``. Of an identifier's copies, in the base and in any number of
versions, ``read_metadata`` gives the last to arrive, whichever was merged last: a harvest
dealt into batches in any way, or an archive of older pages merged after a newer one, leaves
the same records. Between copies of equal arrival the later merge wins.

One writer at a time. A merge that dies leaves no committed version or a whole one, and a
re-run adds the same rows under the next version. A compaction that dies after its swap
leaves deltas that the base already holds, and reading them over it changes nothing.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import lit_ts
from ..operators.ledger import assign_batches
from ..operators.merge import KEY, latest_per_key, micros
from ..schemas import ARRIVAL, RECORD_COLUMNS, TABLE
from ..session import (broadcast_limit, folder_bytes, list_names, make_dirs, path_exists, remove_path, scratch_path,
                       shuffle_partitions, written)

DEFAULT_BUCKETS = 64
# Identifiers expected per Parquet row group (128 MB of ~1 KB records), which
# sizes each identifier bloom filter at about 240 KB for a 1% false-positive rate.
BLOOM_NDV = 200_000


def bucket_of(key: Column | str = KEY, num_buckets: int = DEFAULT_BUCKETS) -> Column:
    k = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.xxhash64(k), F.lit(num_buckets)).cast("int")


LAYOUT_DIR = "_dcflow_layout"
# The side table of covered days: how many records each set has on each day; a NULL set counts
# the day's records whatever their sets.
COVERAGE = "set_spec string, d date, n long"
ROW_COLUMNS = [f.name for f in TABLE.fields if f.name != "bucket"]
# A delta's files take at least so many times the room of its identifiers alone, as joins see them.
KEYS_SHARE = 8
DELTA = T.StructType([f for f in TABLE.fields if f.name != "bucket"] + [T.StructField("version", T.LongType())])


def _part(path: str, name: str) -> str:
    return f"{path.rstrip('/')}/{name}"


def ensure_table(spark: SparkSession, path: str, num_buckets: int = DEFAULT_BUCKETS,
                 track_coverage: bool = False) -> bool:
    """K3: create an empty table at ``path`` if none is there. True if created.

    ``track_coverage`` keeps a side table of covered days with it (``covered_days``).

    The bucket count is recorded next to the data (as a folder name, read
    without a Spark job), and a later merge with a different count is refused;
    ``rebucket_table`` copies a table into another count.
    """
    if path_exists(spark, path):
        return False
    spark.createDataFrame([], TABLE).write.mode("errorifexists") \
        .partitionBy("bucket").parquet(_part(path, "base"))
    make_dirs(spark, _part(path, f"{LAYOUT_DIR}/buckets={int(num_buckets)}"))
    if track_coverage:
        spark.createDataFrame([], COVERAGE).write.parquet(_part(path, "coverage/base=0"))
        make_dirs(spark, _part(path, f"{LAYOUT_DIR}/coverage=0"))
    return True


def table_buckets(spark: SparkSession, path: str) -> int | None:
    """The bucket count recorded by ``ensure_table`` (None if not recorded)."""
    for name in list_names(spark, _part(path, LAYOUT_DIR)):
        if name.startswith("buckets="):
            return int(name.split("=", 1)[1])
    return None


def _same_buckets(spark: SparkSession, path: str, num_buckets: int) -> None:
    recorded = table_buckets(spark, path)
    if recorded is not None and recorded != num_buckets:
        raise ValueError(f"table at {path} has {recorded} buckets, not {num_buckets}")


def delta_versions(spark: SparkSession, path: str) -> list[int]:
    """The versions merged since the last compaction, oldest first (a folder listing)."""
    names = list_names(spark, _part(path, "delta"))
    return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("version="))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its last merge, with its fixed schema (no inference).

    Without deltas this is a plain scan of the base. With deltas whose keys can be broadcast,
    the base rows they do not replace come with predicates pushed into the scan, and each delta
    row takes the earliest ``created_at`` of its identifier from the base. With larger deltas
    both go through one shuffle by identifier, where joins would move the base's rows twice.
    """
    base = spark.read.schema(TABLE).parquet(_part(path, "base"))
    if not delta_versions(spark, path):
        return base
    buckets = table_buckets(spark, path) or DEFAULT_BUCKETS
    delta = spark.read.schema(DELTA).parquet(_part(path, "delta"))
    if folder_bytes(spark, _part(path, "delta")) > KEYS_SHARE * broadcast_limit(spark):
        copies = _unmerged(base).unionByName(delta.withColumn("bucket", bucket_of(KEY, buckets)))
        return _settled(copies, KEY).select(*base.columns)
    keys = delta.select(KEY).distinct()
    # the base rows of these keys first: a few keys can be broadcast, the base need not move
    held = _unmerged(base.drop("bucket")).join(keys, KEY, "left_semi")
    fresh = _last_to_arrive(delta.unionByName(held)).withColumn("bucket", bucket_of(KEY, buckets))
    return base.join(keys, KEY, "left_anti").unionByName(fresh).select(*base.columns)


def _unmerged(base: DataFrame) -> DataFrame:
    """Base rows as version 0, the one before all deltas."""
    return base.withColumn("version", F.lit(0).cast("bigint"))


def _settled(copies: DataFrame, *by: str) -> DataFrame:
    """Base rows (version 0) and delta rows, of each identifier in a delta reduced to the copy that
    arrived last, with the earliest ``created_at`` of all. ``by`` holds the identifier and what
    follows from it; rows dealt by any of these are not dealt again. An identifier has at most
    one copy a version."""
    w = Window.partitionBy(*by).orderBy(F.struct("arrival", "version").desc())
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    merged = F.max("version").over(every) > 0
    marked = copies.select("*", F.row_number().over(w).alias("_nth"), merged.alias("_merged"), F.min("created_at").over(every).alias("_created"))
    return marked.where("_nth = 1 OR NOT _merged").withColumn(
        "created_at", F.when(F.col("_merged"), F.col("_created")).otherwise(F.col("created_at"))).drop("_nth", "_merged", "_created", "version")


def _last_to_arrive(copies: DataFrame) -> DataFrame:
    """Per identifier the copy that arrived last, with the earliest ``created_at`` of all."""
    others = [c for c in ROW_COLUMNS if c not in (KEY, "created_at")]
    order = F.struct("arrival", "version")
    last = copies.groupBy(KEY).agg(F.max_by(F.struct(*others), order).alias("_v"), F.min("created_at").alias("created_at"))
    return last.select(KEY, *[F.col(f"_v.{c}").alias(c) for c in others], "created_at")


def write_metadata(df: DataFrame, path: str, num_buckets: int = DEFAULT_BUCKETS,
                   max_records_per_file: int | None = None, tasks_per_bucket: int = 1) -> None:
    """K2: write rows into the base, replacing only the buckets they fall into.

    A bucket is written by ``tasks_per_bucket`` tasks, among which its rows are dealt by
    hash. Within a file rows are sorted by datestamp (date filters skip row groups) and the
    identifier carries a Parquet bloom filter (lookups by identifier skip row groups).
    ``max_records_per_file`` caps file size.
    """
    if "arrival" not in df.columns:
        df = df.withColumn("arrival", F.lit(None).cast(ARRIVAL))     # any merged row arrives later
    out = df.withColumn("bucket", bucket_of(KEY, num_buckets)).select(*[f.name for f in TABLE.fields])
    _write_buckets(_dealt(out, tasks_per_bucket), path, max_records_per_file)


def _dealt(rows: DataFrame, tasks_per_bucket: int) -> DataFrame:
    """The rows by bucket and, within it, by ``_slice``."""
    # the slice hash differs from the bucket hash, or a bucket would stay in one slice
    return rows.withColumn("_slice", F.pmod(F.hash(KEY), F.lit(int(tasks_per_bucket)))).repartition("bucket", "_slice")


def _write_buckets(dealt: DataFrame, path: str, max_records_per_file: int | None = None) -> None:
    out = dealt.select(*[f.name for f in TABLE.fields]).sortWithinPartitions("bucket", "header_datestamp")
    w = _with_bloom(out).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.parquet(_part(path, "base"))


def _with_bloom(df: DataFrame):
    return df.write.option("compression", "zstd").option(f"parquet.bloom.filter.enabled#{KEY}", "true") \
        .option(f"parquet.bloom.filter.expected.ndv#{KEY}", str(BLOOM_NDV))


def write_batches(df: DataFrame, path: str, size: int = 2000, mode: str = "errorifexists") -> None:
    """K4: write ``df`` as files of at most ``size`` records each."""
    df.write.mode(mode).option("maxRecordsPerFile", int(size)).parquet(path)


def write_set_batches(df: DataFrame, path: str, order: Sequence[str | Column], size: int = 2000,
                      set_col: str = "set_spec", mode: str = "errorifexists") -> None:
    """K4: write each set's records as the batches a harvest flushes: in arrival ``order``, every
    batch of ``size`` records, the last what is left, one file a batch in the set's folder
    ``<path>/<set_col>=<set>/``, with ``batch_no`` and ``row_no`` in it.

    A batch is dealt by (set, batch), whole, to one task, so a set of any size has as many
    tasks as it has batches for. A task writes a set's batches in order, all full but the set's
    last: a file that closes at ``size`` records holds one batch. Making a folder and listing
    it costs as much as the file in it, so there is one folder a set and none a batch.
    """
    # NULL and the empty name share a folder, so they are one set
    batches = assign_batches(df.withColumn(set_col, F.nullif(F.col(set_col), F.lit(""))), order, set_col, size)
    by = [set_col, "batch_no"]
    (batches.repartition(shuffle_partitions(df.sparkSession), *by).sortWithinPartitions(*by, "row_no")
     .write.mode(mode).option("maxRecordsPerFile", int(size)).partitionBy(set_col).parquet(path))


def merge_into(spark: SparkSession, path: str, incoming: DataFrame,
               as_of: str | _dt.datetime | Column, seq: Sequence[str | Column],
               num_buckets: int = DEFAULT_BUCKETS) -> dict:
    """K1 + K2: upsert one batch of records into the table at ``path``.

    The batch is reduced to the last row per key in ``seq`` and appended as the next
    version, in one pass over ``incoming``; nothing stored is read or rewritten. A row
    carries its ``arrival`` (a column of ``incoming``, else the run time ``as_of``): it wins
    over stored copies that arrived before it, and ``created_at`` stays the earliest. A record
    without a key fails the write before anything is committed. A batch without rows adds no
    version.
    """
    ensure_table(spark, path, num_buckets)
    _same_buckets(spark, path, num_buckets)
    if "arrival" not in incoming.columns:
        incoming = incoming.withColumn("arrival", F.struct(
            micros(lit_ts(as_of)).alias("at"), F.lit(None).cast("string").alias("path"), F.lit(None).cast("bigint").alias("pos")))
    wanted = list(dict.fromkeys([*RECORD_COLUMNS, "arrival", *[c for c in seq if isinstance(c, str)]]))
    key = F.coalesce(KEY, F.raise_error(F.lit(f"records without {KEY}; run validate_records first")))
    batch = latest_per_key(incoming.select(*wanted).withColumn(KEY, key), seq, KEY)
    _finish_folding(spark, path)
    version = max(delta_versions(spark, path), default=0) + 1
    folder = _part(path, f"delta/version={version}")
    if _coverage_state(spark, path)[0] is None:
        append_metadata(batch, folder, as_of)
    else:
        # the changes of coverage first: they count once the version they belong to is there
        stage = scratch_path(spark, "batch")
        batch = written(batch, stage)
        _coverage_changes(read_metadata(spark, path), batch).write.mode("overwrite").parquet(_part(path, f"coverage/version={version}"))
        append_metadata(batch, folder, as_of)
        remove_path(spark, stage)
    n = spark.read.schema(DELTA).parquet(folder).count()        # from the new files' footers
    if not n:
        remove_path(spark, folder)
    return {"batch_rows": n, "version": version if n else None}


def append_metadata(df: DataFrame, folder: str, as_of: str | _dt.datetime | Column) -> None:
    """Write one version's rows, one per key, stamped with ``as_of``."""
    at = lit_ts(as_of)
    rows = df.withColumn("created_at", at).withColumn("updated_at", at).select(*ROW_COLUMNS)
    _with_bloom(rows.sortWithinPartitions("header_datestamp")).mode("errorifexists").parquet(folder)


def compact_table(spark: SparkSession, path: str, num_buckets: int = DEFAULT_BUCKETS,
                  max_files: int = 8, tasks_per_bucket: int = 1) -> int:
    """Fold the deltas into the base once more than ``max_files`` versions have gathered;
    returns how many were folded. Only buckets that hold a key of a delta are rewritten, each
    dealt to ``tasks_per_bucket`` tasks or more. What a read gives is unchanged."""
    _same_buckets(spark, path, num_buckets)
    _finish_folding(spark, path)
    versions = delta_versions(spark, path)
    if len(versions) <= max_files:
        return 0
    # at most num_buckets integers
    delta = spark.read.schema(DELTA).parquet(_part(path, "delta")).withColumn("bucket", bucket_of(KEY, num_buckets))
    touched = delta.select("bucket").distinct()
    held = _unmerged(spark.read.schema(TABLE).parquet(_part(path, "base")).join(F.broadcast(touched), "bucket", "left_semi"))
    base = _coverage_state(spark, path)[0]
    if base is not None:
        _summed(spark, path).write.mode("overwrite").parquet(_part(path, f"coverage/base={base + 1}"))
    # dealt once, to the task that writes it: a row meets its other copies there. As many tasks
    # as a shuffle has, which AQE merges by size, so that a few large buckets need not spill
    tasks = max(tasks_per_bucket, -(-shuffle_partitions(spark) // num_buckets))
    _write_buckets(_settled(_dealt(held.unionByName(delta), tasks), "bucket", "_slice", KEY), path)
    if base is not None:
        make_dirs(spark, _part(path, f"{LAYOUT_DIR}/folding={base + 1}-{versions[-1]}"))
    _drop_versions(spark, path, versions)
    _finish_folding(spark, path)
    return len(versions)


def _drop_versions(spark: SparkSession, path: str, versions: Sequence[int]) -> None:
    # oldest first: after a stop in between, the newest versions are still the ones laid over
    for v in versions:
        remove_path(spark, _part(path, f"delta/version={v}"))


# The coverage side table. Each version has the changes it made, each fold a new sum of all
# (``coverage/base=<k>``). The layout names the sum in force (``coverage=<k>``); while a fold
# drops its versions it names the new sum and the last of them (``folding=<k>-<v>``), and then
# that sum is in force and those versions count no more. A stop at any point leaves one of
# the two states, and the next merge or fold finishes what was begun.

def _coverage_state(spark: SparkSession, path: str) -> tuple[int | None, int]:
    """(number of the sum in force, last version it holds); None without a side table."""
    names = dict.fromkeys(list_names(spark, _part(path, LAYOUT_DIR)))
    for name in names:
        if name.startswith("folding="):
            base, last = name.split("=", 1)[1].split("-")
            return int(base), int(last)
    return max((int(n.split("=", 1)[1]) for n in names if n.startswith("coverage=")), default=None), 0


def _days(df: DataFrame, sign: int) -> DataFrame:
    """(set_spec, d, n) of records: one of each set's day, and of the day whatever the set."""
    sets = F.array_append(F.array_distinct(F.coalesce("header_setSpecs", F.array().cast("array<string>"))), F.lit(None).cast("string"))
    return df.select(F.explode(sets).alias("set_spec"), F.to_date("header_datestamp").alias("d"), F.lit(sign).cast("bigint").alias("n"))


def _coverage_changes(stored: DataFrame, batch: DataFrame) -> DataFrame:
    """What merging ``batch`` changes: its records' days come, those of the records they replace
    go. Only stored rows with a key of the batch take part."""
    cols = ["header_setSpecs", "header_datestamp", "arrival"]
    old = stored.select(KEY, F.struct(*cols).alias("_o")).join(batch.select(KEY), KEY, "left_semi")
    both = batch.select(KEY, F.struct(*cols).alias("_n")).join(old, KEY, "left")
    wins = both.where(F.col("_o").isNull() | F.coalesce(F.col("_n.arrival") >= F.col("_o.arrival"), F.lit(True)))
    gone = _days(wins.where(F.col("_o").isNotNull()).select("_o.*"), -1)
    return _net(_days(wins.select("_n.*"), 1).unionByName(gone))


def _net(days: DataFrame) -> DataFrame:
    return days.groupBy("set_spec", "d").agg(F.sum("n").alias("n")).where("n <> 0 AND d IS NOT NULL")


def _summed(spark: SparkSession, path: str) -> DataFrame:
    base, held = _coverage_state(spark, path)
    if base is None:
        raise ValueError(f"the table at {path} keeps no coverage")
    parts = [f"coverage/base={base}"] + [f"coverage/version={v}" for v in delta_versions(spark, path) if v > held]
    out = spark.read.schema(COVERAGE).parquet(_part(path, parts[0]))
    for part in parts[1:]:
        out = out.unionByName(spark.read.schema(COVERAGE).parquet(_part(path, part)))
    return _net(out)


def _finish_folding(spark: SparkSession, path: str) -> None:
    """Drop what a fold has summed up and leave its sum in force; nothing if no fold is open."""
    base, held = _coverage_state(spark, path)
    if not held:
        return
    _drop_versions(spark, path, [v for v in delta_versions(spark, path) if v <= held])
    make_dirs(spark, _part(path, f"{LAYOUT_DIR}/coverage={base}"))
    for folder, old in (("coverage", lambda kind, k: k < base if kind == "base" else k <= held), (LAYOUT_DIR, lambda kind, k: kind == "coverage" and k < base)):
        for name in list_names(spark, _part(path, folder)):
            kind, _, k = name.partition("=")
            if k.isdigit() and old(kind, int(k)):
                remove_path(spark, _part(path, f"{folder}/{name}"))
    remove_path(spark, _part(path, f"{LAYOUT_DIR}/folding={base}-{held}"))


def covered_days(spark: SparkSession, path: str) -> DataFrame:
    """The sets and days that have records, from the side table alone: ``header_setSpecs`` (one
    set, or none for the day as such), ``header_datestamp`` (midnight) and ``n`` records.

    ``existing_dates``, ``missing_dates``, ``missing_any_set`` and ``coverage_summary`` take it
    in the place of the records: as many small rows as sets x days, however many records
    there are. Substring matches see one set at a time.
    """
    set_list = F.when(F.col("set_spec").isNotNull(), F.array("set_spec")).otherwise(F.array().cast("array<string>"))
    return _summed(spark, path).select(set_list.alias("header_setSpecs"), F.col("d").cast("timestamp_ntz").alias("header_datestamp"), "n")


def rebucket_table(spark: SparkSession, path: str, new_path: str, num_buckets: int,
                   tasks_per_bucket: int = 1) -> None:
    """Copy a table, deltas folded, into a new one of ``num_buckets`` buckets."""
    if not ensure_table(spark, new_path, num_buckets):
        raise ValueError(f"{new_path} exists")
    write_metadata(read_metadata(spark, path), new_path, num_buckets, tasks_per_bucket=tasks_per_bucket)
