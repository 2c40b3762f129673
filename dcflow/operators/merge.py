"""Last-write-wins merge by identifier.

``latest_per_key`` is a grouped ``max_by`` over the arrival order, which Spark
runs as a partial aggregate on the map side: a key written many times in one
batch is reduced to one row per task before the shuffle, so a hot key does not
pile up in one reducer. The merge itself is a full outer join on a key that is
unique on both sides, so its shuffle is even.

``arrival_key`` is the order in which a harvest sees its records: landing time, then page,
then place on the page. It is a value of the row, not of the run that merges it, so rows may
be merged in any batches and in any order and the same one wins.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import lit_ts
from ..schemas import UPDATE_COLUMNS

KEY = "header_identifier"


def _order(seq: Sequence[str | Column]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in seq]
    return cols[0] if len(cols) == 1 else F.struct(*cols)


def micros(at: Column, ntz: bool = True) -> Column:
    """Microseconds since 1970 of a UTC wall-clock time (or of a zoned timestamp)."""
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, at) if ntz else F.unix_micros(at)


def arrival_key(df: DataFrame, as_of: str | _dt.datetime | Column) -> Column:
    """``struct(at, path, pos)`` of each row, from its columns ``landed_at``, ``path`` and ``pos``
    as far as it has them. A row without landing time arrives at ``as_of``."""
    at = micros(lit_ts(as_of))
    if "landed_at" in df.columns:
        at = F.coalesce(micros(F.col("landed_at"), df.schema["landed_at"].dataType == T.TimestampNTZType()), at)
    path = F.col("path") if "path" in df.columns else F.lit(None)
    pos = F.col("pos") if "pos" in df.columns else F.lit(None)
    return F.struct(at.alias("at"), path.cast("string").alias("path"), pos.cast("bigint").alias("pos"))


def latest_per_key(df: DataFrame, seq: Sequence[str | Column], key: str = KEY) -> DataFrame:
    """Per key, the row that is last in arrival order ``seq``.

    ``seq`` must totally order the rows of a key (e.g. run, page, position);
    the datestamp is not consulted, so a later write with an older datestamp
    still wins. Output has the input's columns.
    """
    others = [c for c in df.columns if c != key]
    latest = F.max_by(F.struct(*others), _order(seq)).alias("_v")
    return df.groupBy(key).agg(latest).select(key, *[F.col(f"_v.{c}").alias(c) for c in others])


def match_existing(base: DataFrame, incoming: DataFrame, key: str = KEY) -> DataFrame:
    """Tag each incoming row ``insert`` (key not stored) or ``update``.

    The stored keys are semi-joined against the incoming keys, so only keys
    that are in both ever leave the base side. The joins are left to Spark's
    statistics and AQE; no extra pass counts the incoming keys.
    """
    keys = incoming.select(key).distinct()
    hit = base.select(key).join(keys, key, "left_semi").distinct() \
              .withColumn("_stored", F.lit(True))
    return incoming.join(hit, key, "left").withColumn(
        "action", F.when(F.col("_stored"), F.lit("update")).otherwise(F.lit("insert"))
    ).drop("_stored")


def upsert(base: DataFrame, incoming: DataFrame, as_of: str | _dt.datetime | Column,
           seq: Sequence[str | Column] | None = None, key: str = KEY,
           columns: Sequence[str] = UPDATE_COLUMNS, dedupe: bool = True,
           arrival: str | None = None) -> DataFrame:
    """K1: ``INSERT ... ON CONFLICT (key) DO UPDATE`` as a DataFrame.

    New keys are inserted with ``created_at = updated_at = as_of``; a stored
    key gets the incoming values of ``columns`` and ``updated_at = as_of`` and
    keeps its ``created_at`` (the earlier of the stored value and ``as_of``);
    stored keys absent from the batch are unchanged. ``base`` must carry
    ``created_at`` and ``updated_at``. Extra base columns (e.g. ``bucket``) are
    recomputed by the caller. ``arrival`` names an order column both sides carry: then a
    stored key is only updated by a row that did not arrive before it.
    """
    at = lit_ts(as_of)
    if arrival:
        columns = [*columns, arrival]
    if dedupe and seq:
        wanted = list(dict.fromkeys([key, *columns, *_seq_cols(seq)]))
        inc = latest_per_key(incoming.select(*wanted), seq, key)
    else:
        inc = incoming
    inc = inc.select(key, *columns).withColumn("_in", F.lit(True))
    old = base.select(key, *columns, "created_at", "updated_at").withColumn("_old", F.lit(True))
    j = old.alias("o").join(inc.alias("i"), key, "full_outer")
    fresh = F.col("i._in").isNotNull()
    if arrival:
        fresh &= F.col("o._old").isNull() | F.coalesce(F.col(f"i.{arrival}") >= F.col(f"o.{arrival}"), F.lit(True))
    out = [F.col(key)]
    for c in columns:
        out.append(F.when(fresh, F.col(f"i.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
    out.append(F.least(F.col("o.created_at"), F.when(F.col("i._in").isNotNull(), at)).alias("created_at"))
    out.append(F.when(fresh, at).otherwise(F.col("o.updated_at")).alias("updated_at"))
    return j.select(*out)


def _seq_cols(seq: Sequence[str | Column] | None) -> list[str]:
    return [c for c in (seq or []) if isinstance(c, str)]
