"""Record projection, cleaning and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_datestamp
from ..functions.text import collapse_ws, empty_if_null, first_value, last_value
from ..schemas import MAX_IDENTIFIER_CHARS, MAX_TYPE_CHARS

# Reasons a record is quarantined instead of stored.
REASON_MISSING_ID = "missing_identifier"
REASON_LONG_ID = "identifier_too_long"
REASON_LONG_TYPE = "type_too_long"
REASON_BAD_DATESTAMP = "bad_datestamp"
REASON_DELETED = "deleted"


def flatten_records(exploded: DataFrame, record_col: str = "r",
                    description: str = "first", collapse: bool = True) -> DataFrame:
    """A ``<record>`` struct -> the ten flat record columns.

    Rules: header identifier and datestamp and the type take their last
    occurrence; the description takes the first one (the abstract; later ones
    are comments), whitespace collapsed. ``description="last", collapse=False``
    gives the other rule (last occurrence, raw text). ``title`` is the first
    title collapsed while ``metadata_title`` keeps every title raw. Missing
    repeated elements become ``[]``. Adds ``deleted`` (header status) and keeps
    every other input column.
    """
    r = F.col(record_col)
    h, dc = r["header"], r["metadata"]["dc"]
    if description not in ("first", "last"):
        raise ValueError(f"description must be 'first' or 'last', not {description!r}")
    desc = (first_value if description == "first" else last_value)(dc["description"])
    if collapse:
        desc = collapse_ws(desc)
    keep = [c for c in exploded.columns if c != record_col]
    return exploded.select(
        *keep,
        last_value(h["identifier"]).alias("header_identifier"),
        parse_datestamp(last_value(h["datestamp"])).alias("header_datestamp"),
        empty_if_null(h["setSpec"]).alias("header_setSpecs"),
        empty_if_null(dc["creator"]).alias("metadata_creator"),
        empty_if_null(dc["date"]).alias("metadata_date"),
        desc.alias("metadata_description"),
        empty_if_null(dc["identifier"]).alias("metadata_identifier"),
        empty_if_null(dc["subject"]).alias("metadata_subject"),
        empty_if_null(dc["title"]).alias("metadata_title"),
        last_value(dc["type"]).alias("metadata_type"),
        collapse_ws(first_value(dc["title"])).alias("title"),
        (F.coalesce(h["_status"], F.lit("")) == F.lit("deleted")).alias("deleted"),
    )


def has_identifier(df: DataFrame) -> DataFrame:
    """drop records whose identifier is missing or empty."""
    return df.filter(F.length("header_identifier") > 0)


def exclude_deleted(df: DataFrame) -> DataFrame:
    """drop records whose header carries ``status="deleted"``."""
    return df.filter(~F.col("deleted"))


def validate_records(df: DataFrame, drop_deleted: bool = True) -> DataFrame:
    """F8: tag every record in one pass with ``reasons`` (array) and ``accepted``.

    Reasons: missing/empty key, key over 255 characters, type over 100
    characters, datestamp missing or not a valid date/time, and (by default) a deleted
    header. A rejected row is kept for quarantine, never dropped.
    """
    checks = [
        F.when(F.coalesce(F.length("header_identifier"), F.lit(0)) == 0, F.lit(REASON_MISSING_ID)),
        F.when(F.length("header_identifier") > MAX_IDENTIFIER_CHARS, F.lit(REASON_LONG_ID)),
        F.when(F.length("metadata_type") > MAX_TYPE_CHARS, F.lit(REASON_LONG_TYPE)),
        F.when(F.col("header_datestamp").isNull(), F.lit(REASON_BAD_DATESTAMP)),
    ]
    if drop_deleted and "deleted" in df.columns:
        checks.append(F.when(F.col("deleted"), F.lit(REASON_DELETED)))
    reasons = F.array_compact(F.array(*checks))
    return df.withColumn("reasons", reasons).withColumn("accepted", F.size("reasons") == 0)


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col("accepted"))


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.filter(~F.col("accepted"))


def clean_records(exploded: DataFrame, record_col: str = "r") -> DataFrame:
    """P1 -> F1 -> F2: the records a harvest keeps (no length checks)."""
    return exclude_deleted(has_identifier(flatten_records(exploded, record_col)))
