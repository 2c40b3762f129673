"""Coverage: which days of a range have stored records, per set (J1-J3, J5,
A1, A2, U2, W2).

Scale notes. The records side is reduced to distinct ``(set_spec, day)`` pairs
with a partial (map-side) aggregate before any shuffle, so however many
records one set holds, only ``sets x days`` small rows move. The day spine is
generated (``explode(sequence(...))``), not joined, and is bounded by
``sets x days in range``. The anti join then compares two tables of that bound.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import days_between, harvest_date, lit_date, ordered_bounds
from ..functions.jsonfmt import array_to_json
from ..session import checkpoint_dir, scratch_path, written
from .query import date_between

DateLike = str | _dt.date | Column | None
# Set names are looked up by three of their characters.
GRAM = 3


def sets_frame(spark: SparkSession, sets: Sequence[str] | DataFrame) -> DataFrame:
    """The requested set names as a one-column DataFrame ``set_spec``."""
    if isinstance(sets, DataFrame):
        return sets.select(F.col(sets.columns[0]).cast("string").alias("set_spec"))
    return spark.createDataFrame([(s,) for s in dict.fromkeys(sets)], "set_spec string")


def set_date_spine(spark: SparkSession, sets: Sequence[str] | DataFrame, lo: DateLike,
                   hi: DateLike, end_inclusive: bool = True) -> DataFrame:
    """Every requested set x every day of ``[lo, hi]`` as ``(set_spec, d)``.

    Reversed bounds are swapped; an invalid bound gives no rows.
    """
    days = days_between(lit_date(lo), lit_date(hi), end_inclusive)
    return sets_frame(spark, sets).select("set_spec", F.explode(days).alias("d"))


def prepared_sets(sets: Sequence[str] | DataFrame | None):
    """A requested-sets DataFrame reduced to distinct names and checkpointed once: it may be
    derived from a large scan and is used by the spine and by the join. Whether the names are
    broadcast is left to AQE. Lists and None pass through."""
    if not isinstance(sets, DataFrame) or getattr(sets, "_dcflow_prepared", False):
        return sets
    checkpoint_dir(sets.sparkSession)
    out = sets.select(F.col(sets.columns[0]).cast("string").alias("set_spec")).distinct().checkpoint(eager=True)
    out._dcflow_prepared = True
    return out


def records_in_sets(df: DataFrame, sets: Sequence[str] | DataFrame, match: str = "exact",
                    col: str = "header_setSpecs") -> DataFrame:
    """One row per (record, requested set the record belongs to), column
    ``set_spec`` added.

    ``exact``: the set is one of the record's sets. ``substring``: the name
    occurs in the JSON text of the record's set list. A list of set names is
    matched by an array expression per record (a generator, no join and no
    shuffle). A DataFrame of names is semi-joined on the exploded set, or, for
    substrings, meets the distinct set lists through ``names_in_texts``; that reads ``df`` twice,
    so records that are costly to make are best written first.
    """
    if isinstance(sets, DataFrame):
        if match == "substring":
            rows = df.withColumn("_sets_text", array_to_json(col))
            hits = names_in_texts(rows.select(F.col("_sets_text").alias("text")).distinct(), prepared_sets(sets))
            return rows.join(hits.withColumnsRenamed({"text": "_sets_text", "name": "set_spec"}), "_sets_text").select(*df.columns, "set_spec")
        if match != "exact":
            raise ValueError(f"match must be 'exact' or 'substring', not {match!r}")
        exploded = df.withColumn("set_spec", F.explode(F.array_distinct(F.col(col))))
        return exploded.join(prepared_sets(sets), "set_spec", "left_semi")
    wanted = F.array(*[F.lit(s) for s in dict.fromkeys(sets)]) if sets else F.array().cast("array<string>")
    if match == "exact":
        hits = F.array_intersect(F.col(col), wanted)
    elif match == "substring":
        text = array_to_json(col)
        hits = F.filter(wanted, lambda s: F.instr(text, s) > 0)
    else:
        raise ValueError(f"match must be 'exact' or 'substring', not {match!r}")
    return df.withColumn("set_spec", F.explode(hits))


def names_in_texts(texts: DataFrame, names: DataFrame, size: int = GRAM) -> DataFrame:
    """Every (text, name) with the name somewhere in the text, both distinct columns of their
    frames' first columns, as ``text`` and ``name``.

    A name is looked up by one of its grams of ``size`` characters (a shorter name by itself),
    the one that the fewest texts hold, in an index of the texts' grams; what the lookup finds
    is then compared in full. An equi-join on the gram, so no text meets a name that shares
    nothing with it; a gram of many texts is used only by names all of whose grams are as
    common. The empty name, whose only gram is empty, is in every text.
    """
    t = texts.select(F.col(texts.columns[0]).cast("string").alias("text")).where("text IS NOT NULL")
    n = names.select(F.col(names.columns[0]).cast("string").alias("name")).where("name IS NOT NULL")

    def grams(c: str, width: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(c) - width + 1)
        return F.when(F.length(c) >= width, F.array_distinct(F.transform(starts, lambda i: F.substr(F.col(c), i, width))))

    none = F.array().cast("array<string>")
    widths = F.array(*[F.lit(w) for w in range(size + 1)])        # shorter names look themselves up
    index = t.select("text", F.explode(F.flatten(F.transform(widths, lambda w: F.coalesce(grams("text", w), none)))).alias("gram"))
    wanted = n.select("name", F.explode(grams("name", F.least(F.length("name"), F.lit(size)))).alias("gram"))
    found = written(index.join(wanted.select("gram").distinct(), "gram", "left_semi"), scratch_path(t.sparkSession, "grams"))
    spread = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    # a gram that no text holds rules its name out
    rarest = wanted.join(spread, "gram", "left").groupBy("name").agg(
        F.min_by("gram", F.struct("n", "gram")).alias("gram"), F.bool_and(F.col("n").isNotNull()).alias("all"))
    hits = found.join(rarest.where("all").select("name", "gram"), "gram")
    return hits.where(F.instr(F.col("text"), F.col("name")) > 0).select("text", "name")


def existing_dates(df: DataFrame, sets: Sequence[str] | DataFrame | None, lo: DateLike,
                   hi: DateLike, match: str = "exact",
                   ts_col: str = "header_datestamp") -> DataFrame:
    """A1: ``SELECT DISTINCT DATE(ts)`` per requested set within ``[lo, hi]``.

    With ``sets=None`` there is no set predicate and ``set_spec`` is NULL.
    The date range is applied to the timestamp first (pushed to the scan).
    With a DataFrame of sets, records are first reduced to distinct
    ``(set, day)`` pairs (partial aggregate), and only those meet the sets.
    """
    a, b = ordered_bounds(lit_date(lo), lit_date(hi))
    rows = df.select(ts_col, "header_setSpecs").filter(date_between(a, b, ts_col))
    if sets is None:
        rows = rows.withColumn("set_spec", F.lit(None).cast("string"))
    elif isinstance(sets, DataFrame):
        if match != "exact":
            # written, or the records would be read for the texts and again for the match
            pairs = written(rows.select("header_setSpecs", harvest_date(ts_col).alias("d")).distinct(), scratch_path(df.sparkSession, "set-days"))
            return records_in_sets(pairs, sets, match).select("set_spec", "d").distinct()
        pairs = rows.select(F.explode(F.array_distinct("header_setSpecs")).alias("set_spec"),
                            harvest_date(ts_col).alias("d")).distinct()
        return pairs.join(prepared_sets(sets), "set_spec", "left_semi")
    else:
        rows = records_in_sets(rows, sets, match)
    return rows.select("set_spec", harvest_date(ts_col).alias("d")).distinct()


def missing_dates(df: DataFrame, sets: Sequence[str] | DataFrame, lo: DateLike, hi: DateLike,
                  match: str = "exact", end_inclusive: bool = True) -> DataFrame:
    """Days of the spine with no stored record, per set: ``(set_spec, d)``."""
    spark = df.sparkSession
    sets = prepared_sets(sets)
    spine = set_date_spine(spark, sets, lo, hi, end_inclusive)
    have = existing_dates(df, sets, lo, hi, match)
    return spine.join(have, ["set_spec", "d"], "left_anti")


def missing_any_set(df: DataFrame, lo: DateLike, hi: DateLike,
                    end_inclusive: bool = True) -> DataFrame:
    """Days of ``[lo, hi]`` with no stored record at all: ``(d)``."""
    spark = df.sparkSession
    days = spark.range(1).select(
        F.explode(days_between(lit_date(lo), lit_date(hi), end_inclusive)).alias("d"))
    have = existing_dates(df, None, lo, hi).select("d")
    return days.join(have, ["d"], "left_anti")


def date_difference(all_days: DataFrame, existing: DataFrame) -> DataFrame:
    """One list of days minus another, keeping repeats of the first."""
    return all_days.exceptAll(existing)


def coverage_summary(df: DataFrame, sets: Sequence[str] | DataFrame, lo: DateLike, hi: DateLike,
                     match: str = "exact", end_inclusive: bool = True) -> DataFrame:
    """A2: per set, days in range, days with records, days missing."""
    spark = df.sparkSession
    sets = prepared_sets(sets)
    spine = set_date_spine(spark, sets, lo, hi, end_inclusive)
    have = existing_dates(df, sets, lo, hi, match).withColumn("_has", F.lit(True))
    joined = spine.join(have, ["set_spec", "d"], "left")
    return joined.groupBy("set_spec").agg(
        F.count(F.lit(1)).alias("total_days"),
        F.count_if(F.col("_has").isNotNull()).alias("existing_days"),
        F.count_if(F.col("_has").isNull()).alias("missing_days"),
    )


def chunk_dates(missing: DataFrame, size: int = 7, group: str = "set_spec",
                day: str = "d") -> DataFrame:
    """Consecutive groups of ``size`` missing days per set (not calendar
    weeks): ``chunk_no`` (0-based) and ``chunk_pos`` (0-based).

    A group here is one set's missing days, bounded by the days of the range,
    so a plain window is safe.
    """
    w = Window.partitionBy(group).orderBy(day)
    rn = F.row_number().over(w) - 1
    return missing.withColumn("_rn", rn) \
                  .withColumn("chunk_no", F.floor(F.col("_rn") / size).cast("bigint")) \
                  .withColumn("chunk_pos", (F.col("_rn") % size).cast("int")) \
                  .drop("_rn")
