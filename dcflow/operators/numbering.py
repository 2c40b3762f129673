"""Row numbers within a group that stay parallel when one group is huge.

``row_number().over(partitionBy(g).orderBy(o))`` sends a whole group to one
task; if one set or client holds a third of all rows, that task holds a third
of the data. So every group, of whatever size, is numbered like this:

0. write the rows to the shared scratch folder, since range partitioning reads its
   input twice (once to sample it);
1. range-partition on ``(g, o)`` and sort within partitions, so a large group is
   cut into many contiguous, ordered slices; record each row's partition and
   position; write that to the shared scratch folder as Parquet, so positions are
   fixed even if a task or executor is lost later;
2. per ``(partition, group)`` cell count rows and note the first position: at
   most ``partitions + groups`` cells;
3. a running sum over the cells of each group gives every cell its offset;
4. join the cells back on the partition and the group; a cell's rows are at most
   a partition's, and AQE chooses the join.

The order columns must form a total order within each group (add a unique
tie-break) so the numbering is deterministic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path, shuffle_partitions, written


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                out: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based row number of each row within its ``group`` in ``order``."""
    spark = df.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    keys = [F.col(g) for g in group] + [_col(o) for o in order]
    pid = F.spark_partition_id()
    ranged = (written(df, scratch_path(spark, "unnumbered")).repartitionByRange(n, *keys)
                .sortWithinPartitions(*keys)
                .withColumn("_pid", pid)
                .withColumn("_pos", F.monotonically_increasing_id()
                            - F.shiftleft(pid.cast("bigint"), 33)))
    ranged = written(ranged, scratch_path(spark, "numbered"))

    cells = ranged.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_cnt"),
                                               F.min("_pos").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_pid") \
                   .rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0))) \
                 .drop("_cnt")

    a, b = ranged.alias("_a"), cells.alias("_b")
    cond = F.col("_a._pid") == F.col("_b._pid")
    for g in group:
        cond = cond & F.col(f"_a.{g}").eqNullSafe(F.col(f"_b.{g}"))
    joined = a.join(b, cond, "inner")
    rn = F.col("_b._off") + F.col("_a._pos") - F.col("_b._first") + F.lit(1)
    return joined.select(*[F.col(f"_a.{c}") for c in df.columns], rn.cast("bigint").alias(out))


def sliced(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
           num_partitions: int | None = None) -> DataFrame:
    """The rows written in slices of ``(group, order)``, with the slice ``_pid`` and the place
    ``_pos`` in it: what ``running_sum`` works on."""
    spark = df.sparkSession
    keys = [F.col(g) for g in group] + [_col(o) for o in order]
    pid = F.spark_partition_id()
    ranged = (written(df, scratch_path(spark, "unsliced")).repartitionByRange(num_partitions or shuffle_partitions(spark), *keys)
                .sortWithinPartitions(*keys).withColumn("_pid", pid)
                .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)))
    return written(ranged, scratch_path(spark, "sliced"))


def running_sum(slices: DataFrame, group: Sequence[str], value: str, out: str) -> DataFrame:
    """Add ``out``, the sum of ``value`` over a row and all before it in its group, to ``sliced``
    rows. A window sums within a slice, which is a task's share of the rows however large
    the group, and the slices before it come as one number."""
    inside = Window.partitionBy("_pid", *group).orderBy("_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    cells = slices.groupBy("_pid", *group).agg(F.sum(value).alias("_sum")).withColumn(
        "_off", F.coalesce(F.sum("_sum").over(before), F.lit(0))).drop("_sum")
    a, b = slices.withColumn(out, F.sum(value).over(inside)).alias("_a"), cells.alias("_b")
    cond = F.col("_a._pid") == F.col("_b._pid")
    for g in group:
        cond = cond & F.col(f"_a.{g}").eqNullSafe(F.col(f"_b.{g}"))
    total = F.col(f"_a.{out}") + F.col("_b._off")
    return a.join(b, cond).select(*[F.col(f"_a.{c}") for c in slices.columns], total.alias(out))


def previous_row(numbered: DataFrame, group: Sequence[str], cols: Sequence[str],
                 rn: str = "rn", prefix: str = "prev_") -> DataFrame:
    """Attach columns of the previous row of the same group (``lag`` by one).

    An equi-join on ``(group, rn - 1)``: every key is unique, so the shuffle is
    even however large one group is. The first row of a group gets NULLs.
    """
    prev = numbered.select(*[F.col(g).alias(f"_k_{g}") for g in group],
                           (F.col(rn) + F.lit(1)).alias("_k_rn"),
                           *[F.col(c).alias(prefix + c) for c in cols])
    cond = F.col(rn) == F.col("_k_rn")
    for g in group:
        cond = cond & F.col(g).eqNullSafe(F.col(f"_k_{g}"))
    out = numbered.join(prev, cond, "left")
    return out.drop("_k_rn", *[f"_k_{g}" for g in group])
