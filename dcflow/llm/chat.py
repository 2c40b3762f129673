"""Chat formatting: cumulative snapshots collapse into the longest conversation.

Logs often hold a conversation once per turn, each time one turn longer. Turn k of a
conversation gets a rolling hash of its first k turns. A conversation whose last hash is an
inner hash of another is a prefix of it and goes, by an anti-join; of conversations equal as
a whole that with the smallest id stays. Only those left are rendered.

The hash is 128 bits: two running xors of position-salted turn hashes, so it is one window
over a conversation, which streams and spills. Defined results: a null role or text is
empty; a null turn number comes first; turns of equal number are ordered by role and text; a repeated row is a turn of its
own; rows without conv_id are one conversation, whose id is null and larger than any other;
an empty table gives an empty result; extra columns are ignored. Built-in expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

PREFIX = ["n", "h1", "h2"]


def turn_table(conversations: DataFrame) -> DataFrame:
    return conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
                                *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, n, h1, h2, last): the rolling hash of the first n turns, and whether they are all."""
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    one = turns.select("conv_id", "turn", "role", "text", F.row_number().over(w).alias("n"), F.lead(F.lit(1)).over(w).isNull().alias("last"))
    rolling = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "n", "role", F.lit(0), "text")).over(so_far)
    return one.select("conv_id", "n", rolling(1).alias("h1"), rolling(2).alias("h2"), "last")


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that are no prefix of another."""
    hashes = staged(prefix_hashes(turns), "turn-hashes")
    whole = hashes.where("last").groupBy(*PREFIX).agg(F.min("conv_id").alias("conv_id"))
    inner = hashes.where("NOT last").select(*PREFIX).distinct()
    return whole.join(inner, PREFIX, "left_anti").select("conv_id", F.col("n").cast("long").alias("n_turns"))


def render(turns: Column) -> Column:
    """ChatML text of an array of (turn, role, text) structs."""
    return F.array_join(F.transform(F.array_sort(turns), lambda x: F.concat(
        F.lit("<|im_start|>"), x["role"], F.lit("\n"), x["text"], F.lit("<|im_end|>\n"))), "")


def collapse(conversations: DataFrame) -> DataFrame:
    """conv_id, n_turns and the rendered text of each maximal conversation."""
    turns = turn_table(conversations)
    keep = maximal(turns).select(F.col("conv_id").alias("keep_id"), "n_turns")
    left = turns.join(keep, turns["conv_id"].eqNullSafe(keep["keep_id"]))
    return (left.groupBy("conv_id").agg(F.max("n_turns").alias("n_turns"), F.collect_list(F.struct("turn", "role", "text")).alias("turns"))
            .select("conv_id", "n_turns", render(F.col("turns")).alias("text")))
