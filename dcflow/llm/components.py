"""Connected components of an edge table by alternating large-star and small-star rounds.

Every round is two partial aggregations and two joins on node ids; the table of edges is
written to the shared scratch folder after each round, in as many files as its rows need, so
the lineage stays short. A star centre with many neighbours is pre-aggregated and its joins can be split by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    told = both.join(least, "u")
    out = told.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")) if large else \
        told.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, n_edges: int | None = None) -> DataFrame:
    """(node, root) for every node of the edge table (a, b); root is the component's least node.
    ``n_edges``: about how many edges there are, if known."""
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a <> b").distinct(), "components", rows=n_edges)
    mark, rows = None, now.count()
    while True:
        # a large star has at most the rows of its edges, a small star twice as many
        now = staged(_star(_star(now, True), False), "components", rows=2 * rows)
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first()
        if seen == mark:
            break
        mark, rows = seen, seen[0]
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
