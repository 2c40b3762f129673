"""Hard negatives by LEMP-style coordinate pruning.

Rows are range-partitioned by length and written in blocks of bounded size, longest first:
the length buckets. A bucket holds, for every coordinate, its unit vectors' values in
order. A search wants rows whose inner product with an anchor reaches a threshold: a bucket
too short for it is passed over, and an angle of at most acos(threshold / lengths) confines
each coordinate of a partner to a range. The ranges of the anchor's largest coordinates (its
focus) are looked up in the sorted lists and their row sets intersected; what is left is
verified exactly, in integers. Thresholds rise as a task finds partners, bucket by bucket.

Two searches follow one another: the positives, the best rows of an anchor's own label, then
for each positive the best rows of other labels inside its band of scores. Anchors are the
query set: they meet all rows block by block, a pass each, and a block is one row of at most
``ANCHOR_VALUES`` components (2 MB), which is broadcast while the rows stay where they are. A
task keeps the best few of each anchor, and the tasks' bests meet in one small shuffle.

Defined results: rows with a null id, label or vector or a null or non-finite component take
no part; vectors meet only vectors of as many components; a row is another than the anchor if
its id is another, and repeated rows count as often as they occur, as anchors too; of equal
scores the smaller id comes first; a zero or empty vector scores zero; an empty table has no triples; extra
columns are ignored. Components must be below 2^47 so that ``scale`` times them is a long;
scores beyond 2^53 are summed in Python's integers, and must fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dcflow.operators.numbering import number_rows
from dcflow.session import make_dirs, scratch_path, shuffle_partitions

from .common import staged

ROW_VALUES, ANCHOR_VALUES = 1 << 17, 1 << 18  # components a block: 2048 and 4096 vectors of 64
FOCUS = 4
SLACK = 1e-9  # of the range ends, whose square roots are rounded
EXACT = 1 << 53
FOUND = "dims int, rn long, anchor_id long, goal int, positive_id long, positive_score long, other_id long, score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def integer_vectors(rows: DataFrame, scale: int, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, v, dims) of the rows that take part, v being floor(scale * x)."""
    v = F.col(vector).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & sound).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.transform(v, lambda x: F.floor(x * scale).cast("bigint")).alias("v")).withColumn("dims", F.size("v"))


def _pack(ids: list, labels: list, vectors: list) -> list[bytes]:
    return [np.array(x, "<i8").tobytes() for x in (ids, labels, list(vectors))]


def _unpack(dims: int, ids: bytes, labels: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, "<i8")
    return i, np.frombuffer(labels, "<i8"), np.frombuffer(vectors, "<i8").reshape(len(i), dims)


def length_buckets(vectors: DataFrame, values: int = ROW_VALUES) -> DataFrame:
    """The rows in packed blocks of at most ``values`` components (one vector at least), longest
    first within a partition, partitions by range of length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block() -> pa.RecordBatch:
            ids, labels, vs = zip(*held)
            return pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), *[pa.array([x], pa.binary()) for x in _pack(ids, labels, vs)]],
                                              names=["dims", "ids", "labels", "vectors"])

        held, dims = [], 0
        for b in batches:
            for *row, size in zip(*(c.to_pylist() for c in b.columns)):
                if held and (size != dims or (len(held) + 1) * size > values):
                    yield block()
                    held = []
                dims = size
                held.append(row)
        if held:
            yield block()

    length = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    keys = [F.col("dims"), F.col("length").desc(), F.col("vec_id")]
    ranged = vectors.withColumn("length", length).repartitionByRange(shuffle_partitions(vectors.sparkSession), *keys).sortWithinPartitions(*keys)
    return ranged.select("vec_id", "label", "v", "dims").mapInArrow(run, "dims int, ids binary, labels binary, vectors binary")


def scores(rows: np.ndarray, anchor: np.ndarray, small: bool) -> np.ndarray:
    """Exact inner products of integer rows with an integer anchor; ``small``: doubles hold them."""
    if small:
        return (rows.astype(np.float64) @ anchor.astype(np.float64)).astype(np.int64)
    return np.array([sum(map(int.__mul__, r, anchor.tolist())) for r in rows.tolist()], np.int64)


class Bucket:
    """A block of rows of similar length with its sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.top = int(np.abs(vectors).max(initial=0))
        v = vectors.astype(np.float64)
        self.doubles = v
        lengths = np.sqrt((v * v).sum(axis=1))
        self.longest = float(lengths.max(initial=0))
        unit = v / np.where(lengths, lengths, 1)[:, None]
        self.order = np.argsort(unit, axis=0, kind="stable")
        self.sorted = np.ascontiguousarray(np.take_along_axis(unit, self.order, axis=0).T)
        self.order = np.ascontiguousarray(self.order.T)
        self.all = np.arange(len(ids))

    def candidates(self, unit: np.ndarray, focus: np.ndarray, length: float, wanted: float) -> np.ndarray:
        """The rows that may score ``wanted`` or more with an anchor of this unit vector and length."""
        if wanted <= 0:
            return self.all
        if not length * self.longest or wanted / (length * self.longest) > 1 + SLACK:
            return self.all[:0]
        near = min(wanted / (length * self.longest), 1.0)  # the least cosine that can do
        u = unit[focus]
        side = np.sqrt(np.maximum(0, 1 - u * u) * (1 - near * near))
        # where the coordinate's own axis is within the angle, all values up to it are feasible
        low = np.where(u <= -near, -1.0, u * near - side) - SLACK
        high = np.where(u >= near, 1.0, u * near + side) + SLACK
        ranges = sorted(((int(np.searchsorted(self.sorted[f], a, "left")), int(np.searchsorted(self.sorted[f], z, "right")), f)
                         for f, a, z in zip(focus, low, high)), key=lambda r: r[1] - r[0])
        found = None
        for start, stop, f in ranges:
            if stop - start > len(self.all) // 2:  # this list excludes little, and the next ones less
                break
            if found is None:
                found = self.order[f, start:stop]
            else:
                inside = np.zeros(len(self.all), bool)
                inside[self.order[f, start:stop]] = True
                found = found[inside[found]]
        return self.all if found is None else found


class Anchors:
    """A block of anchors, each with goals (number, positive, its score, lowest and highest
    score wanted), and the best ``keep`` partners found so far for every goal."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, keep: int, same: bool):
        self.ids, self.labels, self.vectors, self.keep, self.same = ids, labels, vectors, keep, same
        self.top = int(np.abs(vectors).max(initial=0))
        v = vectors.astype(np.float64)
        self.lengths = np.sqrt((v * v).sum(axis=1))
        self.unit = v / np.where(self.lengths, self.lengths, 1)[:, None]
        self.focus = np.argsort(-np.abs(self.unit), axis=1, kind="stable")[:, :FOCUS]
        self.aim([[(0, None, None, -np.inf, np.inf)] for _ in ids])

    def aim(self, goals: list[list[tuple]]) -> None:
        none = np.zeros(0, np.int64)
        self.goals, self.best = goals, [[(none, none) for _ in g] for g in goals]

    def _floor(self, k: int, g: int) -> float:
        """The lowest score with which a row can still be among the best of a goal."""
        held, low = self.best[k][g][0], self.goals[k][g][3]
        return max(low, held[-1]) if len(held) == self.keep else low

    def search(self, bucket: Bucket) -> None:
        small = self.top * bucket.top * max(1, self.vectors.shape[1]) < EXACT
        for k, goals in enumerate(self.goals):
            wanted = min((self._floor(k, g) for g in range(len(goals))), default=np.inf)
            if wanted == np.inf:
                continue
            rows = bucket.candidates(self.unit[k], self.focus[k], self.lengths[k], wanted)
            apt = (bucket.labels[rows] == self.labels[k]) == self.same
            rows = rows[apt & (bucket.ids[rows] != self.ids[k])]
            if not len(rows):
                continue
            s = scores((bucket.doubles if small else bucket.vectors)[rows], self.vectors[k], small)
            for g, (*_, high) in enumerate(goals):
                fit = (s >= self._floor(k, g)) & (s <= high)
                if fit.any():
                    held, ids = self.best[k][g]
                    score, i = np.concatenate([held, s[fit]]), np.concatenate([ids, bucket.ids[rows[fit]]])
                    top = np.lexsort((i, -score))[:self.keep]
                    self.best[k][g] = score[top], i[top]

    def found(self) -> Iterator[tuple]:
        for k, anchor in enumerate(self.ids.tolist()):
            for (goal, positive, score, _, _), (s, i) in zip(self.goals[k], self.best[k]):
                yield from ((k, anchor, goal, positive, score, other, one) for one, other in zip(s.tolist(), i.tolist()))


def _search(keep: int, low: int, high: int, same: bool):
    """A pass over buckets that all carry the same packed block of anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, dims, first = None, None, 0
        for b in batches:
            for row in range(b.num_rows):
                value = lambda i: b.column(i)[row].as_py()  # noqa: E731, B023
                if block is None:
                    dims, first = value(0), value(4)
                    block = Anchors(*_unpack(dims, value(5), value(6), value(7)), keep, same)
                    if not same:
                        goals: list[list[tuple]] = [[] for _ in block.ids]
                        for k, goal, positive, score in np.frombuffer(value(8), "<i8").reshape(-1, 4).tolist():
                            least, most = -(-low * score // 100), high * score // 100
                            if least <= most:
                                goals[k].append((goal, positive, score, least, most))
                        block.aim(goals)
                block.search(Bucket(*_unpack(dims, value(1), value(2), value(3))))
        rows = [(dims, first + r[0], *r[1:]) for r in block.found()] if block else []
        if rows:
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=[c.split()[0] for c in FOUND.split(", ")])

    return run


def _best(found: DataFrame, keep: int) -> DataFrame:
    """The best ``keep`` partners of each goal, of which each task has given its own best."""
    order = Window.partitionBy("dims", "rn", "goal").orderBy(F.col("score").desc(), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def anchor_blocks(anchors: DataFrame, values: int = ANCHOR_VALUES) -> DataFrame:
    """The anchors, numbered by vec_id among those of as many components, in packed blocks of at
    most ``values`` components (one vector at least): dims, first (number), and the vectors."""
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["rn", "vec_id", "label", "v", "dims"]).to_pylist(), key=lambda r: r["rn"])
        packed = _pack(*([r[c] for r in rows] for c in ("vec_id", "label", "v")))
        return pa.table([pa.array([rows[0]["dims"]], pa.int32()), pa.array([rows[0]["rn"]], pa.int64()), *[pa.array([x], pa.binary()) for x in packed]],
                        names=["dims", "first", "a_ids", "a_labels", "a_vectors"])

    numbered = number_rows(anchors.withColumn("_row", F.monotonically_increasing_id()), ["dims"], ["vec_id", "_row"])
    each = F.greatest(F.lit(1), F.expr(f"{values} div greatest(1, dims)"))
    return numbered.withColumn("block", F.floor((F.col("rn") - 1) / each)).groupBy("dims", "block").applyInArrow(
        run, "dims int, first long, a_ids binary, a_labels binary, a_vectors binary")


def _goals(table: pa.Table) -> pa.Table:
    """A block's positives as one value: anchor's place, goal, positive, score."""
    first = table.column("first")[0].as_py()
    told = [(r["rn"] - first, r["rank"], r["other_id"], r["score"]) for r in table.to_pylist() if r["rn"] is not None]
    return pa.table([pa.array([first], pa.int64()), pa.array([np.array(told, "<i8").tobytes()], pa.binary())], names=["first", "goals"])


def mine(rows: DataFrame, is_anchor: Column, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
         vector: str = "embedding", row_values: int = ROW_VALUES, anchor_values: int = ANCHOR_VALUES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each
    anchor's first ``n_positives`` rows of its label, the first ``n_negatives`` rows of other
    labels whose score is ``low`` to ``high`` percent of the positive's."""
    spark = rows.sparkSession
    vectors = staged(integer_vectors(rows, scale, vector), "vectors")
    buckets = staged(length_buckets(vectors, row_values), "length-buckets")
    blocks = staged(anchor_blocks(vectors.where(is_anchor), anchor_values), "anchor-blocks")
    out = scratch_path(spark, "hard-negatives")
    carried = ["dims", "ids", "labels", "vectors", "first", "a_ids", "a_labels", "a_vectors"]
    for dims, first in sorted(map(tuple, blocks.select("dims", "first").collect())):  # two numbers a block
        of = (F.col("dims") == dims) & (F.col("first") == first)
        rows_of = buckets.where(F.col("dims") == dims)

        def search(block: DataFrame, keep: int, same: bool, extra: list[str]) -> DataFrame:
            pairs = rows_of.join(F.broadcast(block), "dims").select(*carried, *extra)  # noqa: B023
            return _best(pairs.mapInArrow(_search(keep, low, high, same), FOUND), keep)

        block = blocks.where(of)
        positives = staged(search(block, n_positives, True, []).withColumn("first", F.lit(first).cast("bigint")), "positives")
        told = positives.select("first", "rn", "rank", "other_id", "score").groupBy("first").applyInArrow(_goals, "first long, goals binary")
        negatives = search(block.join(told, "first"), n_negatives, False, ["goals"])
        negatives.select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score",
                         F.col("score").alias("negative_score")).write.mode("append").parquet(out)
    make_dirs(spark, out)
    return spark.read.schema(RESULT).parquet(out)
