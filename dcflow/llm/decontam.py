"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

1. Test items become word-hash sequences; their n-grams are the seeds. A bitmap over all
   seeds is broadcast, so the scan of the documents keeps only passages around positions that
   may hold a seed; false positives fall out in the join that follows. Items are dealt into
   classes of length, so a passage reaches only as far as the longest item of its class.
2. Rare seeds, those met in few passages or few items, join directly: what they make is linear
   in the hits. A seed that is common on both sides (a phrase of many items) is made rare by
   a word: a window can only reach the threshold if it holds that many of the item's words,
   so it holds one of the item's ``n - threshold + 1`` words that are rarest among the items of
   that seed. Such (seed, word) pairs join instead; no window that could qualify is lost.
3. Each (passage, item, diagonal) gives one window of three item lengths. A score is at most
   the number of the item's words that the window has, so windows with too few are left out;
   Smith-Waterman over words (match +1, mismatch and gap -0.5) scores the others.
   A document is contaminated if a score reaches ``threshold`` of the item's words (items of
   fewer than ``least_words`` count as that long, so a few common words leak nothing).

Words are runs of letters and digits, lower-cased, so case and punctuation do not matter.
Defined results: null or empty texts and items match nothing, nor do items of fewer words
than a seed; repeated items are scored each; documents are told apart by doc_id and text, so
a null doc_id is a document too; of several windows of a document and an item the best score
counts; texts and items of any length are read whole; empty tables give an empty result;
extra columns are ignored. A copy so edited that no seed is left whole is not found.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

SEED_WORDS = 3
THRESHOLD = 0.5
LEAST_WORDS = 8
#: bits of a broadcast bitmap: sixteen a key, 1 to 32 MB
BITMAP_BITS = (1 << 23, 1 << 28)
#: a seed met more often than this in passages and in items is joined with a word
FEW = 16
#: items of up to so many words share a class, then up to four times as many, and so on
CLASS_WORDS = 64
GAP = MISMATCH = 0.5
WORD = re.compile(r"[^\W_]+")
NO_ID = -(2**63)


class _Hashes(dict):
    """word -> 64-bit hash, remembered for up to a bounded number of words."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def word_hashes(texts: list[str | None], memo: _Hashes) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as hashes, and the number of words of each text."""
    found = [WORD.findall((t or "").lower()) for t in texts]
    n = np.fromiter(map(len, found), np.int64, len(found))
    return np.fromiter((memo[w] for words in found for w in words), np.uint64, int(n.sum())), n


def seed_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of the n-gram that starts at each word (the last n - 1 words start none)."""
    if len(words) < n:
        return np.array([], np.uint64)
    k = len(words) - n + 1
    h = np.zeros(k, np.uint64)
    for i in range(n):
        h = h * np.uint64(0x9E3779B97F4A7C15) + words[i:i + k]
        h ^= h >> np.uint64(29)
    return h


def _slots(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (h & np.uint64(bits - 1)).astype(np.int64), ((h >> np.uint64(32)) & np.uint64(bits - 1)).astype(np.int64)


def item_words(items: DataFrame) -> DataFrame:
    """(iid, item_id, n, words): a number for each row, and the word hashes of each test item,
    eight bytes a word."""
    src = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, iid = _Hashes(), TaskContext.get().partitionId() << 40
        for b in batches:
            words, n = word_hashes(b.column(1).to_pylist(), memo)
            parts = np.split(words, np.cumsum(n)[:-1]) if len(n) else []
            yield pa.RecordBatch.from_arrays([pa.array(iid + np.arange(len(n))), b.column(0), pa.array(n.astype(np.int32)),
                                              pa.array([p.tobytes() for p in parts], pa.binary())],
                                             names=["iid", "item_id", "n", "words"])
            iid += len(n)

    return src.mapInArrow(run, "iid long, item_id long, n int, words binary")


def item_seeds(items: DataFrame, n: int) -> DataFrame:
    """(iid, n, cls, seed, at) of the items' n-grams, each distinct seed at its first place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, k, words in zip(*(c.to_pylist() for c in b.columns)):
                h, first = np.unique(seed_hashes(np.frombuffer(words, np.uint64), n), return_index=True)
                cls = 0
                while k > CLASS_WORDS << 2 * cls:
                    cls += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i] * len(h), pa.int64()), pa.array([k] * len(h), pa.int32()), pa.array([cls] * len(h), pa.int32()),
                     pa.array(h.view(np.int64)), pa.array(first.astype(np.int32))],
                    names=["iid", "n", "cls", "seed", "at"])

    return items.select("iid", "n", "words").mapInArrow(run, "iid long, n int, cls int, seed long, at int")


def key_bitmap(keys: DataFrame, count: int) -> np.ndarray:
    """Two bits per key, a column of hashes. What comes to the driver is at most bits / 64 longs."""
    bits = BITMAP_BITS[0]
    while bits < min(16 * count, BITMAP_BITS[1]):
        bits *= 2
    mask = F.lit(bits - 1).cast("long")
    key = F.col(keys.columns[0])
    slot = F.explode(F.array(key.bitwiseAND(mask), F.shiftrightunsigned(key, 32).bitwiseAND(mask))).alias("slot")
    rows = (keys.select(slot).select(F.shiftright("slot", 6).cast("int").alias("w"), F.expr("shiftleft(1L, CAST(slot & 63 AS INT))").alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("b")).toPandas())
    out = np.zeros(bits // 64, np.int64)
    out[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return out.view(np.uint8)


def _held(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes may be keys of a bitmap."""
    one, two = _slots(h, len(bitmap) * 8)
    bit = lambda at: bitmap[at >> 3] >> (at & 7) & 1
    return (bit(one) & bit(two)).astype(bool)


def seed_words(seed: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The hash of a seed with a word beside it; with word 0, of the seed as a common one."""
    h = (seed ^ (word >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15) + word
    return h ^ (h >> np.uint64(29))


def _doc_key() -> tuple[Column, Column]:
    return F.col("doc_id").cast("bigint"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def passages(docs: DataFrame, classes: list[tuple[int, np.ndarray, int]], n: int) -> DataFrame:
    """(pid, cls, doc_id, t, words, seeds, at): stretches of words around possible seeds, with a
    class's reach in words on either side; seeds lie at word ``at`` of the stretch. ``classes``:
    (class, bitmap, reach)."""
    doc_id, t = _doc_key()
    src = docs.select(doc_id.alias("doc_id"), t.alias("t"), F.col("text").cast("string").alias("text"))
    packed = docs.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, pid = _Hashes(), TaskContext.get().partitionId() << 40
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                piece = b.slice(lo, 512)
                words, n_words = word_hashes(piece.column(2).to_pylist(), memo)
                ends = np.cumsum(n_words)
                h = seed_hashes(words, n)
                out = []
                for cls, bitmap, reach in packed.value:
                    hits = np.nonzero(_held(bitmap, h))[0]
                    doc = np.searchsorted(ends, hits, side="right")
                    inside = hits + n <= ends[doc] if len(hits) else np.array([], bool)
                    hits, doc = hits[inside], doc[inside]
                    if not len(hits):
                        continue
                    cut = np.nonzero((np.diff(doc) != 0) | (np.diff(hits) > 2 * reach))[0] + 1
                    for group in np.split(np.arange(len(hits)), cut):
                        d, at = doc[group[0]], hits[group]
                        s = max(ends[d] - n_words[d], at[0] - reach)
                        e = min(ends[d], at[-1] + n + reach)
                        out.append((pid, cls, int(d), words[s:e].tobytes(), h[at].view(np.int64), (at - s).astype(np.int32)))
                        pid += 1
                if out:
                    pids, cls, rows, held, seeds, at = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pids), pa.array(cls, pa.int32()), piece.column(0).take(pa.array(rows)), piece.column(1).take(pa.array(rows)),
                         pa.array(held, pa.binary()), pa.array(seeds, pa.list_(pa.int64())), pa.array(at, pa.list_(pa.int32()))],
                        names=["pid", "cls", "doc_id", "t", "words", "seeds", "at"])

    return src.mapInArrow(run, "pid long, cls int, doc_id long, t long, words binary, seeds array<long>, at array<int>")


def item_keys(held: DataFrame, threshold: float, least_words: int) -> DataFrame:
    """(cls, seed, word, iid, n, at): of each item and common seed of its, the words one of which
    any window that reaches the threshold must hold. ``held`` has a row per item and common
    seed, with the item's words; words are in order of how many such items hold them."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for cls, seed, iid, n, at, words in zip(*(c.to_pylist() for c in b.columns)):
                word, times = np.unique(np.frombuffer(words, np.int64), return_counts=True)
                k = len(word)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([cls] * k, pa.int32()), pa.array([seed] * k, pa.int64()), pa.array(word), pa.array(times.astype(np.int32)),
                     pa.array([iid] * k, pa.int64()), pa.array([n] * k, pa.int32()), pa.array([at] * k, pa.int32())],
                    names=["cls", "seed", "word", "times", "iid", "n", "at"])

    each = staged(held.select("cls", "seed", "iid", "n", "at", "words").mapInArrow(
        spread, "cls int, seed long, word long, times int, iid long, n int, at int"), "item-words")
    common = each.groupBy("cls", "seed", "word").agg(F.count("*").alias("items"))
    # an item's words are a window partition; it takes words until those left are fewer than the threshold
    order = Window.partitionBy("iid", "seed").orderBy("items", "word").rowsBetween(Window.unboundedPreceding, -1)
    need = F.ceil(F.lit(threshold) * F.greatest("n", F.lit(least_words)))
    return (each.join(common, ["cls", "seed", "word"]).withColumn("before", F.coalesce(F.sum("times").over(order), F.lit(0)))
            .where(F.col("n") - F.col("before") >= need).select("cls", "seed", "word", "iid", "n", "at"))


def worded_hits(found: DataFrame, bitmap: np.ndarray, reach: dict[int, int]) -> DataFrame:
    """(cls, seed, word, pid, p) of the common seeds' places and the key words near them."""
    packed = found.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for pid, cls, words, seeds, at in zip(*(c.to_pylist() for c in b.columns)):
                words, seeds = np.frombuffer(words, np.uint64), np.array(seeds, np.int64).view(np.uint64)
                for k in np.nonzero(_held(packed.value, seed_words(seeds, np.uint64(0))))[0]:
                    near = np.unique(words[max(0, at[k] - 3 * reach[cls] // 2):at[k] + 3 * reach[cls] // 2])  # all that a window can hold
                    near = near[_held(packed.value, seed_words(seeds[k], near))]
                    if len(near):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([cls] * len(near), pa.int32()), pa.array(np.full(len(near), seeds[k]).view(np.int64)), pa.array(near.view(np.int64)),
                             pa.array([pid] * len(near), pa.int64()), pa.array([at[k]] * len(near), pa.int32())], names=["cls", "seed", "word", "pid", "p"])

    return found.select("pid", "cls", "words", "seeds", "at").mapInArrow(run, "cls int, seed long, word long, pid long, p int")


def key_hashes(keys: DataFrame) -> DataFrame:
    """The hashes of (seed, word) keys, and of their seeds as common ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seed, word = (b.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(2))
            h = np.concatenate([seed_words(seed, word), seed_words(np.unique(seed), np.uint64(0))])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])

    return keys.select("seed", "word").mapInArrow(run, "h long")


def windows_of(found: DataFrame, items: DataFrame, seeds: DataFrame, reach: dict[int, int], threshold: float, least_words: int,
               few: int = FEW) -> DataFrame:
    """(pid, iid, n, w): the windows to align."""
    hits = found.select("pid", "cls", F.explode(F.arrays_zip("seeds", "at")).alias("x")).select(
        "pid", "cls", F.col("x.seeds").alias("seed"), F.col("x.at").alias("p"))
    by = ["cls", "seed"]
    met = hits.groupBy(*by).agg(F.count("*").alias("met")).where(F.col("met") > few)
    common = staged(seeds.groupBy(*by).agg(F.count("*").alias("items")).where(F.col("items") > few).join(met, by).select(*by), "common-seeds")
    rare = seeds.join(common, by, "left_anti")
    pairs = hits.join(rare, by).select("pid", "iid", "n", "p", "at")
    held = seeds.join(common, by, "left_semi").join(items.select("iid", "words"), "iid")
    keys = staged(item_keys(held, threshold, least_words), "item-keys")
    bitmap = key_bitmap(key_hashes(keys), 2 * keys.count())
    worded = worded_hits(found, bitmap, reach).join(keys, [*by, "word"]).select("pid", "iid", "n", "p", "at")
    return pairs.unionByName(worded).select("pid", "iid", "n", F.floor((F.col("p") - F.col("at")) / F.col("n")).cast("int").alias("w")).distinct()


def smith_waterman(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The best local alignment score of each row pair of two padded word matrices."""
    width = a.shape[1]
    ramp = GAP * np.arange(width, dtype=np.float32)
    valid = np.arange(width) < na[:, None]
    row = np.zeros(a.shape, np.float32)
    best = np.zeros(len(a), np.float32)
    for i in range(b.shape[1]):
        diag = np.zeros_like(row)
        diag[:, 1:] = row[:, :-1]
        same = (a == b[:, i:i + 1]) & valid & (i < nb)[:, None]
        t = np.maximum(np.maximum(diag + np.where(same, 1, -MISMATCH).astype(np.float32), row - GAP), 0)
        row = np.maximum.accumulate(t + ramp, axis=1) - ramp
        best = np.maximum(best, row.max(axis=1))
    return best


def _scores(pairs: DataFrame, least: Callable[[int], float]) -> DataFrame:
    """Adds the alignment score to rows that hold a window and an item's words; rows whose window
    has fewer of the item's words than the ``least`` score for its length are left out."""
    def pad(col: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        n = np.array([len(x) // 8 for x in col])
        out = np.zeros((len(col), max(1, n.max())), np.uint64)
        for k, x in enumerate(col):
            out[k, :n[k]] = np.frombuffer(x, np.uint64)
        return out, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = zip(*(b.column(c).to_pylist() for c in (3, 4, 5)))
            b = b.take(pa.array([k for k, (n, a, w) in enumerate(words)
                                 if np.isin(np.frombuffer(w, np.uint64), np.frombuffer(a, np.uint64)).sum() >= least(n)], pa.int64()))
            at = 0
            while at < b.num_rows:  # at most about 4 MB of window words at once
                size, to = 0, at
                while to < b.num_rows and (to == at or size < 500_000):
                    size += len(b.column(4)[to].as_buffer()) // 8
                    to += 1
                part = b.slice(at, to - at)
                a, na = pad(part.column(4).to_pylist())
                w, nw = pad(part.column(5).to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(smith_waterman(a, na, w, nw).astype(float))],
                                                 names=["doc_id", "t", "item_id", "n", "score"])
                at = to

    return pairs.select("doc_id", "t", "item_id", "n", "window", "item").mapInArrow(
        run, "doc_id long, t long, item_id long, n int, score double")


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = SEED_WORDS, threshold: float = THRESHOLD,
                 least_words: int = LEAST_WORDS, few: int = FEW) -> DataFrame:
    """(doc_id, t, item_id, item_words, score): the documents that hold a copy, edited or
    not, of a test item; t is the hash of the document's text."""
    items = staged(item_words(benchmark), "items")
    seeds = staged(item_seeds(items, n), "item-seeds")
    lengths = seeds.groupBy("cls").agg(F.max("n").alias("n"), F.count("*").alias("k")).orderBy("cls").collect()  # a row a class
    reach = {r["cls"]: 2 * r["n"] for r in lengths}
    classes = [(r["cls"], key_bitmap(seeds.where(F.col("cls") == r["cls"]).select("seed"), r["k"]), reach[r["cls"]]) for r in lengths]
    found = staged(passages(docs, classes, n), "passages")
    windows = windows_of(found, items, seeds, reach, threshold, least_words, few)
    # a window is three item lengths around the diagonal; binary slices count from 1
    start = F.greatest(F.lit(0), F.floor((F.col("w") - 0.5) * F.col("n"))).cast("int")
    stop = F.ceil((F.col("w") + 2.5) * F.col("n")).cast("int")
    cut = F.expr("substring(words, start * 8 + 1, (stop - start) * 8)")
    pairs = (windows.withColumns({"start": start, "stop": stop})
             .join(found.select("pid", "doc_id", "t", "words"), "pid")
             .select("doc_id", "t", "iid", "n", cut.alias("window"))
             .join(items.select("iid", "item_id", F.col("words").alias("item")), "iid")
             .select("doc_id", "t", "item_id", "n", "window", "item").distinct())
    return (_scores(pairs, lambda k: threshold * max(k, least_words)).groupBy("doc_id", "t", "item_id").agg(F.max("n").alias("item_words"), F.max("score").alias("score"))
            .where(F.col("score") >= threshold * F.greatest(F.col("item_words"), F.lit(least_words))))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no test item, columns unchanged."""
    bad = contaminated(docs, benchmark).select(F.coalesce("doc_id", F.lit(NO_ID)).alias("bad_d"), F.col("t").alias("bad_t")).distinct()
    doc_id, t = _doc_key()
    return docs.join(bad, (F.coalesce(doc_id, F.lit(NO_ID)) == bad["bad_d"]) & (t == bad["bad_t"]), "left_anti")
