"""SimHash near-duplicates: 64-bit fingerprints and a binary-trie self-join.

Fingerprints are computed per document in Arrow batches. The self-join works on distinct
fingerprints. Two fingerprints within 4 bits have at most 2 differing bits in the first half
or at most 1 in the second, so two tries are walked, one over the bits as they are and one
over the halves swapped. Spark deals the top of each trie out: a node (a prefix of ``b``
bits) meets every node whose prefix is within the budget of its half, and each such pair of
nodes is one group. Inside a group the two subtrees are walked together, bit by bit; a pair
of nodes is given up once its accumulated differing bits exceed the budget, or once both
lie in one component found already. A group returns a spanning forest of its links, never
all pairs, so a dense cluster of thousands of near copies yields as many rows as it has
members. Components of the forest are then found by star contraction.

Defined results: a null or empty text has fingerprint zero and links like any other; a
repeated row joins the component of its twin; rows with a null doc_id keep their links, and
component_id is null only if no member has an id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import doc_texts, free_prefix, staged
from .components import components

SHINGLE = 4
MAX_BITS = 4
#: differing bits allowed in the leading half of each of the two tries
HALF_BUDGETS = (2, 1)
#: distinct fingerprints a trie node should hold at most when it is dealt to a task
NODE_ROWS = 16384
LEAF = 16
STEP = 200_000
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
BIT_OF_BYTE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: str | None, n: int = SHINGLE, chunk: int = 1 << 18) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    k = max(1, len(words) - n + 1)
    counts = np.zeros((8, 8), np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, k, chunk):  # a very long text is hashed in pieces of bounded size
        hs = np.array([digest(b" ".join(words[i:i + n]), 42) for i in range(at, min(k, at + chunk))], np.uint64)
        cells = hs.view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
        counts += np.bincount(cells.ravel(), minlength=2048).reshape(8, 256) @ BIT_OF_BYTE
    bits = (2 * counts > k).astype(np.uint64).ravel()  # little-endian: byte j, bit i is bit 8j+i
    return int((bits << np.arange(64, dtype=np.uint64)).sum())


def with_fingerprints(docs: DataFrame, text_col: str, out_col: str, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` and the fingerprint of ``text_col`` as a signed long in ``out_col``."""
    schema = StructType([*docs.schema.fields, StructField(out_col, LongType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in batch.column(at)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))],
                                             names=[*batch.schema.names, out_col])

    return docs.mapInArrow(run, schema)


class _Forest:
    """Component labels of positions, and the links that joined two components."""

    def __init__(self, n: int):
        self.labels = np.arange(n)
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self._runs()

    def _runs(self) -> None:
        self.runs = np.concatenate([[0], np.cumsum(self.labels[1:] != self.labels[:-1])])

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        moved = False
        while len(i):
            x, y = self.labels[i], self.labels[j]
            apart = x != y
            i, j, x, y = i[apart], j[apart], x[apart], y[apart]
            if not len(i):
                break
            hi, first = np.unique(np.maximum(x, y), return_index=True)
            parent = np.arange(len(self.labels))
            parent[hi] = np.minimum(x, y)[first]
            while (parent[parent] != parent).any():
                parent = parent[parent]
            self.labels = parent[self.labels]
            self.a.append(i[first])
            self.b.append(j[first])
            moved = True
        if moved:
            self._runs()

    def joined(self, s1, e1, s2, e2) -> np.ndarray:
        """Node pairs whose members all lie in one component already."""
        r = self.runs
        return (r[s1] == r[e1 - 1]) & (r[s2] == r[e2 - 1]) & (self.labels[s1] == self.labels[s2])


def _cross(s1, e1, s2, e2) -> tuple[np.ndarray, np.ndarray]:
    """All position pairs of small node pairs (at most LEAF each, or one unsplittable node)."""
    n2 = e2 - s2
    size = (e1 - s1) * n2
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    width = np.repeat(n2, size)
    return np.repeat(s1, size) + at // width, np.repeat(s2, size) + at % width


def trie_links(values: np.ndarray, cut: int, same: bool, depth: int, half_budget: int,
               budget: int = MAX_BITS, half: int = 32) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two trie nodes, as positions in ``values``.

    ``values``: distinct uint64; ``values[:cut]`` is the first node, sorted, and the rest the
    second, sorted; with ``same`` there is one node, joined with itself.
    """
    n = len(values)
    forest = _Forest(n)
    if n < 2 or not same and cut in (0, n):
        return np.array([], int), np.array([], int)
    one = np.array
    err0 = 0 if same else int(np.bitwise_count((values[0] ^ values[cut]) >> np.uint64(64 - depth)))
    stack = [(depth, one([0]), one([n if same else cut]), one([0 if same else cut]), one([n]), one([err0]))]
    while stack:
        d, s1, e1, s2, e2, err = stack.pop()
        if len(s1) > STEP:  # walk on with the closest pairs first
            order = np.argsort(-err, kind="stable")
            for part in np.array_split(order, -(-len(s1) // STEP)):
                stack.append((d, s1[part], e1[part], s2[part], e2[part], err[part]))
            continue
        live = ~forest.joined(s1, e1, s2, e2)
        s1, e1, s2, e2, err = (x[live] for x in (s1, e1, s2, e2, err))
        small = ((e1 - s1) * (e2 - s2) <= LEAF) | (d >= 64)
        if small.any():
            i, j = _cross(s1[small], e1[small], s2[small], e2[small])
            near = (i != j) & (np.bitwise_count(values[i] ^ values[j]) <= budget)
            forest.link(i[near], j[near])
        s1, e1, s2, e2, err = (x[~small] for x in (s1, e1, s2, e2, err))
        if not len(s1):
            continue
        bit = np.uint64(1 << (63 - d))
        above = ~np.uint64((1 << (64 - d)) - 1) if d else np.uint64(0)

        def middle(s, e):
            # first position whose bit d is set, in the sorted half that holds the node
            want = (values[s] & above) | bit
            if same:
                return np.clip(np.searchsorted(values, want), s, e)
            low = np.searchsorted(values[:cut], want)
            high = np.searchsorted(values[cut:], want) + cut
            return np.clip(np.where(s < cut, low, high), s, e)

        m1, m2 = middle(s1, e1), middle(s2, e2)
        self_pair = (s1 == s2) & (e1 == e2)
        nxt = []
        for x, y, z, w, more in ((s1, m1, s2, m2, 0), (m1, e1, m2, e2, 0), (s1, m1, m2, e2, 1), (m1, e1, s2, m2, 1)):
            total = err + more
            ok = (x < y) & (z < w) & (total <= (half_budget if d < half else budget))
            if x is m1 and more:
                ok &= ~self_pair  # the mirror image of the third kind
            nxt.append([v[ok] for v in (x, y, z, w, total)])
        parts = [np.concatenate(v) for v in zip(*nxt)]
        if len(parts[0]):
            stack.append((d + 1, *parts))
    if not forest.a:
        return np.array([], int), np.array([], int)
    return np.concatenate(forest.a), np.concatenate(forest.b)


def _rotated(values: np.ndarray, turn: int) -> np.ndarray:
    return values if not turn else (values << np.uint64(32)) | (values >> np.uint64(32))


def links(fps: DataFrame, col: str = "fp", max_bits: int = MAX_BITS, node_rows: int = NODE_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints that span every component of the relation
    "at most ``max_bits`` (4 or fewer) differing bits"."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be 0 to {MAX_BITS}")
    count = fps.count()
    depth = 3
    while depth < 20 and count >> depth > node_rows:
        depth += 1
    near = {budget: [m for m in range(1 << depth) if bin(m).count("1") <= budget] for budget in HALF_BUDGETS}
    dealt = None
    for turn, budget in enumerate(HALF_BUDGETS):
        prefix = F.shiftrightunsigned(F.col(col), 64 - depth if not turn else 32 - depth).bitwiseAND((1 << depth) - 1).cast("int")
        part = (fps.select(F.col(col).alias("fp"), prefix.alias("node"))
                .select("fp", "node", F.explode(F.array(*[F.lit(m) for m in near[budget]])).alias("mask"))
                .select(F.lit(turn).alias("turn"), F.least("node", F.col("node").bitwiseXOR(F.col("mask"))).alias("lo"),
                        F.greatest("node", F.col("node").bitwiseXOR(F.col("mask"))).alias("hi"), "fp"))
        dealt = part if dealt is None else dealt.union(part)

    def walk(key: tuple, group: pa.Table) -> pa.Table:
        turn, lo, hi = (k.as_py() for k in key)
        own = np.unique(group.column("fp").to_numpy()).view(np.uint64)
        values = np.sort(_rotated(own, turn))
        cut = len(values) if lo == hi else int(np.searchsorted(values, np.uint64(hi << (64 - depth))))
        i, j = trie_links(values, cut, lo == hi, depth, HALF_BUDGETS[turn], max_bits)
        back = _rotated(values, turn).view(np.int64)
        return pa.table({"a": back[i], "b": back[j]})

    return dealt.groupBy("turn", "lo", "hi").applyInArrow(walk, "a long, b long").distinct()


def component_roots(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, root): each distinct fingerprint and the one that names its component."""
    roots = components(links(fps, "fp", max_bits), fps.count())  # the links are a few forests
    return fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the least doc_id of the
    component), one row per row of ``docs``."""
    hashed = staged(with_fingerprints(doc_texts(docs), "text", "fp", shingle).select("doc_id", "fp"), "simhash")
    per_fp = staged(hashed.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct", rows=hashed.count())
    roots = component_roots(per_fp.select("fp"), max_bits)
    named = per_fp.join(roots, "fp")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = named.join(least, "root").select("fp", "component_id")
    return hashed.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of each component of near duplicates, that with the least doc_id (a null id
    comes last; of equal ids the first stored), with the columns of ``docs``."""
    p = free_prefix(docs, "s_")
    own = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.withColumns({p + "id": F.monotonically_increasing_id(), p + "text": F.col("text").cast("string")})
    marked = staged(with_fingerprints(marked, p + "text", p + "fp", shingle).select(*own, p + "id", p + "fp"), "simhash-rows")
    rows = marked.select(F.col(p + "fp").alias("fp"), F.struct(
        F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col(p + "id").alias("row")).alias("at"))
    per_fp = staged(rows.groupBy("fp").agg(F.min("at").alias("at")), "simhash-distinct", rows=marked.count())
    kept = (per_fp.join(component_roots(per_fp.select("fp"), max_bits), "fp")
            .groupBy("root").agg(F.min("at").alias("at")).select(F.col("at.row").alias(p + "id")))
    return marked.join(kept, p + "id", "left_semi").select(*own)
