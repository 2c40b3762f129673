"""The prefix trie of conversations, from adaptive radix trees over turn ids.

A turn's id is 16 big-endian bytes, two 64-bit hashes of its role and text; a conversation's
key is the ids of its turns. Keys are cut into chunks of ``CHUNK`` turns, and a chunk's key
begins with the hash of all turns before it, so a conversation of any length is many small
rows. Equal chunks are counted first, however many conversations share them; the distinct
ones are numbered in order of key and dealt in batches of ``BATCH`` neighbours. Each batch is
one adaptive radix tree: nodes of 4, 16, 48 and 256 children that grow as they fill, with
paths of single children kept as one byte string. Only byte depths at the end of a turn emit
trie nodes.

A node that spans batches is emitted by each. A batch knows the key before and the key after
it, so it knows which of its nodes an earlier batch has counted and what every partial adds;
a sum over the batches puts nodes together. What lies below a chunk's last turn is summed by
pointer doubling over the chunks, and each of the chunk's nodes above it takes its share. The
conversations that end at a node are written out in sorted runs by many tasks, and one stream
of those runs gives the digest, since a digest of a list is made in the list's order.

Defined results: a null turn number comes first, equal ones go by role and text, a repeated
row is a turn of its own; a null role or text is empty; rows without conv_id belong to no
conversation and take no part; an empty table has no nodes; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dcflow.operators.numbering import number_rows
from dcflow.session import shuffle_partitions

from .common import staged

WIDTH = 16
CHUNK = 128
BATCH = 512
RUN_IDS = 10_000
NODE = ["p1", "p2", "depth"]


class Node:
    """An adaptive radix tree node: the bytes it skips, its children, and the row that ends here."""

    __slots__ = ("skip", "row", "room", "keys", "kids")

    def __init__(self, skip: bytes, row: int = -1):
        self.skip, self.row, self.room = skip, row, 4
        self.keys, self.kids = bytearray(), []

    def child(self, byte: int) -> Node | None:
        if self.room == 256:
            return self.kids[byte]
        if self.room == 48:
            return self.kids[self.keys[byte]] if self.keys[byte] != 255 else None
        i = bisect_left(self.keys, byte)
        return self.kids[i] if i < len(self.keys) and self.keys[i] == byte else None

    def place(self, byte: int, node: Node) -> None:
        """Add a child, or put another in its place."""
        if self.room <= 16:
            i = bisect_left(self.keys, byte)
            if i < len(self.keys) and self.keys[i] == byte:
                self.kids[i] = node
                return
            if len(self.kids) < self.room:
                self.keys.insert(i, byte)
                self.kids.insert(i, node)
                return
            self._grow()
            self.place(byte, node)
        elif self.room == 48:
            if self.keys[byte] != 255:
                self.kids[self.keys[byte]] = node
            elif len(self.kids) < 48:
                self.keys[byte] = len(self.kids)
                self.kids.append(node)
            else:
                self._grow()
                self.place(byte, node)
        else:
            self.kids[byte] = node

    def _grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            index = bytearray([255]) * 256
            for at, byte in enumerate(self.keys):
                index[byte] = at
            self.room, self.keys = 48, index
        else:
            self.kids = [self.child(b) for b in range(256)]
            self.room, self.keys = 256, bytearray()

    def children(self) -> Iterator[Node]:
        """The children in order of their bytes."""
        if self.room == 256:
            yield from (n for n in self.kids if n)
        elif self.room == 48:
            yield from (self.kids[i] for i in self.keys if i != 255)
        else:
            yield from self.kids


def shared(a: bytes, b: bytes, at: int = 0) -> int:
    """How many bytes of ``b`` equal those of ``a`` from ``at`` on."""
    if a.startswith(b, at):
        return len(b)
    n = min(len(a) - at, len(b))
    return next((i for i in range(n) if a[at + i] != b[i]), n)


def insert(root: Node, key: bytes, row: int) -> None:
    """Add a key, not yet there, below a root that skips nothing."""
    node, at, parent = root, 0, root
    while True:
        same = shared(key, node.skip, at)
        if same < len(node.skip):  # the skipped bytes part here
            upper = Node(node.skip[:same])
            upper.place(node.skip[same], node)
            node.skip = node.skip[same + 1:]
            parent.place(key[at - 1], upper)
            node = upper
        at += same
        if at == len(key):
            node.row = row
            return
        below = node.child(key[at])
        if below is None:
            node.place(key[at], Node(key[at + 1:], row))
            return
        parent, node, at = node, below, at + 1


class Batch:
    """The radix tree of one batch of distinct chunks, and the partial trie nodes it holds.

    ``seen`` is how many bytes of the first key the key before the batch shares, ``longer``
    whether the key after it goes on from the last one."""

    def __init__(self, rows: dict[str, list], seen: int, longer: bool, chunk: int):
        self.rows, self.seen, self.longer, self.chunk = rows, seen, longer, chunk
        self.marks = []  # per row, the hash of the turns up to each depth
        for key, g1, g2 in zip(rows["key"], rows["g1"], rows["g2"]):
            start = np.frombuffer(key[:WIDTH], ">i8").astype(np.int64)
            self.marks.append([np.bitwise_xor.accumulate(np.concatenate([start[i:i + 1], np.array(g, np.int64)])).tolist()
                               for i, g in enumerate((g1, g2))])
        self.root = Node(b"")
        for row, key in enumerate(rows["key"]):
            insert(self.root, key, row)
        self.nodes: list[tuple] = []
        self._walk(self.root, 0)

    def _walk(self, node: Node, top: int) -> tuple:
        """(members, smallest conv_id, first row, new nodes, leaves, saved) over the trie nodes
        next below a byte depth. ``node`` covers the depths from ``top`` to the end of its skip."""
        rows, bottom = self.rows, top + len(node.skip)
        n = fresh = leaves = saved = 0
        conv = first = None
        for kid in node.children():
            m, c, r, f, lv, sv = self._walk(kid, bottom + 1)
            n, fresh, leaves, saved = n + m, fresh + f, leaves + lv, saved + sv
            conv, first = c if conv is None else min(conv, c), r if first is None else min(first, r)
        here = node.row
        if here >= 0:
            n += rows["n_ends"][here] + rows["n_on"][here]
            conv = rows["conv_id"][here] if conv is None else min(conv, rows["conv_id"][here])
            goes_on = rows["n_on"][here] or first is not None or (self.longer and here == len(rows["key"]) - 1)
            first = here if first is None else min(first, here)
            leaves += not goes_on
        for end in range(bottom - bottom % WIDTH, max(top, WIDTH) - 1, -WIDTH):
            d, level = end // WIDTH - 1, rows["level"][first]
            (p1, p2), known = self.marks[first], first == 0 and end <= self.seen
            if d:
                size = rows["sizes"][first][d - 1]
                saved += n * size - (0 if known else size)
            told = (n, conv) if d or not level else (0, None)  # a later chunk's root is counted where it ends
            above = (p1[d - 1], p2[d - 1]) if d else (None, None)
            self.nodes.append((p1[d], p2[d], level * self.chunk + d, *above, *told, fresh, leaves, saved, not d and level > 0))
            fresh = 0 if known else 1
        return n, conv, first, fresh, leaves, saved

    def links(self) -> list[tuple]:
        """For every chunk that goes on in another, its last node and the nodes above that."""
        out = []
        for row, on in enumerate(self.rows["n_on"]):
            if on:
                (p1, p2), base = self.marks[row], self.rows["level"][row] * self.chunk
                out.append((p1[-1], p2[-1], base + self.chunk, [{"p1": a, "p2": b, "depth": base + d} for d, (a, b) in enumerate(zip(p1[:-1], p2[:-1]))]))
        return out


PARTIAL = ("batch long, p1 long, p2 long, depth long, q1 long, q2 long, n long, conv_id long, children long, leaves long, "
           "saved long, chunk_root boolean, above array<struct<p1: long, p2: long, depth: long>>")
ROW = ["key", "level", "g1", "g2", "sizes", "n_ends", "n_on", "conv_id"]


def _batch_nodes(table: pa.Table, chunk: int) -> pa.Table:
    """The partial nodes and the links of a batch: its own rows (role 0), and the last key
    before (-1) and the first after (1)."""
    rows = sorted(table.to_pylist(), key=lambda r: r["rn"])
    own = [r for r in rows if not r["role"]]
    schema = pa.schema([pa.field(c.split(" ", 1)[0], pa.bool_() if "boolean" in c else pa.int64()) for c in PARTIAL.split(", above")[0].split(", ")]
                       + [pa.field("above", pa.list_(pa.struct([(c, pa.int64()) for c in NODE])))])
    if not own:
        return schema.empty_table()
    edge = {r["role"]: r["key"] for r in rows if r["role"]}
    seen = shared(own[0]["key"], edge.get(-1, b""))
    longer = edge.get(1, b"").startswith(own[-1]["key"])
    made = Batch({c: [r[c] for r in own] for c in ROW}, seen, longer, chunk)
    out = [(*n, None) for n in made.nodes] + [(*u[:3], None, None, 0, None, 0, 0, 0, None, u[3]) for u in made.links()]
    cols = [[own[0]["batch"]] * len(out), *map(list, zip(*out))]
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _hex(c: Column | str) -> Column:
    return F.lpad(F.hex(c), 16, "0")


def chunks_of(turns: DataFrame, totals: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per conversation and chunk: conv_id, level, key, the turns' part of the prefix
    hash (g1, g2), their sizes, the hash at the chunk's end (e1, e2), and depth, the number of
    turns if the conversation ends here. ``turns``: conv_id, pos (from 1), total, h1, h2, size."""
    pos = F.col("pos")
    t = turns.select("conv_id", "total", F.expr(f"(pos - 1) div {chunk}").alias("level"), F.struct(
        "pos", F.concat(_hex("h1"), _hex("h2")).alias("id"), F.xxhash64("h1", pos).alias("g1"), F.xxhash64("h2", pos).alias("g2"), "size").alias("t"))
    c = t.groupBy("conv_id", "level").agg(
        F.max("total").alias("total"), F.array_sort(F.collect_list("t")).alias("ts"),  # at most ``chunk`` turns
        F.bit_xor(F.col("t.g1")).alias("x1"), F.bit_xor(F.col("t.g2")).alias("x2"))
    so_far = Window.partitionBy("conv_id").orderBy("level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for i in "12":
        c = c.withColumn("e" + i, F.bit_xor("x" + i).over(so_far))
    s1, s2 = (F.col("e" + i).bitwiseXOR(F.col("x" + i)) for i in "12")
    depth = F.when(F.col("level") == F.expr(f"(total - 1) div {chunk}"), F.col("total"))
    whole = c.select("conv_id", "level", F.unhex(F.concat(_hex(s1), _hex(s2), F.array_join("ts.id", ""))).alias("key"),
                     *[F.col("ts." + g).alias(g) for g in ("g1", "g2")], F.col("ts.size").alias("sizes"), "e1", "e2", depth.alias("depth"))
    none = F.array().cast("array<bigint>")
    turnless = totals.where("total = 0").select(
        "conv_id", F.lit(0).cast("bigint").alias("level"), F.unhex(F.lit("00" * WIDTH)).alias("key"), none.alias("g1"), none.alias("g2"),
        none.alias("sizes"), *[F.lit(0).cast("bigint").alias(c) for c in ("e1", "e2", "depth")])
    return whole.unionByName(turnless)


def _enders(chunks: DataFrame, run_ids: int) -> DataFrame:
    """p1, p2, depth, ends_sha256 of every node at which conversations end."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, key, ids = [], None, []

        def close() -> None:
            if ids:
                out.append((*key, ids[0], ",".join(map(str, ids))))
                ids.clear()

        for b in batches:
            for *node, conv in zip(*(c.to_pylist() for c in b.columns)):
                if node != key or len(ids) == run_ids:
                    close()
                    key = node
                ids.append(conv)
            if sum(len(r[4]) for r in out) > 4 << 20:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in out], schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def row(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), [pa.int64()] * 3 + [pa.string()])], names=[*NODE, "ends_sha256"])

        for b in batches:
            done = []
            for *node, ids in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 4))):
                if node != key:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield row(done)
        if key:
            yield row([(*key, state.hexdigest())])

    names, by = [*NODE, "first", "ids"], [*NODE, "conv_id"]
    schema = pa.schema([pa.field(c, pa.int64()) for c in names[:4]] + [pa.field("ids", pa.string())])
    ends = chunks.where("depth IS NOT NULL").select(F.col("e1").alias("p1"), F.col("e2").alias("p2"), "depth", "conv_id")
    dealt = ends.repartitionByRange(shuffle_partitions(chunks.sparkSession), *by).sortWithinPartitions(*by)
    listed = dealt.mapInArrow(runs, "p1 long, p2 long, depth long, first long, ids string")
    return listed.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(digest, "p1 long, p2 long, depth long, ends_sha256 string")


def _below(partials: DataFrame, chunk: int) -> DataFrame | None:
    """What each node holds below the ends of its chunk: p1, p2, depth, more_leaves, more_saved.
    None if no conversation is longer than a chunk."""
    links = partials.where("above IS NOT NULL").select(*NODE, "above")
    levels = links.agg(F.max("depth")).first()[0]
    if levels is None:
        return None
    roots = partials.where("chunk_root").groupBy(*NODE).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    to = F.when(F.col("above")[0]["depth"] > 0, F.col("above")[0])  # the chunk before is itself below another
    total = staged(roots.join(links.select(*NODE, to.alias("to")), NODE), "chunk-totals")
    reach = 1
    while reach < levels // chunk:  # every chunk knows all up to ``reach`` - 1 chunks below it
        sent = total.where("to IS NOT NULL").groupBy("to").agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        at = F.struct(*NODE).alias("at")
        joined = total.alias("t").join(sent.withColumnRenamed("to", "at").alias("s"), F.struct(*[F.col("t." + c) for c in NODE]) == F.col("s.at"), "left")
        summed = joined.select(*[F.col("t." + c) for c in NODE], (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
                               (F.col("saved") + F.coalesce("s.s", F.lit(0))).alias("saved"), "to")
        hops = total.select(at, F.col("to").alias("next"))
        total = staged(summed.join(hops, F.col("to") == F.col("at"), "left").select(*NODE, "leaves", "saved", F.col("next").alias("to")), "chunk-totals")
        reach *= 2
    each = links.join(total.select(*NODE, "leaves", "saved"), NODE).select(F.explode("above").alias("a"), "leaves", "saved")
    return each.groupBy(*[F.col("a." + c).alias(c) for c in NODE]).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))


def prefix_trie(turns: DataFrame, totals: DataFrame, chunk: int = CHUNK, batch: int = BATCH, run_ids: int = RUN_IDS) -> DataFrame:
    """The trie's nodes. ``turns`` has conv_id, pos (1 to total), total, h1, h2 (the turn's two
    hashes) and size (of its text); ``totals`` has conv_id and total, also of turnless ones."""
    chunks = staged(chunks_of(turns, totals, chunk), "trie-chunks")
    distinct = chunks.groupBy("level", "key").agg(
        F.count_if(F.col("depth").isNotNull()).alias("n_ends"), F.count_if(F.col("depth").isNull()).alias("n_on"), F.min("conv_id").alias("conv_id"),
        *[F.first(c).alias(c) for c in ("g1", "g2", "sizes")])  # equal for equal keys
    numbered = number_rows(distinct.withColumn("all", F.lit(0)), ["all"], ["key", "level"]).drop("all")
    of = F.expr(f"(rn - 1) div {batch}")
    seat = lambda b, role: F.struct(b.cast("bigint").alias("batch"), F.lit(role).alias("role"))
    to = F.array_compact(F.array(seat(of, 0), F.when(F.col("rn") % batch == 0, seat(of + 1, -1)),
                                 F.when(((F.col("rn") - 1) % batch == 0) & (F.col("rn") > 1), seat(of - 1, 1))))
    dealt = numbered.select("*", F.inline(to)).select("batch", "role", "rn", *ROW)
    partials = staged(dealt.groupBy("batch").applyInArrow(lambda t: _batch_nodes(t, chunk), PARTIAL), "trie-partials")

    held = partials.where("above IS NULL")
    nodes = held.groupBy(*NODE).agg(
        *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")], F.min("conv_id").alias("conv_id"),
        F.max("q1").alias("q1"), F.max("q2").alias("q2"), F.min(F.when(F.col("q1").isNotNull(), F.col("batch"))).alias("home"))
    below = _below(partials, chunk)
    if below is None:
        nodes = nodes.withColumn("more_leaves", F.lit(0)).withColumn("more_saved", F.lit(0))
    else:
        nodes = nodes.join(below, NODE, "left")
    nodes = staged(nodes, "trie-nodes")
    # a node's parent is in every batch that holds the node: the join is by batch, so that a
    # parent of a third of all nodes is as many keys as it has batches
    parents = held.select("batch", *NODE).distinct().join(nodes.select(*NODE, F.col("conv_id").alias("parent_conv_id")), NODE).select(
        F.col("batch").alias("home"), F.col("p1").alias("q1"), F.col("p2").alias("q2"), (F.col("depth") + 1).alias("depth"), "parent_conv_id")
    more = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).cast("bigint")
    return (nodes.join(parents, ["home", "q1", "q2", "depth"], "left").join(_enders(chunks, run_ids), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        more("leaves", "more_leaves").alias("n_leaves"), more("saved", "more_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (1-based), h1, h2, size of every turn. Numbering is by range, so a
    conversation of any number of turns is spread."""
    words = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    turns = conversations.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), *words).where(
        "conv_id IS NOT NULL").withColumn("_row", F.monotonically_increasing_id())  # only parts equal rows
    return number_rows(turns, ["conv_id"], ["turn", "role", "text", "_row"], out="pos").select(
        "conv_id", "pos", F.xxhash64(F.lit(17), "role", "text").alias("h1"), F.xxhash64(F.lit(71), "text", "role").alias("h2"),
        F.length("text").cast("bigint").alias("size"))


def branched(conversations: DataFrame, group: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that share openings, as ``prefix_trie`` takes them: with h = crc32(conv_id)
    % ``most``, the first h turns of the first of each ``group`` ids, then its own after its first h."""
    t = staged(hashed_turns(conversations), "trie-turns")
    convs = t.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumn("base", F.col("conv_id") - F.col("conv_id") % group).withColumn(
        "h", F.crc32(F.col("conv_id").cast("string")) % most)
    lent = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(lent, "base", "left").withColumn("lent", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = staged(convs.withColumn("total", F.col("lent") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "trie-convs")
    cols = ["h1", "h2", "size"]
    own = t.join(convs.select("conv_id", "h", "lent", "total"), "conv_id").where("pos > h").select(
        "conv_id", (F.col("lent") + F.col("pos") - F.col("h")).alias("pos"), "total", *cols)
    opening = t.where(F.col("pos") < most).withColumnRenamed("conv_id", "base").join(
        convs.select("conv_id", "base", "h", "total"), "base").where("pos <= h").select("conv_id", "pos", "total", *cols)
    return own.unionByName(opening), convs.select("conv_id", "total")
