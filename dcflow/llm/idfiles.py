"""Token ids as files of 64-bit words, coded by Simple-8b.

A word holds a selector in its top four bits and, below, as many ids of one width as fit
into 60 bits. Ids are cut into blocks of 256, each of which starts a word, so that both the
coder and the decoder work on all blocks (or words) of a segment at once. An id too wide for
a word escapes: selector 0 names its place in the segment's list of raw ids.

A file is a row of segments in ascending doc_id order, all numbers little-endian and 64 bits
wide: magic, shard, ids of the shard before the segment, documents, ids, blocks, words, raw
ids; then per document its id, its number of ids here and its flags (1: null id, 2: it began
in the segment before, 4: it goes on in the next, 8: spare); then the first word of every
block, the words, the raw ids, seven zero bytes and a line break, the separator of Spark's
text writer, which writes the files to any file system Spark knows. Documents are dealt to
shards by range, so the names of the files sort as their documents do.

A segment holds at most ``SEGMENT_IDS`` ids and a file ``SEGMENTS_PER_FILE`` segments: at most
64 MB of words and, for documents of one id, 192 MB in all, whatever the texts. Longer
documents go on in the next segment.

Defined results: a null text is empty (its only id is the end id); a null doc_id comes before
all others; equal doc_ids go by the texts' hash, repeated rows are documents of their own; an
empty table gives files without segments and no rows; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from dcflow.session import scratch_path, shuffle_partitions

from .common import doc_texts, staged

MAGIC = 0x3130_4745_5342_3853  # "S8BSEG01"
BLOCK = 256
SEGMENT_IDS = 1 << 18
SEGMENTS_PER_FILE = 32
SLICE_BYTES = 24 << 20  # of text whose distinct pieces are encoded together
JOINED_WORDS = 2048

# Fixed values of Simple-8b: ids a word by selector, and their width in bits. Selector 0 escapes.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
LIMITS = np.array([1 << k for k in range(64)], np.uint64)
BITS = np.array([k.bit_length() for k in range(1 << 16)], np.int8)


def _selectors(values: np.ndarray) -> np.ndarray:
    """The widest-packing selector at every place of blocks (rows); what follows a block's end fits any."""
    width = BITS[values] if values.max() < len(BITS) else np.searchsorted(LIMITS, values, side="right").astype(np.int8)
    out = np.zeros(values.shape, np.int8)
    top = int(width.max())
    wide = np.zeros((len(values), BLOCK + 1), np.int16)  # ids too wide before each place
    for s in range(len(COUNTS) - 1, 0, -1):
        if s > 1 and WIDTHS[s - 1] >= top:
            continue  # a narrower selector, which takes more ids, fits everywhere
        np.cumsum(width > np.int8(WIDTHS[s]), axis=1, out=wide[:, 1:])
        whole = BLOCK - int(COUNTS[s]) + 1
        np.putmask(out[:, :whole], wide[:, BLOCK - whole + 1:] == wide[:, :whole], np.int8(s))
        np.putmask(out[:, whole:], wide[:, -1:] == wide[:, whole:-1], np.int8(s))
    return out


def encode_words(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of every block, raw ids) of unsigned 64-bit ids."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    blocks = -(-n // BLOCK)
    values = np.zeros((blocks, BLOCK), np.uint64)
    values.reshape(-1)[:n] = ids
    pick = _selectors(values).reshape(-1)
    flat, stop = values.reshape(-1), np.minimum(np.arange(1, blocks + 1) * BLOCK, n)
    at, live, starts, owners = np.arange(blocks) * BLOCK, np.arange(blocks), [], []
    while len(live):  # a word of every unfinished block a turn
        starts.append(at[live])
        owners.append(live)
        at[live] += COUNTS[pick[at[live]]]
        live = live[at[live] < stop[live]]
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    start, owner = np.concatenate(starts)[order], owner[order]
    sel = pick[start]
    words, raw = sel.astype(np.uint64) << np.uint64(60), flat[start[sel == 0]]
    words[sel == 0] = np.arange(len(raw), dtype=np.uint64)
    for s in np.unique(sel[sel > 1]):
        mine, step = np.nonzero(sel == s)[0], np.arange(COUNTS[s])
        place = start[mine][:, None] + step
        inside = place < stop[owner[mine]][:, None]
        part = np.where(inside, flat[np.minimum(place, n - 1)], np.uint64(0)) << (step * WIDTHS[s]).astype(np.uint64)
        words[mine] |= np.bitwise_or.reduce(part, axis=1)
    return words, np.searchsorted(owner, np.arange(blocks)).astype(np.uint64), raw


def decode_words(words: np.ndarray, first: np.ndarray, raw: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of ``encode_words``' result."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    sel = (words >> np.uint64(60)).astype(np.int64)
    first = first.astype(np.int64)
    owner = np.repeat(np.arange(len(first)), np.diff(first, append=len(words)))
    ahead = np.cumsum(COUNTS[sel]) - COUNTS[sel]
    start = ahead - ahead[first][owner] + owner * BLOCK
    stop = np.minimum((owner + 1) * BLOCK, n)
    out[start[sel == 0]] = raw[words[sel == 0].astype(np.int64)]
    for s in np.unique(sel[sel > 1]):
        mine, step = np.nonzero(sel == s)[0], np.arange(COUNTS[s])
        place = start[mine][:, None] + step
        part = (words[mine][:, None] >> (step * WIDTHS[s]).astype(np.uint64)) & np.uint64((1 << int(WIDTHS[s])) - 1)
        inside = place < stop[mine][:, None]
        out[place[inside]] = part[inside]
    return out


def segment(shard: int, before: int, docs: list[tuple[int | None, int, int]], ids: np.ndarray) -> bytes:
    """One segment without the line break that ends it; docs are (doc_id, ids here, flags)."""
    words, first, raw = encode_words(ids)
    head = np.array([MAGIC, shard, before, len(docs), len(ids), len(first), len(words), len(raw)], "<u8")
    entries = np.array([(d or 0, n, f | (d is None)) for d, n, f in docs], "<i8").reshape(-1, 3)
    return b"".join([head.tobytes(), entries.tobytes(), *[a.astype("<u8").tobytes() for a in (first, words, raw)], bytes(7)])


def read_segments(content: bytes) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(shard, ids before, document entries, ids) of each segment of a file."""
    at = 0
    while at < len(content):
        magic, shard, before, docs, n, blocks, n_words, n_raw = map(int, np.frombuffer(content, "<u8", 8, at))
        end = at + 8 * (9 + 3 * docs + blocks + n_words + n_raw)
        if magic != MAGIC or end > len(content) or content[end - 1] != 10:
            raise ValueError("not a whole segment")
        entries = np.frombuffer(content, "<i8", 3 * docs, at + 64).reshape(-1, 3)
        parts = np.split(np.frombuffer(content, "<u8", blocks + n_words + n_raw, at + 64 + 24 * docs), [blocks, blocks + n_words])
        yield shard, before, entries, decode_words(parts[1], parts[0], parts[2], n)
        at = end


def gathered(flat: np.ndarray, start: np.ndarray, length: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The runs of ``flat`` at some places, each a start and a length, one after another."""
    n = length[place]
    stop = np.cumsum(n)
    return flat[np.repeat(start[place] - stop + n, n) + np.arange(stop[-1] if len(stop) else 0)]


class Encoder:
    """The ids of whole texts as the tokenizers library gives them, for a byte-level tokenizer.

    A space between two characters that are no white space always begins a pre-token, so a text
    is cut there and the library encodes each distinct piece of a slice of texts once, many
    pieces joined again to a call: only a piece's first token begins with the space. Texts
    that hold a special token's string go to the library as they are."""

    # Unicode's white space, and the separators that Python counts as such
    SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
    # letters (Latin, whatever the version of Unicode) and what is certainly none
    WORD = "(?s)^(?P<head>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)(?P<tail>[\n!-@\\[-`{-~].*)$"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work out already
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.tok.model = self._uncached(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.near = re.sub(r"\\[xu]([0-9a-f]+)", r"\\x{\1}", f" {self.SPACE}|{self.SPACE} ")  # as Arrow spells it
        self.cut = re.compile(f"(?<!{self.SPACE}) (?!{self.SPACE}|$)")
        self.opens = np.zeros(self.tok.get_vocab_size(), bool)
        for token, i in self.tok.get_vocab().items():
            self.opens[i] = token.startswith("\u0120")  # how byte-level vocabularies spell the space

    @staticmethod
    def _uncached(path: str) -> models.BPE:
        """The file's model without the library's cache of words: pieces are distinct already."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        if model.pop("type") != "BPE":
            raise ValueError("not a byte-level BPE tokenizer")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.pop("merges")]
        return models.BPE(model.pop("vocab"), merges, cache_capacity=0, **{k: v for k, v in model.items() if v is not None})

    def _each(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of pieces, each a space and a word, and where each word's begin and how many
        they are. Letters end a pre-token where punctuation follows, so that is cut off first."""
        head, tail = pc.extract_regex(words, self.WORD).flatten()
        heads, tails = pc.coalesce(head, words).dictionary_encode(), pc.fill_null(tail, "").dictionary_encode()
        flat, start, length = self._opened(heads.dictionary)
        ends = self._each(tails.dictionary.to_pylist())
        n = np.array([len(x) for x in ends], np.int64)
        start, length = np.concatenate([start, len(flat) + np.cumsum(n) - n]), np.concatenate([length, n])
        place = np.stack([heads.indices.to_numpy(), len(heads.dictionary) + tails.indices.to_numpy()], axis=1)
        size = length[place].sum(axis=1)
        return gathered(np.concatenate([flat, *ends]), start, length, place.reshape(-1)), np.cumsum(size) - size, size

    def _opened(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``_pieces``, by the library. Words that hold more spaces are encoded one by one."""
        odd = pc.or_(pc.equal(words, ""), pc.match_substring(words, " ")).to_numpy(zero_copy_only=False)
        plain, odd = np.nonzero(~odd)[0], np.nonzero(odd)[0]
        groups = pa.ListArray.from_arrays(np.append(np.arange(0, len(plain), JOINED_WORDS), len(plain)).astype(np.int32), words.take(pa.array(plain)))
        joined = pc.binary_join(groups, " ").to_pylist() if len(plain) else []
        parts = [ids for lo in range(0, len(joined), 16) for ids in self._each([" " + x for x in joined[lo:lo + 16]])]
        begun = [np.nonzero(self.opens[x])[0] for x in parts]
        if sum(map(len, begun)) != len(plain):
            raise ValueError("not a byte-level tokenizer that cuts before single spaces")
        parts += self._each([" " + w for w in words.take(pa.array(odd)).to_pylist()])
        ahead = np.cumsum([0, *map(len, parts)])
        start = np.empty(len(words), np.int64)
        start[plain] = np.concatenate([np.zeros(0, np.int64), *[x + n for x, n in zip(begun, ahead)]])
        start[odd] = ahead[len(begun):-1]
        order = np.concatenate([plain, odd])
        length = np.empty(len(words), np.int64)
        length[order] = np.diff(start[order], append=ahead[-1])
        return np.concatenate([np.zeros(0, np.uint32), *parts]), start, length

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        has = lambda test: np.logical_or.reduce([np.zeros(len(texts), bool), *test]).nonzero()[0]
        whole = has([pc.match_substring(texts, t).to_numpy(zero_copy_only=False) for t in self.added])
        near = np.setdiff1d(has([pc.match_substring_regex(texts, self.near).to_numpy(zero_copy_only=False)]), whole)
        plain = np.setdiff1d(np.arange(len(texts)), np.concatenate([whole, near]))
        for i, ids in zip(whole, self._each(texts.take(pa.array(whole)).to_pylist())):
            out[i] = ids
        cut = pa.concat_arrays([pc.split_pattern(texts.take(pa.array(plain)), " "),
                                pa.array([self.cut.split(t) for t in texts.take(pa.array(near)).to_pylist()], pa.list_(pa.string()))])
        if not len(cut):
            return out
        words, offsets = cut.flatten(), np.append(0, np.cumsum(pc.list_value_length(cut).to_numpy()))
        found = words.dictionary_encode()
        place = found.indices.to_numpy().astype(np.int64)
        firsts = self._each(words.take(pa.array(offsets[:-1])).to_pylist())  # no space before them
        flat, start, length = self._pieces(found.dictionary)
        place[offsets[:-1]] = len(start) + np.arange(len(firsts))
        n = np.array([len(x) for x in firsts])
        start, length = np.append(start, len(flat) + np.cumsum(n) - n), np.append(length, n)
        flat = np.concatenate([flat, *firsts])
        size = np.add.reduceat(length[place], offsets[:-1])
        order = np.concatenate([plain, near])
        for lo in range(0, len(order), 512):  # some texts at a time bound the places held
            ids = gathered(flat, start, length, place[offsets[lo]:offsets[min(lo + 512, len(order))]])
            for i, one in zip(order[lo:], np.split(ids, np.cumsum(size[lo:lo + 512])[:-1])):
                out[i] = one
        return out


def slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """A batch of (doc_id, text) in runs of rows of at most ``size`` bytes of text, or one row."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + size, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def write_ids(docs: DataFrame, out: str, path: str, end_id: int, segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of every document, each followed by ``end_id``, to files below ``out``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard, end = Encoder(path), TaskContext.get().partitionId(), np.uint32(end_id)
        before, n, entries, held = 0, 0, [], []

        def flush() -> pa.RecordBatch:
            nonlocal before, n
            done = segment(shard, before, entries, np.concatenate(held).astype(np.uint64))
            before, n = before + n, 0
            entries.clear()
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([done], pa.binary())], names=["value"])

        for b in (part for batch in batches for part in slices(batch, SLICE_BYTES)):
            for doc_id, ids in zip(b.column(0).to_pylist(), encode(b.column(1))):
                ids = np.append(ids, end)
                size = len(ids)
                if n and (n + size > segment_ids or len(entries) >= segment_ids):
                    yield flush()
                for lo in range(0, size, segment_ids):
                    hi = min(size, lo + segment_ids)
                    entries.append((doc_id, hi - lo, 2 * (lo > 0) | 4 * (hi < size)))
                    held.append(ids[lo:hi])
                    n += hi - lo
                    if hi < size:
                        yield flush()
        if entries:
            yield flush()

    rows = doc_texts(docs).withColumn("_h", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    keys = ["doc_id", "_h", "_row"]  # the row number only deals out and orders equal rows
    ranged = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), *keys).sortWithinPartitions(*keys)
    (ranged.select("doc_id", "text").mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.mode("error").option("lineSep", "\n").option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(out))


def read_ids(spark: SparkSession, path: str, ids: bool = False) -> DataFrame:
    """The documents of the files, or their pieces if they are longer than a segment: shard,
    ids of the shard before, doc_id, flags, n_tokens, ids_crc32 and, if asked for, the ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                for shard, before, entries, found in read_segments(content.as_py()):
                    n = entries[:, 1]
                    stops = np.cumsum(n)
                    starts = stops - n
                    data = found.astype("<u4")
                    crc = [zlib.crc32(data[a:z]) for a, z in zip(starts, stops)]
                    cols = [pa.array(np.full(len(n), shard)), pa.array(before + starts),
                            pa.array(entries[:, 0], mask=(entries[:, 2] & 1).astype(bool)), pa.array(entries[:, 2]), pa.array(n), pa.array(crc, pa.int64())]
                    if ids:
                        cols.append(pa.ListArray.from_arrays(np.append(starts, len(found)).astype(np.int32), found.astype(np.int64)))
                    yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "shard long, before long, doc_id long, flags long, n_tokens long, ids_crc32 long" + ", ids array<long>" * ids
    names = [c.split()[0] for c in schema.split(", ")]
    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").load(path)
    return files.where("length > 0").select("content").mapInArrow(run, schema)


def _joined_crc(pieces: list[tuple[int, int, int]]) -> int:
    """The crc32 of pieces (place, ids, crc32) of 32-bit ids, put together in order of place."""
    crc = 0
    for _, n, one in sorted(pieces):
        zeros = bytes(4 * n)  # crc32 is linear: a start value is carried over zeros
        crc = zlib.crc32(zeros, crc) ^ zlib.crc32(zeros) ^ one
    return crc


def documents_of(pieces: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in ``read_ids``' rows. A shard's
    first id is found from the totals of the shards before it, one row a shard."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            crc = [_joined_crc([(p["before"], p["n_tokens"], p["ids_crc32"]) for p in r["pieces"]]) for r in rows]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(4)], pa.array(crc, pa.int64())], names=names)

    names = ["shard", "before", "doc_id", "n_tokens", "ids_crc32"]
    whole = pieces.where("(flags & 6) = 0").select(*names)
    # a piece's document is the shard's nth that is longer than a segment: few rows a shard
    cut = pieces.where("(flags & 6) <> 0").withColumn("nth", F.expr(
        "sum(int((flags & 2) = 0)) over (partition by shard order by before)"))
    parts = cut.groupBy("shard", "nth").agg(
        F.min("before").alias("before"), F.first("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"),
        F.collect_list(F.struct("before", "n_tokens", "ids_crc32")).alias("pieces"))
    long = parts.select("shard", "before", "doc_id", "n_tokens", "pieces").mapInArrow(
        join, "shard long, before long, doc_id long, n_tokens long, ids_crc32 long")
    totals = pieces.groupBy("shard").agg(F.sum("n_tokens").alias("n")).select(
        "shard", F.expr("sum(n) over (order by shard) - n").alias("ahead"))
    return whole.unionByName(long).join(totals, "shard").select(
        "doc_id", (F.col("ahead") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(spark: SparkSession, docs: DataFrame, path: str, end_id: int, out: str | None = None,
                     segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Write the documents' ids to ``out`` (a fresh scratch folder if not given) and tell, from
    the files, where each document's ids are."""
    out = out or scratch_path(spark, "ids")
    write_ids(docs, out, path, end_id, segment_ids)
    return documents_of(staged(read_ids(spark, out), "id-pieces"))
