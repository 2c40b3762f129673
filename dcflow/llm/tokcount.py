"""Token counts without ids: pieces are counted once per distinct pre-token.

Documents are cut into blocks of bounded size as they are scanned. A block keeps, for each
document, how often each of the block's pre-tokens occurs, and the block's own list of
distinct pre-tokens. The lists of all blocks are brought together by pre-token, each distinct
pre-token is encoded once, and its count goes back to the blocks that have it, where it meets
the documents' frequencies. What moves is one row per (block, distinct pre-token) and one
compact row per document, never a row per word. A block lists a pre-token once, so even one
that is everywhere has a tiny share of the rows.

Defined results: a null or empty text has no tokens; texts are counted whole; repeated rows
each get a row; an added special string inside a text is one token, as is the library's
default; a null doc_id stays null; extra columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import cache
from unicodedata import ucd_3_2_0

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from .common import doc_texts, staged

LIMIT = 512
#: a block ends after so many distinct pre-tokens or bytes of text (a longer text is a block
#: of its own)
BLOCK_PRETOKENS = 400_000
BLOCK_BYTES = 64 << 20


@cache
def _late() -> re.Pattern:
    """Characters added after Unicode 3.2. Whether they are letters or numbers depends on the
    Unicode version, which differs between the pattern library and the tokenizer."""
    late = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and ucd_3_2_0.category(chr(c)) == "Cn"]
    starts = [c for k, c in enumerate(late) if not k or late[k - 1] != c - 1]
    stops = [c for k, c in enumerate(late) if k + 1 == len(late) or late[k + 1] != c + 1]
    return re.compile("[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, stops)) + "]")


class PreTokens:
    """The pre-token counts of texts, for a byte-level tokenizer file."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            added = [t["content"] for t in json.load(f)["added_tokens"]]
        self.path, self.pattern, self.own = path, regex.compile(pattern).findall, None
        self.special = re.compile("|".join(re.escape(t) for t in sorted(added, key=len, reverse=True))) if added else None

    def find(self, text: str) -> list[str]:
        if text.isascii() or not _late().search(text):
            return self.pattern(text)
        if self.own is None:  # the tokenizer's own cuts, three times slower
            self.own = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self.own.pre_tokenize_str(text)]

    def __call__(self, text: str) -> tuple[Counter, int]:
        """Pre-token frequencies, and how many special strings stand between them."""
        parts = self.special.split(text) if self.special else [text]
        out = Counter(self.find(parts[0]))
        for p in parts[1:]:
            out.update(self.find(p))
        return out, len(parts) - 1


def pack(places, freq) -> bytes:
    """Places in order as differences, and frequencies, byte by byte so that they compress."""
    at, n = np.array(places, np.uint32), np.array(freq, np.uint32)
    order = np.argsort(at)
    pairs = np.stack([np.diff(at[order], prepend=np.uint32(0)), n[order]])
    return zlib.compress(pairs.astype("<u4").view(np.uint8).reshape(2, -1, 4).transpose(0, 2, 1).tobytes(), 1)


def unpack(refs: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(refs), np.uint8).reshape(2, 4, -1)
    step, n = np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u4").reshape(2, -1)
    return np.cumsum(step, dtype=np.int64), n.astype(np.int64)


def blocks(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """kind 0: (block, doc_id, n_bytes, special, refs) per document, refs being pairs of (place
    in the block's list, frequency); kind 1: (block, place, token)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, block = PreTokens(path, pattern), TaskContext.get().partitionId() << 32
        seen: dict[str, int] = {}
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            n, m = len(rows), len(seen)
            ids, n_bytes, special, refs = zip(*rows)
            return pa.RecordBatch.from_arrays([
                pa.array([0] * n + [1] * m, pa.int32()), pa.array([block] * (n + m), pa.int64()),
                pa.array([*ids, *[None] * m], pa.int64()), pa.array([*n_bytes, *[None] * m], pa.int64()),
                pa.array([*special, *[None] * m], pa.int64()), pa.array([*refs, *[None] * m], pa.binary()),
                pa.array([None] * n + [*range(m)], pa.int32()), pa.array([None] * n + [*seen], pa.string())],
                names=["kind", "block", "doc_id", "n_bytes", "special", "refs", "place", "token"])

        for b in batches:
            for doc_id, t in zip(b.column(0), b.column(1)):
                text = t.as_py()
                n_bytes = len(text.encode())
                if rows and (len(seen) >= BLOCK_PRETOKENS or size + n_bytes > BLOCK_BYTES):
                    yield flush()
                    block, size, rows = block + 1, 0, []
                    seen.clear()
                freq, special = count(text)
                places = [seen.setdefault(tok, len(seen)) for tok in freq]
                rows.append((doc_id.as_py(), n_bytes, special, pack(places, [*freq.values()])))
                size += n_bytes
        if rows:
            yield flush()

    return doc_texts(docs).mapInArrow(
        run, "kind int, block long, doc_id long, n_bytes long, special long, refs binary, place int, token string")


def priced(lists: DataFrame, path: str) -> DataFrame:
    """(block, prices) of the blocks' lists, prices being packed (place, pieces) pairs: equal
    pre-tokens come one after another, and each distinct one is encoded once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals the work out already
        tok = Tokenizer.from_file(path)
        tok.no_truncation()
        tok.no_padding()
        tok.encode_special_tokens = True
        tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)  # they are cut already
        last: dict[str, int] = {}
        for b in batches:
            tokens = b.column(2).to_pylist()
            new = [t for t in dict.fromkeys(tokens) if t not in last]
            for lo in range(0, len(new), 2048):
                part = new[lo:lo + 2048]
                last.update(zip(part, map(len, tok.encode_batch_fast(part, add_special_tokens=False))))
            block, place = b.column(0).to_numpy(), b.column(1).to_numpy()
            pieces = np.fromiter((last[t] for t in tokens), np.int64, len(tokens))
            order = np.argsort(block, kind="stable")
            groups = np.split(order, np.nonzero(np.diff(block[order]))[0] + 1) if len(order) else []
            yield pa.RecordBatch.from_arrays([pa.array([block[g[0]] for g in groups], pa.int64()),
                                              pa.array([pack(place[g], pieces[g]) for g in groups], pa.binary())], names=["block", "prices"])
            last = {t: last[t] for t in tokens[-1:]}  # a run may go on in the next batch

    return lists.repartition("token").sortWithinPartitions("token").mapInArrow(run, "block long, prices binary")


def token_counts(docs: DataFrame, path: str, pattern: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit, one row per row of ``docs``."""
    cut = staged(blocks(docs, path, pattern), "pretokens", partition_by="kind")
    prices = priced(cut.where("kind = 1").select("block", "place", "token"), path).withColumnRenamed("block", "of")
    rows = cut.where("kind = 0").select("block", "doc_id", "n_bytes", "special", "refs")

    def total(left: pa.Table, right: pa.Table) -> pa.Table:
        told = [unpack(x) for x in right.column("prices").to_pylist()]
        price = np.zeros(1 + max((int(at[-1]) for at, _ in told), default=-1), np.int64)
        for at, pieces in told:
            price[at] = pieces
        n = []
        for special, refs in zip(left.column("special").to_pylist(), left.column("refs").to_pylist()):
            at, freq = unpack(refs)
            n.append(special + int(price[at] @ freq))
        return pa.table({"doc_id": left.column("doc_id"), "n_bytes": left.column("n_bytes"), "n_tokens": pa.array(n, pa.int64())})

    out = rows.groupBy("block").cogroup(prices.groupBy("of")).applyInArrow(total, "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
