"""SentencePiece encoding with byte spans of the original text, and decoding.

The text is first normalised as the model asks: at each place the longest prefix found in
the compiled character map is replaced, white space is escaped, and every step records which
original bytes each normalised byte stems from. The normalised text is cut where no piece
can reach across (a letter before a word mark), each distinct cut is encoded once by the
library with its own normaliser switched off, and the pieces laid end to end are projected
through the alignment to spans of original bytes.

Defined results: a null or empty text is encoded as the empty text (begin and end ids only);
very long texts are encoded whole; repeated rows get equal results; a null doc_id stays null;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from .common import doc_texts

MARK = "▁"
BEGIN_MARK = MARK.encode()


def _varint(b: bytes, i: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        out |= (b[i] & 127) << shift
        shift += 7
        i += 1
        if b[i - 1] < 128:
            return out, i


def proto_fields(b: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protocol-buffer message."""
    i = 0
    while i < len(b):
        tag, i = _varint(b, i)
        if tag & 7 == 0:
            v, i = _varint(b, i)
        else:
            n, i = (4, i) if tag & 7 == 5 else (8, i) if tag & 7 == 1 else _varint(b, i)
            v, i = b[i:i + n], i + n
        yield tag >> 3, v


def char_map(blob: bytes) -> dict[str, str]:
    """All rules of a compiled character map: a double-array trie of the sources, then the
    replacements as zero-ended strings."""
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units = np.frombuffer(blob[4:4 + size], np.uint32).astype(np.int64)
    texts, labels = blob[4 + size:], units & ((1 << 31) | 0xFF)
    offset = lambda u: (u >> 10) << ((u & (1 << 9)) >> 6)
    rules, every, stack = {}, np.arange(1, 256), [(offset(int(units[0])), b"")]
    while stack:
        base, key = stack.pop()
        kids = base ^ every
        ok = kids < len(units)
        kids, byte = kids[ok], every[ok]
        for node, c in zip(kids[labels[kids] == byte], byte[labels[kids] == byte]):
            unit, k = int(units[node]), key + bytes([c])
            below = int(node) ^ offset(unit)
            if unit >> 8 & 1:
                at = int(units[below]) & ((1 << 31) - 1)
                rules[k.decode()] = texts[at:texts.index(b"\0", at)].decode()
            stack.append((below, k))
    return rules


class Normalizer:
    """Normalisation as a model's specification asks, with source alignment."""

    def __init__(self, spec: bytes, keep: list[str] = ()):
        f = dict(proto_fields(spec))
        self.rules = char_map(f.get(2, b""))
        self.prefix, self.squeeze, self.escape = bool(f.get(3, 1)), bool(f.get(4, 1)), bool(f.get(5, 1))
        self.rules |= {k: k for k in keep}  # user-defined symbols stay as they are
        self.longest: dict[str, int] = {}
        for k in self.rules:
            self.longest[k[0]] = max(len(k), self.longest.get(k[0], 0))
        own = {*self.longest, " "} if self.squeeze or self.escape else {*self.longest}
        self.special = re.compile("[" + re.escape("".join(sorted(own))) + "]") if own else None
        self.plain = not self.rules and not self.squeeze

    def units(self, text: str) -> Iterator[tuple[str, str]]:
        """(source, replacement) pairs, longest prefix first; text no rule touches is one unit."""
        at = 0
        while at < len(text):
            m = self.special.search(text, at) if self.special else None
            if not m:
                yield text[at:], text[at:]
                return
            if m.start() > at:
                yield text[at:m.start()], text[at:m.start()]
            at = m.start()
            for n in range(self.longest.get(text[at], 0), 0, -1):
                if (src := text[at:at + n]) in self.rules:
                    break
            else:
                src = text[at]
            yield src, self.rules.get(src, src)
            at += len(src)

    def __call__(self, text: str) -> tuple[str, tuple[np.ndarray, ...]]:
        """The normalised text and its alignment: for each unit its first normalised byte, its
        original bytes, and whether its bytes correspond one to one."""
        space = MARK if self.escape else " "
        if self.plain:
            return self._plain(text, space)
        out: list[str] = []
        norm, begin, end, one = [], [], [], []
        at = length = 0
        was_space = self.squeeze

        def put(s: str, b: int, e: int) -> None:
            nonlocal length
            n = len(s.encode())
            out.append(s)
            norm.append(length), begin.append(b), end.append(e), one.append(n == e - b)
            length += n

        for src, dst in self.units(text):
            stop = at + len(src.encode())
            if self.squeeze and was_space:
                dst = dst.lstrip(" ")
            if dst:
                if self.prefix and not out:
                    put(space, at, at)
                if src == dst and " " not in dst:
                    put(dst, at, stop)
                else:
                    for c in dst:
                        put(space if c == " " else c, at, stop)
                was_space = self.squeeze and dst.endswith(" ")
            at = stop
        while self.squeeze and out and out[-1] == space:
            for x in (out, norm, begin, end, one):
                x.pop()
        return "".join(out), tuple(np.array(x, np.int64) for x in (norm, begin, end, one))

    def _plain(self, text: str, space: str) -> tuple[str, tuple[np.ndarray, ...]]:
        """The same, vectorised, where only single spaces change."""
        if not text:
            return "", tuple(np.array([], np.int64) for _ in range(4))
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        spaces = np.nonzero(raw == 32)[0]
        wide = len(space.encode())
        # units: each space, and each stretch between spaces (which may be empty)
        starts = np.concatenate([[0], spaces + 1])
        begin, end = np.empty(2 * len(spaces) + 1, np.int64), np.empty(2 * len(spaces) + 1, np.int64)
        begin[0::2], begin[1::2] = starts, spaces
        end[0::2], end[1::2] = np.concatenate([spaces, [len(raw)]]), spaces + 1
        size = end - begin
        size[1::2] = wide
        lead = wide if self.prefix else 0
        norm = lead + np.concatenate([[0], np.cumsum(size)[:-1]])
        one = np.ones(len(begin), np.int64)
        one[1::2] = wide == 1
        if lead:
            norm, begin, end, one = (np.concatenate([[x], v]) for x, v in ((0, norm), (0, begin), (0, end), (0, one)))
        full = norm < np.concatenate([norm[1:], [lead + size.sum()]])
        return (space if lead else "") + text.replace(" ", space), (norm[full], begin[full], end[full], one[full])


def project(ends: np.ndarray, align: tuple[np.ndarray, ...]) -> np.ndarray:
    """Original (begin, end) bytes of pieces laid end to end, given their normalised ends."""
    if not len(ends):
        return np.empty((0, 2), np.int64)
    norm, begin, end, one = align
    first = np.concatenate([[0], ends[:-1]])
    u, v = np.searchsorted(norm, first, side="right") - 1, np.searchsorted(norm, ends - 1, side="right") - 1
    return np.stack([begin[u] + np.where(one[u], first - norm[u], 0),
                     np.where(one[v], begin[v] + ends - norm[v], end[v])], axis=1)


class Codec:
    """Encoder and decoder of one model file."""

    def __init__(self, model_path: str, memo_size: int = 200_000):
        with open(model_path, "rb") as f:
            raw = f.read()
        pieces = [dict(proto_fields(v)) for k, v in proto_fields(raw) if k == 1]
        spec = b"".join(v for k, v in proto_fields(raw) if k == 3)
        names = [p[1].decode() for p in pieces]
        kinds = [p.get(3, 1) for p in pieces]
        self.model = sentencepiece.SentencePieceProcessor(model_proto=raw)
        # the same model that leaves its input as it is: fields of a repeated message are merged,
        # and identity, no map, no prefix, no squeezing and no escaping come last
        off = b"\x0a\x08identity\x12\x00\x18\x00\x20\x00\x28\x00"
        self.bare = sentencepiece.SentencePieceProcessor(model_proto=raw + b"\x1a" + bytes([len(off)]) + off)
        own = [n for n, k in zip(names, kinds) if k == 4]
        self.normalize = Normalizer(spec, own)
        # 6: a byte; anything else covers its own text
        self.size = np.array([1 if k == 6 else len(n.encode()) for n, k in zip(names, kinds)], np.int64)
        inner = any(MARK in n.lstrip(MARK) for n in names)
        self.cut = None if inner or own or not self.normalize.escape else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.unk = self.model.unk_id()
        self.memo: dict[str, bytes] = {}
        self.memo_size = memo_size
        self.begin, self.end = (np.array([x], "<u4").tobytes() for x in (self.model.bos_id(), self.model.eos_id()))

    def _encode_parts(self, parts: list[str]) -> list[bytes]:
        new = [p for p in {*parts} if p not in self.memo]
        if len(self.memo) + len(new) > self.memo_size:
            self.memo.clear()
            new = [*{*parts}]
        for lo in range(0, len(new), 4096):
            for p, ids in zip(new[lo:lo + 4096], self.bare.encode(new[lo:lo + 4096], num_threads=1)):
                self.memo[p] = np.array(ids, "<u4").tobytes()
        return [self.memo[p] for p in parts]

    def encode(self, text: str) -> tuple[bytes, np.ndarray]:
        """Ids without begin and end, as little-endian unsigned 32-bit integers, and the span
        of original bytes of each."""
        norm, align = self.normalize(text)
        parts = self.cut.findall(norm) if self.cut else [norm] if norm else []
        ids = b"".join(self._encode_parts(parts))
        n = np.frombuffer(ids, "<u4")
        size = self.size[n]
        if (n == self.unk).any():  # without byte fallback an unknown piece covers unknown text
            size = np.array([len(p.surface.encode()) for p in self.bare.encode_as_immutable_proto(norm).pieces], np.int64)
        return ids, project(np.cumsum(size), align)

    def decode(self, ids: bytes) -> str:
        return self.model.decode(np.frombuffer(ids, "<u4").tolist())


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids binary, spans binary, text): ids with begin and end as little-endian
    unsigned 32-bit integers, spans as (begin, end) 64-bit pairs of the pieces between them,
    and the decoded text; one row per row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model_path)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part, ids, spans, texts = b.slice(lo, 256), [], [], []
                for t in part.column(1):
                    own, span = codec.encode(t.as_py())
                    ids.append(codec.begin + own + codec.end)
                    spans.append(span.astype("<i8").tobytes())
                    texts.append(codec.decode(ids[-1]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(spans, pa.binary()), pa.array(texts, pa.string())],
                                                 names=["doc_id", "ids", "spans", "text"])

    return doc_texts(docs).mapInArrow(run, "doc_id long, ids binary, spans binary, text string")


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and spans_sha256 (of the piece spans)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, sha = Codec(model_path), lambda x: hashlib.sha256(x).hexdigest()
        for b in batches:
            rows = []
            for t in b.column(1):
                own, span = codec.encode(t.as_py())
                ids = codec.begin + own + codec.end
                rows.append((len(ids) // 4, sha(ids), sha(codec.decode(ids).encode()), sha(span.astype("<i8").tobytes())))
            cols = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[0], pa.int64()), *[pa.array(c, pa.string()) for c in cols[1:]]],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])

    return doc_texts(docs).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, spans_sha256 string")
