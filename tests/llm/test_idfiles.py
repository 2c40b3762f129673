import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dcflow.llm import idfiles as I

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [1, 2, 119, 120, 121, 255, 256, 257, 5000])
def test_words_round_trip(n):
    rnd = np.random.default_rng(n)
    for top in (1, 2, 8, 16, 31, 60, 64):
        for ids in (rnd.integers(0, 1 << top, n, dtype=np.uint64, endpoint=False) if top < 64 else rnd.integers(0, 2**64 - 1, n, dtype=np.uint64),
                    np.where(rnd.random(n) < 0.02, np.uint64((1 << top) - 1), np.uint64(0))):
            words, first, raw = I.encode_words(ids)
            assert (I.decode_words(words, first, raw, n) == ids).all()


def test_words_are_as_full_as_greedy_packing_makes_them():
    ids = np.array([0] * 120 + [1] * 60 + [1 << 59] + [50000] * 3 + [1 << 62] + [5, 6, 7], np.uint64)
    words, first, raw = I.encode_words(ids)
    assert [int(w >> np.uint64(60)) for w in words] == [1, 2, 15, 13, 0, 4] and list(raw) == [1 << 62] and list(first) == [0]
    # one id after another, greedily
    rnd = random.Random(3)
    ids = [rnd.getrandbits(rnd.choice([1, 3, 8, 16])) for _ in range(2000)]
    want, at = [], 0
    while at < len(ids):
        stop = min(len(ids), (at // I.BLOCK + 1) * I.BLOCK)
        s = next(s for s in range(1, 16) if all(x < 1 << int(I.WIDTHS[s]) for x in ids[at:min(stop, at + int(I.COUNTS[s]))]))
        want.append(s)
        at = min(stop, at + int(I.COUNTS[s]))
    assert [int(w >> np.uint64(60)) for w in I.encode_words(np.array(ids, np.uint64))[0]] == want


def _rows():
    rnd = random.Random(11)
    chars = ["a", "the ", " I'll", "é", "\n", "  ", "\t", "1", "99", "<|endoftext|>", "漢", "😀", ".", "'s", "_", " "]
    rows = [(1, None), (2, ""), (None, "a b"), (3, "<|endoftext|>"), (4, "z" * 30000), (5, "wé " * 4000), (-7, "x<|endoftext|> <|endoftext|"), (11, "same"), (11, "same"), (11, "other")]
    return rows + [(20 + i, "".join(rnd.choice(chars) for _ in range(rnd.randint(1, 200)))) for i in range(200)]


@pytest.mark.parametrize("segment_ids", [1 << 18, 1000])
def test_files_hold_the_library_ids_in_order(spark, segment_ids):
    rows, lib = _rows(), Tokenizer.from_file(PATH)
    docs = spark.createDataFrame([(t, i, 7) for i, t in rows], "text string, doc_id long, start int").repartition(3)
    out = I.scratch_path(spark, "test-ids")
    got = sorted(map(tuple, I.encode_documents(spark, docs, PATH, 2, out, segment_ids).collect()), key=lambda r: r[1])
    ids = {t: [*lib.encode(t or "", add_special_tokens=False).ids, 2] for _, t in rows}
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t)
    assert [r[0] for r in got] == [i for i, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]
    at = 0
    for doc_id, start, n, crc in got:
        mine = [t for t in texts[doc_id] if zlib.crc32(np.array(ids[t], "<u4").tobytes()) == crc and len(ids[t]) == n]
        assert start == at and mine, doc_id
        at += n
    # the ids themselves, in order of shard and place
    read = sorted(map(tuple, I.read_ids(spark, out, ids=True).select("shard", "before", "doc_id", "ids").collect()))
    spelt = [x for *_, xs in read for x in xs]
    assert len(spelt) == at and [x for x in spelt if x == 2].__len__() >= len(rows)
    assert zlib.crc32(np.array(spelt[got[5][1]:got[5][1] + got[5][2]], "<u4").tobytes()) == got[5][3]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert I.encode_documents(spark, docs, PATH, 2).collect() == []


def test_a_cut_file_is_refused():
    whole = I.segment(0, 0, [(1, 3, 0)], np.array([1, 2, 3], np.uint64)) + b"\n"
    assert [list(x[3]) for x in I.read_segments(whole + whole)] == [[1, 2, 3]] * 2
    with pytest.raises(ValueError):
        list(I.read_segments(whole[:-8]))


def test_encoder_equals_the_library():
    rnd, lib, own = random.Random(8), Tokenizer.from_file(PATH), I.Encoder(PATH)
    chars = ["a", "the", "I'll", "é", "\n", " ", " ", " ", "  ", "   ", "\t", "\u00a0", "\u3000", "\x1c", "\u180e", "1", "99", "<|endoftext|>", "漢", "😀", ".", "'s", "_", "\u0120"]
    texts = ["".join(rnd.choice(chars) for _ in range(rnd.randint(0, 60))) for _ in range(4000)] + ["", " ", "  ", "a ", " a", "\n ", " \n", "x" * 9000]
    for lo in range(0, len(texts), 500):
        part = texts[lo:lo + 500]
        for t, ids in zip(part, own(pa.array(part))):
            assert list(ids) == lib.encode(t, add_special_tokens=False).ids, repr(t)
    every = [f"a{chr(c)} {chr(c)}b {chr(c)}" for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(every), 20000):
        part = every[lo:lo + 20000]
        assert [list(x) for x in own(pa.array(part))] == [e.ids for e in lib.encode_batch(part, add_special_tokens=False)]
