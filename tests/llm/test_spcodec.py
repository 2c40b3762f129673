import hashlib
import random

import numpy as np
import public_tokenizers
import sentencepiece

from dcflow.llm import spcodec as S

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def texts():
    rnd = random.Random(4)
    out = ["", " ", "  ", "a", " a", "a ", "  a  b\n\tc ▁x▁▁y ", "<s> </s> <unk> <0x41>", "\x00é𝄞 ﷽ ½ ①", "x" * 3000, "a b " * 2000, "   　z"]
    chars = "ab cdé ßñ\n\t ▁<>1. 漢字😀́ "
    return out + ["".join(rnd.choice(chars) for _ in range(rnd.randint(1, 80))) for _ in range(400)]


def test_ids_and_spans_equal_the_library():
    codec = S.Codec(MODEL, memo_size=50)
    assert codec.cut is not None
    for t in texts():
        ids, spans = codec.encode(t)
        n = np.frombuffer(ids, "<u4").tolist()
        assert n == LIB.encode(t), t
        raw = t.encode()
        assert all(b <= e for b, e in spans) and (not n or (spans[0][0], spans[-1][1]) == (0, len(raw)))
        assert all(spans[i][1] == spans[i + 1][0] or spans[i][1] <= spans[i + 1][1] for i in range(len(spans) - 1))
        for i, (b, e) in zip(n, spans):  # a piece spells its span, but for spaces and the leading mark
            piece = LIB.id_to_piece(i)
            if LIB.is_byte(i):
                assert e - b == 1 and raw[b] == int(piece[3:5], 16)
            else:
                assert piece.replace("▁", " ").lstrip(" ") == raw[b:e].decode().replace("▁", " ").lstrip(" ")


def test_character_map_equals_the_library():
    """Longest-prefix normalisation through a real compiled map, with white space squeezed."""
    rnd = random.Random(9)
    chars = "aｱﾞﾃ①½ﬁ 　\t\n漢Ⅷé́éｶﾞ㌔ﷺ​…x"
    for rule in ("nmt_nfkc", "nfkc_cf", "identity"):
        lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=True)
        spec = b"".join(v for k, v in S.proto_fields(lib.serialized_model_proto()) if k == 3)
        own = S.Normalizer(spec)
        for _ in range(300):
            t = "".join(rnd.choice(chars) for _ in range(rnd.randint(0, 25)))
            norm, (at, begin, end, one) = own(t)
            want, offsets = lib.normalize(t, with_offsets=True)
            assert norm == want, (rule, t)
            starts = np.concatenate([[0], np.cumsum([len(c.encode()) for c in norm])])[:-1].astype(int)
            u = np.searchsorted(at, starts, side="right") - 1
            got = [len(t.encode()[:begin[k] + (s - at[k] if one[k] else 0)].decode()) for k, s in zip(u, starts)] if norm else []
            assert got == list(offsets)[:len(got)], (rule, t)


def test_rows(spark):
    rows = [(1, None), (None, "a b"), (2, "a b"), (2, "a b"), (3, "long " * 20000)]
    docs = spark.createDataFrame([(i, t, "clash") for i, t in rows], "doc_id long, text string, ids string")
    want = []
    for i, t in rows:
        ids = LIB.encode(t or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(LIB.decode(ids).encode()).hexdigest()))
    got = [tuple(r)[:4] for r in S.digests(docs, MODEL).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    out = {(r["doc_id"], len(r["ids"]) // 4, r["text"]) for r in S.encode_documents(docs, MODEL).collect()}
    assert (2, 4, "a b") in out and (1, 2, "") in out
    assert S.digests(docs.limit(0), MODEL).count() == 0
