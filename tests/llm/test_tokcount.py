import random

import public_tokenizers
from tokenizers import Tokenizer

from dcflow.llm import tokcount as T

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_pre_tokens_equal_the_library():
    lib, own = Tokenizer.from_file(PATH).pre_tokenizer, T.PreTokens(PATH, public_tokenizers.PATTERN)
    for c in range(0x30000):
        if not 0xD800 <= c < 0xE000:
            text = "a" + chr(c) + " " + chr(c) + "1" + chr(c)
            assert own.find(text) == [text[s:e] for _, (s, e) in lib.pre_tokenize_str(text)], hex(c)


def test_counts_equal_the_library(spark, monkeypatch):
    rnd = random.Random(6)
    chars = ["a", "the ", " I'll", "é", "\n", "  ", "\t", "1", "99", "<|endoftext|>", "漢", "😀", ".", "'s", "_", " "]
    rows = [(1, None), (2, ""), (None, "a b"), (3, "<|endoftext|>"), (3, "x<|endoftext|> <|endoftext|"), (4, "z" * 30000), (5, "wé " * 40000)]
    rows += [(10 + i, "".join(rnd.choice(chars) for _ in range(rnd.randint(1, 200)))) for i in range(200)] + [(11, "same"), (11, "same")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_tokens int").repartition(3)
    lib = Tokenizer.from_file(PATH)
    want = []
    for i, t in rows:
        n = len(lib.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 512))
    got = [tuple(r) for r in T.token_counts(docs, PATH, public_tokenizers.PATTERN).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert T.token_counts(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
