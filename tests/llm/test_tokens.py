"""Problem 7: ids equal the public encoders' on odd texts, and every row comes out."""

import random

import pytest

from sheafline.llm.tokens import VOCABULARY, ForcedBoundaryEncoder, encode_corpus


@pytest.fixture(scope="module")
def enc():
    return ForcedBoundaryEncoder(VOCABULARY)


def pieces(enc, texts):
    ids, n = enc.encode(texts)
    out, at = [], 0
    for k in n:
        out.append(ids[at : at + k].tolist())
        at += k
    return out


def test_equal_to_plain_encoding(enc):
    rng = random.Random(7)
    pool = "ab Z'sre 09\n\t\r\x0b\x1c\x1f\x85 　​中文字高考α²éカ한ไ🙂𠀀́<|endoftext|>"
    texts = ["", " ", "\n\n", "<|endoftext|>", "a" * 5000, "中" * 3000, "  x  y   "]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(800)]
    assert pieces(enc, texts) == [enc.core.encode_ordinary(t) for t in texts]


def test_equal_to_the_other_library(enc):
    from tokenizers import Tokenizer

    other = Tokenizer.from_file(VOCABULARY.replace(".tiktoken", ".json"))
    other.encode_special_tokens = True  # their strings in a text are ordinary text
    texts = ["已知小车质量为3.5 kg。\r\n  The cart's", "<|endoftext|>", "\x0b\x0c \u3000 \ufeff", "한국어 ไทย \U0001f600\u200d"]
    assert pieces(enc, texts) == [x.ids for x in other.encode_batch(texts, add_special_tokens=False)]


def test_round_trip(enc):
    text = "已知小车质量为3.5 kg，求加速度。\r\nThe cart \U0001f600"
    assert enc.core.decode(pieces(enc, [text])[0]) == text


def test_rows(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, None, "x"), (3, "", "y"), (3, "", "y"), (None, "中文", "z")], "doc_id long, text string, ids string")
    got = sorted(((r.doc_id or 0, list(r.ids)) for r in encode_corpus(df).collect()))
    assert [g[0] for g in got] == [0, 1, 2, 3, 3]
    assert [len(g[1]) > 0 for g in got] == [True, True, False, False, False]
    assert encode_corpus(df.limit(0)).collect() == []
