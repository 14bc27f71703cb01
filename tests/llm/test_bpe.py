import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from granary.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RAW = open(PATH, "rb").read()
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(RAW, PATTERN)


@pytest.fixture(scope="module")
def known():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(RAW), special_tokens={})


def test_ids_are_the_librarys(coder, known):
    draw = random.Random(2)
    alphabet = list(" \n\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0 　'aAbZéñß日本語1２٣!?.#…😀́") + ["  ", "'ll", " the", " \n", "hello", "aaaaaa"]
    texts = ["".join(draw.choice(alphabet) for _ in range(draw.randrange(30))) for _ in range(5000)]
    for text, ids in zip(texts, coder.encode(texts)):
        assert ids.tolist() == known.encode_ordinary(text), repr(text)
        assert coder.encoder.decode(ids) == text.encode()


def test_very_long_pieces(coder, known):
    draw = random.Random(3)
    for text in ("a" * 5000, "".join(draw.choice("abcdef") for _ in range(5000)), " " * 3000):
        assert coder.encode([text])[0].tolist() == known.encode_ordinary(text)


def test_hash_table_holds_every_pair(coder):
    table = coder.encoder.merges
    kept = np.flatnonzero(table.keys >= 0)
    assert (table.rank(table.keys[kept] >> 32, table.keys[kept] & 0xFFFFFFFF) == table.ranks[kept]).all()
    assert (table.rank(np.array([-1, 5]), np.array([5, -1])) == bpe.NONE).all()


def test_memory_is_bounded(coder, known, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    for i in range(20):
        assert coder.encode([f"word{i} and more"])[0].tolist() == known.encode_ordinary(f"word{i} and more")
    assert len(coder.encode.__self__.place) <= 3 + 3


def test_odd_rows(spark, known):
    rows = [(1, None), (2, ""), (3, "x <|endoftext|> y"), (3, "x <|endoftext|> y"), (None, "é" * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as ids", "0 as d")
    out = bpe.round_trip(df, PATH, PATTERN).collect()
    assert [r.n_tokens for r in out] == [len(known.encode_ordinary(t or "")) for _, t in rows]
    assert out[2] == out[3]
    ids = bpe.encode(df, PATH, PATTERN)
    assert [bytes(r.decoded).decode() for r in bpe.decode(ids, PATH, PATTERN).collect()] == [t or "" for _, t in rows]
    assert bpe.round_trip(df.limit(0), PATH, PATTERN).count() == 0
    both = bpe.encode_and_verify(df, PATH, PATTERN)
    assert both.columns == ["doc_id", "text", "d", "ids", "decodes"] and all(r.decodes for r in both.collect())
    assert [r.ids for r in both.collect()] == [r.ids for r in ids.collect()]
