import io
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from granary.llm import simple8b, tokenfiles

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_words_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 239, 241, 1023, 1024, 1025, 5000):
        for high in (1, 2, 300, 50256, 2**31, 2**60 - 1):
            ids = rng.integers(0, high, n).astype(np.uint64)
            ids[rng.random(n) < rng.choice([0.0, 0.7])] = 0
            words, first = simple8b.pack(ids)
            assert (simple8b.unpack(words, first, n) == ids).all()
    edge = np.array([2**60 - 1, 2**53 + 1, 2**53 - 1, 2**59, 1, 0, 2**30], np.uint64)
    assert (simple8b.unpack(*simple8b.pack(edge), len(edge)) == edge).all()
    assert len(simple8b.pack(np.zeros(1024, np.uint64))[0]) == 5  # 240 zeros a word


def test_ids_of_more_than_60_bits_are_refused():
    try:
        simple8b.pack(np.array([2**60], np.uint64))
    except ValueError:
        return
    raise AssertionError


def test_any_run_of_documents_can_be_read(monkeypatch):
    monkeypatch.setattr(tokenfiles, "CHUNK_IDS", 2048)
    draw = random.Random(0)
    docs = [np.array([draw.randrange(50_000) for _ in range(draw.choice([0, 1, 700, 3000]))], np.uint32) for _ in range(30)]
    out = io.BytesIO()
    out.close, writer = (lambda: None), tokenfiles.FileWriter(out)
    for i, ids in enumerate(docs):
        writer.add(None if i == 0 else i, ids)
    writer.close()
    reader = tokenfiles.FileReader(pa.BufferReader(out.getvalue()))
    for a in range(30):
        for b in range(a + 1, 31):
            assert reader.tokens_of(a, b).tolist() == np.concatenate(docs[a:b]).tolist()


def test_corpus_order_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(tokenfiles, "FILE_IDS", 50)
    texts = [(5, "five five"), (1, None), (3, ""), (2, "a  b <|endoftext|> é日本" * 9), (2, "same id"), (9, "x " * 3000), (None, "none"), (-4, "minus\n")]
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "'x' as start", "1 as h", "2 as path")
    got = sorted(tokenfiles.round_trip(df, PATH).collect(), key=lambda r: r.start)
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    want = {(i, len(e), zlib.crc32(np.array(e, "<u4").tobytes())) for i, t in texts
            for e in [tokenizer.encode(t or "", add_special_tokens=False).ids + [0]]}
    assert {(r.doc_id, r.n_tokens, r.ids_crc32) for r in got} == want
    assert [r.doc_id for r in got] == [None, -4, 1, 2, 2, 3, 5, 9]
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got[:-1]]]).tolist()
    assert tokenfiles.round_trip(df.limit(0), PATH).count() == 0


def test_ids_beyond_doubles_beside_a_null(spark):
    df = spark.createDataFrame([(2**60 + 1, "a"), (2**60 + 2, "b"), (None, "c"), (-(2**60) - 1, "d")], "doc_id long, text string").coalesce(1)
    got = sorted(tokenfiles.round_trip(df, PATH).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None, -(2**60) - 1, 2**60 + 1, 2**60 + 2]


def test_packing_is_greedy_and_costs_little_more_than_unpacking():
    rng = np.random.default_rng(9)
    ids = (rng.integers(0, 1 << 16, 3 * simple8b.BLOCK + 77) >> rng.integers(0, 17, 3 * simple8b.BLOCK + 77)).astype(np.uint64)
    ids[1000:1700] = 0  # across the end of a block
    words, first = simple8b.pack(ids)
    want, begins = [], []
    for block in range(0, len(ids), simple8b.BLOCK):
        own, at = ids[block : block + simple8b.BLOCK].tolist(), 0
        begins.append(len(want))
        while at < len(own):
            s = next(s for s in range(16) if all(x >> int(simple8b.WIDTHS[s]) == 0 for x in own[at : at + int(simple8b.COUNTS[s])]))
            taken = own[at : at + int(simple8b.COUNTS[s])]
            want.append(s << 60 | sum(x << j * int(simple8b.WIDTHS[s]) for j, x in enumerate(taken)))
            at += len(taken)
    assert words.tolist() == want and first.tolist() == begins

    many = (rng.integers(0, 50_000, 1 << 18) >> rng.integers(0, 12, 1 << 18)).astype(np.uint64)

    def seconds(work):
        spent = []
        for _ in range(5):
            begun = time.process_time()
            work()
            spent.append(time.process_time() - begun)
        return min(spent)

    packed = simple8b.pack(many)
    assert seconds(lambda: simple8b.pack(many)) < 6 * seconds(lambda: simple8b.unpack(*packed, len(many)))
