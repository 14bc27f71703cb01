"""Order MinHash fingerprints of texts: minimal k-mers that keep their order in the text.

A k-mer is K successive code points; the o-th occurrence of a k-mer counts as a k-mer of its
own. For each of SKETCHES permutations of the (k-mer, occurrence) hashes (each flips a fixed set
of their bits) the TUPLE smallest are selected, put in the order of their places in the text,
and their k-mers hashed together; 16 bits of that are kept. Two texts agree in a sketch if they select the same k-mers in the same
order, so the share of agreeing sketches falls with the edit distance, and moved passages count
as edits, as they don't in a plain MinHash. A text is sorted once by the hashes of its k-mers; what a
permutation selects is then found by binary search. A text takes some 60 bytes a code point.

:func:`with_edits` compares every text with an edited one and with the next document. Documents
are dealt out by ranges of (doc_id, hash) and stream by in order, so a text meets its successor
where both lie; only the first and last text of each range meet through a join.

Results: null and empty texts have a fingerprint of zeros, and likeness 1 to each other; a text
shorter than K is one k-mer; equal texts have equal fingerprints; order is by descending doc_id,
null last, rows of one doc_id by the hash of their text; a single document is its own successor;
an empty table gives no rows; further columns are left behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.common import concat, slices
from granary.session import durable

K, TUPLE, SKETCHES = 5, 2, 64
_STEP, _GOLD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_MASKS = np.random.default_rng(11).integers(0, 1 << 64, SKETCHES, np.uint64)
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def kmers(text: str) -> np.ndarray:
    """Hashes of the k-mers of a text, in order; a short text is one, an empty one has none."""
    codes = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    n, width = max(len(codes) - K + 1, min(1, len(codes))), min(K, len(codes))
    out = np.full(n, width, np.uint64)
    for j in range(width):
        out = out * _STEP + codes[j : j + n]
    return _mixed(out)


def numbered(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of the (k-mer, occurrence) pairs and their places; a first occurrence has its k-mer's hash."""
    place = np.argsort(hashes, kind="stable")
    run = hashes[place]
    again = np.concatenate([[False], run[1:] == run[:-1]])
    if not again.any():
        return run, place
    at = np.arange(len(run))
    before = (at - np.maximum.accumulate(np.where(again, 0, at)))[again]
    key = np.concatenate([run[~again], _mixed(run[again] + before.astype(np.uint64) * _GOLD)])
    order = np.argsort(key, kind="stable")
    return key[order], np.concatenate([place[~again], place[again]])[order]


def selected(key: np.ndarray, count: int) -> np.ndarray:
    """For each permutation, indexes of the ``count`` keys it makes smallest; ``key`` is sorted.

    What ``key ^ mask`` makes smallest shares the longest leading bits with the mask: keys with
    the mask's first bits are a range of the sorted keys, and if it has enough of them no other
    key counts. Masks whose range has too few take shorter prefixes.
    """
    low, high = np.zeros(SKETCHES, np.int64), np.full(SKETCHES, len(key))
    bits = max(0, (len(key) // (2 * count)).bit_length() - 1)
    waiting = np.arange(SKETCHES)
    while bits > 0 and len(waiting):
        shift = np.uint64(64 - bits)
        prefix = (_MASKS[waiting] >> shift) << shift
        a = np.searchsorted(key, prefix)
        b = np.searchsorted(key, prefix | ((np.uint64(1) << shift) - np.uint64(1)), side="right")
        low[waiting], high[waiting] = a, b
        waiting = waiting[b - a < count]
        bits -= 2
    low[waiting], high[waiting] = 0, len(key)
    width = int((high - low).max())
    at = low[:, None] + np.arange(width)
    far = np.where(at < high[:, None], key[np.minimum(at, len(key) - 1)] ^ _MASKS[:, None], _MOST)
    return low[:, None] + np.argsort(far, axis=1, kind="stable")[:, :count]


def sketches(hashes: np.ndarray) -> np.ndarray:
    """The SKETCHES values of 16 bits for the k-mers of a text."""
    if not len(hashes):
        return np.zeros(SKETCHES, np.uint16)
    key, place = numbered(hashes)
    count = min(TUPLE, len(key))
    out = np.full(SKETCHES, count, np.uint64)
    for at in np.sort(place[selected(key, count)], axis=1).T:  # in the order of the text
        out = _mixed(out * _STEP + hashes[at])
    return (out >> np.uint64(48)).astype(np.uint16)


def spelled(found: np.ndarray) -> str:
    return found.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as many code points from the start of ``following``, or all of it."""
    m = len(text) // 3
    return text[: len(text) - m] + following[:m]


def fingerprint_column(text: Column) -> Column:
    """Fingerprint of a text as hexadecimal digits."""

    @F.arrow_udf("string")
    def prints(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield concat((pa.array([spelled(sketches(kmers(t or ""))) for t in part.to_pylist()], pa.string()) for part in slices(batch)), pa.string())

    return prints(text)


_RESULT = [
    ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
]
_ROW = pa.schema([("doc_id", pa.int64()), ("place", pa.string()), ("part", pa.int32()), ("text", pa.string()), *_RESULT])
_RESULT_SQL = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [name for name, _ in _RESULT]


def compared(text: str, own: np.ndarray, following: str, theirs: np.ndarray) -> tuple:
    """A text with its edited one and its successor."""
    changed = edited(text, following)
    found = sketches(kmers(changed))
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return len(text), digest, spelled(own), spelled(found), likeness(own, found), likeness(own, theirs)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order: results of all but the last, whose text goes on, as does that of the first."""
    part, held = TaskContext.get().partitionId(), None
    nothing = (None,) * len(_RESULT)
    batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ROW)], schema=_ROW)
    for batch in batches:
        at = 0
        for piece in slices(batch.column("text")):
            rows = []
            for doc, text in zip(batch.column("doc_id").slice(at, len(piece)).to_pylist(), piece.to_pylist()):
                now = (doc, text, sketches(kmers(text)))
                if held is None:
                    rows.append((doc, "first", part, text, *nothing))
                else:
                    rows.append((held[0], None, part, None, *compared(*held[1:], *now[1:])))
                held = now
            at += len(piece)
            yield batch_of(rows)
    if held is not None:
        yield batch_of([(held[0], "last", part, held[1], *nothing)])


def with_edits(documents: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, fingerprints of every text and its edited one, and their likeness and that to the next document."""
    order = [F.col("doc_id").desc_nulls_last(), F.col("h")]
    rows = documents.select("doc_id", F.coalesce(text, F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("h")
    sql = f"doc_id long, place string, part int, text string, {_RESULT_SQL}"
    found = durable(dealt.mapInArrow(_streamed, sql))
    firsts = found.where("place = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    # numbers of the parts that have rows, a number for each task; after the last comes the first
    numbers = firsts.select(F.col("next_part").alias("part"))
    whole, up = Window.partitionBy(), Window.orderBy("part")
    nexts = numbers.select("part", F.coalesce(F.lead("part").over(up), F.min("part").over(whole)).alias("next_part"))
    lasts = found.where("place = 'last'").select("doc_id", "part", "text").join(nexts, "part").join(firsts, "next_part")

    @F.arrow_udf(f"struct<{', '.join(x.replace(' ', ':', 1) for x in _RESULT_SQL.split(', '))}>")
    def both(texts: pa.Array, following: pa.Array) -> pa.Array:
        pairs = zip(texts.to_pylist(), following.to_pylist())
        rows = [compared(a, sketches(kmers(a)), b, sketches(kmers(b))) for a, b in pairs]
        return pa.array([dict(zip(_NAMES, r)) for r in rows], pa.struct(_RESULT))

    ends = lasts.select("doc_id", both("text", "following").alias("r")).select("doc_id", *[f"r.{n}" for n in _NAMES])
    return found.where("place IS NULL").select("doc_id", *_NAMES).unionByName(ends)
