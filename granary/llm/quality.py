"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text becomes hashed counts of its words and word pairs, of its byte pairs and of triples of
character kinds, and counts of words that repeat close by, with term weights, reduced by a
truncated singular value decomposition to a latent-semantic vector of unit length. Decomposition, weights and the labelled vectors come
from a bounded sample of labelled rows (SAMPLE rows by a hash of the doc_id) and are
broadcast; every document is then scored where it lies, by exact cosine products with all
labelled vectors in blocks, and the labels of its nearest neighbours vote with weights that
grow with the similarity.

Labels, language, source and doc_id are no inputs of a score. Results: a null, empty or
otherwise featureless text, and any text when nothing is labelled, gets the prior (share of
good labels, 0.5 without labels); equal texts get equal scores; labels other than 0 and 1 and
null ones are left out; of rows that repeat a labelled doc_id each one counts, up to twice the
sample in all, in the order of the sample and then of the texts' hashes; a null doc_id is not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import compress, crc32, decompress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.common import as_bytes, concat, slices

SAMPLE = 2000
DIMENSIONS = 48
NEIGHBOURS = 25
SHARPNESS = 8
BLOCK = 128
ITERATIONS = 8
#: Cells of byte pairs, of triples of kinds (the last of them of repeats), and of words and word pairs.
PAIRS, TRIPLES, TERMS = 2048, 2048, 2048
FEATURES = PAIRS + TRIPLES + TERMS
#: Repeats at these distances count if they are so large a share of the words, in so many features.
LAGS, OFTEN, WEIGHT = (1, 2, 3), 0.1, 64
_HASH = np.uint32(2654435761)


def _classes() -> np.ndarray:
    """Bytes as they are, but digits as one, and bytes beyond ASCII as one."""
    out = np.arange(256, dtype=np.uint32)
    for b in range(256):
        c = chr(b)
        if b >= 128:
            out[b] = 1
        elif c.isdigit():
            out[b] = ord("0")
    return out


_CLASS = _classes()


def counts(text: bytes) -> np.ndarray:
    """Hashed counts of the text's byte pairs, triples of kinds, words and word pairs, and counts of repeats."""
    raw = np.frombuffer(text, np.uint8)
    out = np.zeros(FEATURES, np.float32)
    if len(raw) == 0:
        return out
    kind = _CLASS[raw]
    pair = (kind[:-1] << np.uint32(8)) | kind[1:]
    out[:PAIRS] = np.bincount(((pair * _HASH) >> np.uint32(21)).astype(np.int64), minlength=PAIRS)
    shape = np.where((kind >= 97) & (kind <= 122), 1, np.where((kind >= 65) & (kind <= 90), 2, np.where(kind == 1, 3, kind)))
    triple = (shape[:-2] << np.int64(14)) ^ (shape[1:-1] << np.int64(7)) ^ shape[2:]
    mixed = ((triple.astype(np.uint32) + np.uint32(1 << 25)) * _HASH) >> np.uint32(21)
    out[PAIRS : PAIRS + TRIPLES] = np.bincount(mixed.astype(np.int64), minlength=TRIPLES)
    words = text.split()
    for lag in LAGS:  # words that stand again ``lag`` words on
        again = sum(map(eq, words, words[lag:]))
        end = PAIRS + TRIPLES - WEIGHT * (lag - 1)
        out[end - WEIGHT : end] = again if again > OFTEN * len(words) else 0
    one = np.fromiter(map(crc32, text.lower().split()), np.uint32, len(words))
    two = (one[:-1] * np.uint32(31)) ^ one[1:]
    out[PAIRS + TRIPLES :] = np.bincount((np.concatenate([one, two]) * _HASH) >> np.uint32(21), minlength=TERMS)
    return out


@dataclass
class Model:
    weight: np.ndarray
    axes: np.ndarray  # features x dimensions
    vectors: np.ndarray  # labelled rows x dimensions
    labels: np.ndarray
    prior: float

    def project(self, found: np.ndarray) -> np.ndarray:
        return _unit(_unit(np.log1p(found) * self.weight) @ self.axes)

    def score(self, found: np.ndarray) -> np.ndarray:
        """Probability-like scores of rows of counts."""
        out = np.full(len(found), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        if k == 0:
            return out
        vectors = self.project(found)
        for i in range(0, len(found), BLOCK):
            cosine = vectors[i : i + BLOCK] @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            value = np.take_along_axis(cosine, near, axis=1).astype(np.float64)
            vote = np.maximum(value, 0) ** SHARPNESS
            total = vote.sum(axis=1)
            some = total > 1e-12
            share = (vote * self.labels[near]).sum(axis=1)
            out[i : i + BLOCK][some] = share[some] / total[some]
        return np.clip(out, 0.0, 1.0)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def fit(found: np.ndarray, labels: np.ndarray, rows: np.ndarray | None = None) -> Model:
    """Weights by inverse document frequency, axes by the decomposition, and the labelled vectors.

    The weighted rows go to ``rows``, which may be ``found`` itself where the counts are needed no more.
    """
    n = len(found)
    if n == 0:
        return Model(np.ones(FEATURES, np.float32), np.zeros((FEATURES, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    blocks = [slice(i, i + BLOCK) for i in range(0, n, BLOCK)]  # what is worked out beside the rows is of a block at a time
    seen = sum((found[b] > 0).sum(axis=0) for b in blocks)
    weight = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)
    rows = np.empty_like(found) if rows is None else rows
    for b in blocks:
        rows[b] = np.log1p(found[b]) * weight
        rows[b] /= np.maximum(np.linalg.norm(rows[b], axis=1, keepdims=True), 1e-12)
    axes = np.random.default_rng(0).standard_normal((FEATURES, min(DIMENSIONS, n))).astype(np.float32)
    for _ in range(ITERATIONS):  # subspace iteration for the leading right singular vectors
        axes = np.linalg.qr(rows.T @ (rows @ axes))[0]
    return Model(weight, axes, _unit(rows @ axes).astype(np.float32), labels.astype(np.float64), float(labels.mean()))


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, text: str = "text") -> Model:
    """The model of at most SAMPLE labelled rows that are not held out."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    some = known.select("doc_id", "quality", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id", "quality").limit(SAMPLE)
    rows = documents.select("doc_id", text).join(F.broadcast(some), "doc_id")  # SAMPLE rows at most

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([compress(counts(t).tobytes(), 1) for t in as_bytes(batch)], pa.binary())

    order = ("h", "doc_id", "quality", "t")
    kept = rows.select(*order[:3], F.xxhash64(text).alias("t"), text).orderBy(*order).limit(2 * SAMPLE)
    got = kept.select(*order, packed(F.col(text)).alias("counts")).collect()
    got.sort(key=lambda r: tuple(r[c] for c in order))
    known_labels = np.array([r.quality for r in got])
    found = np.empty((len(got), FEATURES), np.float32)
    for i, r in enumerate(got):
        found[i] = np.frombuffer(decompress(r["counts"]), np.float32)
    return fit(found, known_labels, found)


def score_column(df: DataFrame, model: Model, text: str = "text") -> Column:
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield concat((pa.array(_scores(shared.value, as_bytes(part)), pa.float64()) for part in slices(batch)), pa.float64())

    return scores(F.col(text))


def _scores(model: Model, texts: list[bytes]) -> np.ndarray:
    parts = [
        model.score(np.stack([counts(t) for t in texts[i : i + BLOCK]])) for i in range(0, len(texts), BLOCK)
    ]
    return np.concatenate(parts)


def classify(documents: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = train(documents, labels, text)
    scored = documents.select("doc_id", held_out().alias("held_out"), score_column(documents, model, text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(documents: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` without those that the model rejects."""
    model = train(documents, labels, text)
    return documents.where(score_column(documents, model, text) >= 0.5)
