"""Exact top-k by inner product over an impact-ordered index, score at a time.

Components become integers floor(256 x). The index is cut into blocks of vectors. In a block
every posting (dimension, vector, impact) lies in a segment of its quantised impact, the bit
length of its size; segments are processed from the highest impact down, for a block of
queries together. Behind each level a vector's rest is bounded by the product of the query's
length and the length of what the vector has left (Cauchy-Schwarz), so that each partial score
is known from both sides. Processing stops when the vectors that may still be among the k best
are few, which is then proven for all others, and these are scored exactly. Without such a
proof it goes on through the last level.

Index blocks and query blocks meet by block number: the query blocks are copied to each
number, which is the stated query set against all rows, in blocks. A task builds the segments of an
index block once and streams the query blocks by; it hands on at most k rows for a query.

Results: null vectors and those with null or non-finite components take no part; vec_id is a
key, of rows that repeat one the smallest vector counts; a shorter vector counts as padded
with zeros; ties go to the smaller vec_id; components whose products a double may not hold
are scored in exact integers, and a score beyond 64 bits counts as the nearest number of 64 bits;
no vectors, or no other vectors, give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.session import durable

SCALE = 256
BLOCK = 4096
QUERIES = 512
#: Vectors of a block that may be left over, as a multiple of k, for a query to be rescored.
FEW = 8
#: Products of such components, summed over any real number of dimensions, are exact in a double.
SMALL = 1 << 20
LEAST, MOST = -(1 << 63), (1 << 63) - 1
PACKED = "block long, ids binary, dims int, vectors binary"


def valid(vector: str) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False))


def _pack(block: int, rows: pd.DataFrame) -> pd.DataFrame:
    ids = rows["id"].to_numpy(np.int64)
    dims = max(map(len, rows["v"]), default=0)
    whole = np.zeros((len(ids), dims))  # whole numbers, which doubles hold whatever their size
    for k, v in enumerate(rows["v"]):
        whole[k, : len(v)] = np.floor(np.asarray(v, np.float64) * SCALE)
    order = np.lexsort((*whole.T[::-1], ids))
    ids, whole = ids[order], whole[order]
    first = np.concatenate([[True], ids[1:] != ids[:-1]]) if len(ids) else np.empty(0, bool)
    return pd.DataFrame(
        {"block": [block], "ids": [ids[first].tobytes()], "dims": [dims], "vectors": [whole[first].tobytes()]}
    )


def packed(vectors: DataFrame, blocks: int) -> DataFrame:
    """Blocks of vectors, by a hash of the id; a block holds about as many as any other."""
    keyed = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    return keyed.groupBy("block").applyInPandas(lambda key, rows: _pack(int(key[0]), rows), PACKED)


def _unpack(ids: bytes, dims: int, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(ids, np.int64)
    return found, np.frombuffer(vectors, np.float64).reshape(len(found), dims)


def exact_scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products, also of components whose products no double holds."""
    width = min(rows.shape[1], len(query))
    rows, query = rows[:, :width], query[:width]
    size = max(np.abs(rows).max(initial=0), np.abs(query).max(initial=0))
    if size <= SMALL and width * size * size < 2**53:
        return (rows @ query).astype(np.int64)
    whole = [int(x) for x in query]
    sums = (sum(int(x) * y for x, y in zip(row, whole)) for row in rows)
    return np.array([min(max(s, LEAST), MOST) for s in sums], np.int64)


class ImpactIndex:
    """Postings of a block in segments by falling bit length of their impact."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.length = np.sqrt((vectors**2).sum(axis=1))
        level = np.zeros(vectors.shape, np.int16)
        size = np.abs(self.vectors)
        some = size > 0
        level[some] = np.frexp(size[some])[1]
        left = np.zeros(len(ids))  # squares of what the lower levels have, summed from below
        self.levels: list[tuple[list[tuple[int, np.ndarray, np.ndarray]], np.ndarray]] = []
        for impact in np.unique(level[some]).tolist():
            segments = []
            for dim in range(vectors.shape[1]):
                rows = np.flatnonzero(level[:, dim] == impact)
                if len(rows):
                    segments.append((dim, rows, self.vectors[rows, dim]))
            self.levels.insert(0, (segments, np.sqrt(left)))
            left = left + np.where(level == impact, self.vectors**2, 0).sum(axis=1)

    def top(self, own: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, ids, scores) of each query's k best, its own id left out."""
        width = min(queries.shape[1], self.vectors.shape[1])
        q = np.ascontiguousarray(queries[:, :width].T)
        reach = np.sqrt((queries**2).sum(axis=1)) * (1 + 1e-9)
        score = np.zeros((len(self.ids), len(own)))
        rounding = 1e-12 * self.length[:, None] * reach[None, :]  # sums of whole numbers below 2**53 are exact, others nearly
        mine = np.searchsorted(self.ids, own)
        hit = np.flatnonzero((mine < len(self.ids)) & (self.ids[np.minimum(mine, len(self.ids) - 1)] == own)) if len(self.ids) else []
        k = min(k, len(self.ids))
        possible = np.ones(score.shape, bool)
        for segments, left in self.levels:
            for dim, rows, impact in segments:
                if dim < width:
                    score[rows] += impact[:, None] * q[dim][None, :]
            rest = left[:, None] * reach[None, :] * (1 + 1e-9) + rounding + 1e-6
            low = score - rest
            low[mine[hit], hit] = -np.inf
            bar = np.partition(low, len(self.ids) - k, axis=0)[len(self.ids) - k] if k else np.zeros(len(own))
            possible = score + rest >= bar[None, :]
            if possible.sum() <= FEW * k * len(own):
                break
        possible[mine[hit], hit] = False
        for j in range(len(own)):
            rows = np.flatnonzero(possible[:, j])
            exact = exact_scores(self.vectors[rows], queries[j])
            best = np.lexsort((self.ids[rows], ~exact))[:k]  # ~x falls as x rises, and never overflows
            yield j, self.ids[rows[best]], exact[best]


def top_k(df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k rows of largest integer inner product for each query row."""
    rows = df.where(F.col(key).isNotNull() & valid(vector)).select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"), is_query.alias("q"))
    counts = rows.agg(F.count("*").alias("n"), F.count_if("q").alias("m")).first()
    blocks, parts = max(1, -(-counts["n"] // BLOCK)), max(1, -(-counts["m"] // QUERIES))
    index = durable(packed(rows.select("id", "v"), blocks))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    queries = packed(rows.where("q").select("id", "v"), parts).withColumn("block", every)
    both = index.withColumn("kind", F.lit(0)).unionByName(queries.withColumn("kind", F.lit(1)))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, found = None, None
        for batch in batches:
            for x in batch.itertuples():
                if x.kind == 0:
                    now, found = x.block, ImpactIndex(*_unpack(x.ids, x.dims, x.vectors))
                    continue
                if x.block != now:  # a block without rows
                    continue
                own, wanted = _unpack(x.ids, x.dims, x.vectors)
                parts = [(own[j], ids, scores) for j, ids, scores in found.top(own, wanted, k)]
                yield pd.DataFrame(
                    {
                        "query_id": np.repeat([p[0] for p in parts], [len(p[1]) for p in parts]),
                        "vec_id": np.concatenate([p[1] for p in parts]),
                        "score": np.concatenate([p[2] for p in parts]),
                    }
                )

    dealt = both.repartition(blocks, "block").sortWithinPartitions("block", "kind")
    near = dealt.mapInPandas(search, "query_id long, vec_id long, score long")
    # the limit on the rank reaches below the shuffle: a task hands on k rows for a query at most
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
