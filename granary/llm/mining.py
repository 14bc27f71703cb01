"""Hard negatives over an inverted multi-index, with windows that are certified.

The halves of the vectors have a codebook each (CODES centres, trained on a bounded sample of
rows, the smallest hashes). In a block of the index a cell is a pair of codes; rows lie sorted
by cell, and each code has the radius of its members in the block. For an anchor, the half
scores of a code are known up to anchor length times radius, so a cell's scores lie between two
sums of half bounds. A heap over both sorted code lists visits cells by falling upper bound.

First every anchor takes its best rows of the same label, its positives, until no cell left can
reach the last of them. Then it takes, for the window of scores that each positive opens, the
best rows of other labels; cells all below or above the open windows are not scored, and a
window is closed when its list is full and no cell left reaches its last score, or none reaches
the window. Each closing is a proof, so the result is exact; the sample only sets the speed.

Rows are dealt out to blocks by a hash of their id, and anchors, in blocks as well, are copied to
every block: a stated query set against all rows. A task builds the index of a block once and
streams the anchors by; it hands on a list of each anchor or window, and no more.

Results: rows without id, label or vector and those with null or non-finite components take
no part; of rows that repeat an id, the one of smallest label and then vector counts; a shorter
vector counts as padded with zeros; components beyond 2**20 are scored in exact integers, and
a score beyond 64 bits counts as the nearest number of 64 bits; ties go to the smaller id; an
anchor without positives, or a window without rows, gives none.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.vectors import LEAST, MOST, exact_scores, valid
from granary.session import durable

SCALE = 256
#: Rows of an index block and of an anchor block, about; codes of a half; rows that codebooks are trained on.
BLOCK, ANCHORS, CODES, SAMPLE = 16_384, 256, 24, 2048
ROUNDS = 6
#: Rows of cells that are scored together, about.
TOGETHER = 512


def train_codes(rows: np.ndarray) -> np.ndarray:
    """Centres of the rows by a few rounds of k-means from spread starting rows."""
    if not len(rows):
        return np.zeros((1, rows.shape[1]))
    centres = rows[np.linspace(0, len(rows) - 1, min(CODES, len(rows))).astype(int)].copy()
    for _ in range(ROUNDS):
        near = nearest(rows, centres)
        for k in range(len(centres)):
            if (near == k).any():
                centres[k] = rows[near == k].mean(axis=0)
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1)[None, :] - 2 * rows @ centres.T).argmin(axis=1)


def padded(rows: np.ndarray, width: int) -> np.ndarray:
    return np.pad(rows, ((0, 0), (0, max(0, width - rows.shape[1]))))


class MultiIndex:
    """The cells of one block."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, codes: tuple[np.ndarray, np.ndarray]):
        width = max(vectors.shape[1], sum(c.shape[1] for c in codes))
        vectors = padded(vectors, width)
        self.cut = codes[0].shape[1]
        halves = (vectors[:, : self.cut], vectors[:, self.cut :])
        self.codes = (codes[0], padded(codes[1], width - self.cut))
        own = [nearest(h, c) for h, c in zip(halves, self.codes)]
        self.radius = []
        for half, code, at in zip(halves, self.codes, own):
            far = np.zeros(len(code))
            np.maximum.at(far, at, np.sqrt(((half - code[at]) ** 2).sum(axis=1)))
            self.radius.append(far)
        cell = own[0] * len(self.codes[1]) + own[1]
        order = np.argsort(cell, kind="stable")
        self.ids, self.labels, self.vectors = ids[order], labels[order], vectors[order]
        cells = len(self.codes[0]) * len(self.codes[1])
        self.start = np.searchsorted(cell[order], np.arange(cells + 1))

    def bounds(self, anchor: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Lower and upper bounds of the half scores of every code, widened by what rounding may take."""
        out = []
        width = self.cut + self.codes[1].shape[1]
        whole = np.pad(anchor, (0, max(0, width - len(anchor))))
        for part, code, far in zip((whole[: self.cut], whole[self.cut : width]), self.codes, self.radius):
            length = np.sqrt((part**2).sum())
            middle, reach = code @ part, length * far
            slack = 1e-9 * (length * (np.sqrt((code**2).sum(axis=1)) + far)) + 1e-6
            out.append((middle - reach - slack, middle + reach + slack))
        return out

    def cells(self, anchor: np.ndarray) -> Iterator[tuple[float, float, int, int]]:
        """(upper bound, lower bound, first row, row behind the last) of filled cells, by falling upper bound."""
        (low1, high1), (low2, high2) = self.bounds(anchor)
        one, two = np.argsort(-high1, kind="stable"), np.argsort(-high2, kind="stable")
        up1, up2, down1, down2 = (x.tolist() for x in (high1[one], high2[two], low1[one], low2[two]))
        first = (one[:, None] * len(two) + two[None, :]).tolist()
        start = self.start.tolist()
        heap = [(-(up1[0] + up2[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            cell = first[i][j]
            if start[cell] < start[cell + 1]:
                yield -bound, down1[i] + down2[j], start[cell], start[cell + 1]
            if j + 1 < len(up2):
                heapq.heappush(heap, (-(up1[i] + up2[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(up1):
                heapq.heappush(heap, (-(up1[i + 1] + up2[0]), i + 1, 0))


@dataclass
class Best:
    """The best ``k`` scores between ``low`` and ``high``, ties to the smaller id."""

    k: int
    low: int = LEAST
    high: int = MOST
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    scores: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fit = (scores >= self.low) & (scores <= self.high)
        if len(self.ids) == self.k:
            fit &= scores >= self.scores[-1]
        if fit.any():
            ids, scores = np.concatenate([self.ids, ids[fit]]), np.concatenate([self.scores, scores[fit]])
            order = np.lexsort((ids, ~scores))[: self.k]
            self.ids, self.scores = ids[order], scores[order]

    def closed(self, bound: float) -> bool:
        """Whether no row of a score up to ``bound`` can enter."""
        return bound < self.low or (len(self.ids) == self.k and bound < self.scores[-1])


def search(index: MultiIndex, anchor: np.ndarray, lists: list[Best], wanted) -> None:
    """Fill the lists from the rows that ``wanted`` takes, given their ids and labels."""
    waiting: list[np.ndarray] = []
    held = 0

    def score() -> None:
        nonlocal held
        rows = np.concatenate(waiting)
        waiting.clear()
        held = 0
        rows = rows[wanted(index.ids[rows], index.labels[rows])]
        if len(rows):
            found = exact_scores(index.vectors[rows], anchor)
            for one in lists:
                one.add(index.ids[rows], found)

    for upper, lower, a, b in index.cells(anchor):
        upper = min(max(upper, float(LEAST)), float(MOST))
        if any(x.closed(upper) for x in lists):
            if waiting:  # rows of earlier cells first
                score()
            lists = [x for x in lists if not x.closed(upper)]
        if not lists:
            break
        most = max(x.high for x in lists)
        if most < MOST and lower > most:
            continue
        waiting.append(np.arange(a, b))
        held += b - a
        if held >= TOGETHER:
            score()
    if waiting:
        score()


PACKED = "block long, ids binary, labels binary, dims int, vectors binary, windows binary"


def _pack(block: int, rows: pd.DataFrame, positives: int) -> pd.DataFrame:
    """A block as arrays: of every id the smallest (label, vector), and with it its windows."""
    dims = max(map(len, rows["v"]), default=0)
    vectors = np.zeros((len(rows), dims))
    for k, v in enumerate(rows["v"]):
        vectors[k, : len(v)] = np.floor(np.asarray(v, np.float64) * SCALE)
    ids, labels = rows["id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
    order = np.lexsort((*vectors.T[::-1], labels, ids))
    order = order[np.concatenate([[True], ids[order][1:] != ids[order][:-1]])]
    windows = b""
    if "positives" in rows:
        table = np.zeros((len(rows), positives, 3), np.int64)  # known, id, score
        for k, found in enumerate(rows["positives"]):
            for r, x in enumerate(found if found is not None else ()):
                table[k, r] = 1, x["id"], x["score"]
        windows = table[order].tobytes()
    packed = (ids[order].tobytes(), labels[order].tobytes(), dims, vectors[order].tobytes(), windows)
    return pd.DataFrame([(block, *packed)], columns=[x.split()[0] for x in PACKED.split(", ")])


def packed(rows: DataFrame, blocks: int, positives: int = 0) -> DataFrame:
    keyed = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    return keyed.groupBy("block").applyInPandas(lambda key, rows: _pack(int(key[0]), rows, positives), PACKED)


def _arrays(x) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids = np.frombuffer(x.ids, np.int64)
    return ids, np.frombuffer(x.labels, np.int64), np.frombuffer(x.vectors, np.float64).reshape(len(ids), x.dims)


def _meet(index: DataFrame, queries: DataFrame, blocks: int, codes, found, schema: str) -> DataFrame:
    """``found(index, anchor id, label, vector, windows)`` for every anchor in every block; the index of a block is built once."""
    copied = queries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    both = index.withColumn("kind", F.lit(0)).unionByName(copied.withColumn("kind", F.lit(1)))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, made = None, None
        for batch in batches:
            for x in batch.itertuples():
                if x.kind == 0:
                    now, made = x.block, MultiIndex(*_arrays(x), codes.value)
                elif x.block == now:
                    out = []
                    ids, labels, vectors = _arrays(x)
                    windows = np.frombuffer(x.windows, np.int64).reshape(len(ids), -1, 3) if x.windows else [()] * len(ids)
                    for one in zip(ids.tolist(), labels.tolist(), vectors, windows):
                        out += found(made, *one)
                    yield pd.DataFrame(out, columns=[c.split()[0] for c in schema.split(", ")])

    dealt = both.repartition(blocks, "block").sortWithinPartitions("block", "kind")
    return dealt.mapInPandas(rows, schema)


def _ranked(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The limit on the rank reaches below the shuffle, so a task hands on few rows for a key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= most)


def hard_negatives(
    df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
    key: str = "vec_id", vector: str = "embedding", label: str = "label",
) -> DataFrame:
    """For each anchor and each of its ``positives`` best rows of the same label, the ``negatives``
    best rows of other labels that score ``low`` to ``high`` hundredths of the positive's score."""
    usable = df.where(F.col(key).isNotNull() & F.col(label).isNotNull() & valid(vector))
    rows = usable.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"), is_anchor.alias("anchor")
    )
    rows = durable(rows)
    counts = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("m")).first()
    blocks, parts = max(1, -(-counts["n"] // BLOCK)), max(1, -(-counts["m"] // ANCHORS))
    spark = df.sparkSession
    some = [r.v for r in rows.select(F.xxhash64("id", "v").alias("h"), "v").orderBy("h", "v").limit(SAMPLE).select("v").collect()]
    width = max(map(len, some), default=0)
    sample = np.zeros((len(some), width))
    for k, v in enumerate(some):
        sample[k, : len(v)] = np.floor(np.asarray(v) * SCALE)
    codes = spark.sparkContext.broadcast((train_codes(sample[:, : width // 2]), train_codes(sample[:, width // 2 :])))  # CODES centres of each half
    index = durable(packed(rows.select("id", "label", "v"), blocks))
    anchors = rows.where("anchor").select("id", "label", "v")

    def same(made: MultiIndex, own: int, said: int, v: np.ndarray, _) -> list[tuple]:
        best = Best(positives)
        search(made, v, [best], lambda ids, labels: (labels == said) & (ids != own))
        return [(own, x, s) for x, s in zip(best.ids.tolist(), best.scores.tolist())]

    near = _meet(index, packed(anchors, parts), blocks, codes, same, "anchor_id long, id long, score long")
    chosen = _ranked(near, ["anchor_id"], positives)
    windows = durable(chosen.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives")))

    def other(made: MultiIndex, own: int, said: int, v: np.ndarray, opened) -> list[tuple]:
        lists = []
        for known, positive, score in (x.tolist() for x in opened):
            if known:
                lists.append((positive, score, Best(negatives, -(-low * score // 100), high * score // 100)))
        search(made, v, [x[2] for x in lists if x[2].low <= x[2].high], lambda ids, labels: labels != said)
        return [(own, p, s, x, y) for p, s, best in lists for x, y in zip(best.ids.tolist(), best.scores.tolist())]

    asked = packed(anchors.join(windows, "id"), parts, positives)
    far = _meet(index, asked, blocks, codes, other, "anchor_id long, positive_id long, positive_score long, id long, score long")
    return _ranked(far, ["anchor_id", "positive_id"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
