import numpy as np
import pytest

from granary.llm import mining
from granary.llm.mining import Best, MultiIndex, search, train_codes

SCHEMA = "vec_id long, embedding array<float>, label int"
NAMES = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, positives=5, negatives=10):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(256 * float(np.float32(x)))) for x in v]
        kept[i] = min(kept.get(i, (label, whole)), (label, whole))
    score = lambda a, b: min(max(sum(x * y for x, y in zip(a, b)), mining.LEAST), mining.MOST)
    out = []
    for a in (i for i in kept if i % 10 == 0):
        scored = sorted((-score(kept[a][1], v), i, label) for i, (label, v) in kept.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == kept[a][0]][:positives]:
            fit = [x for x in scored if x[2] != kept[a][0] and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
            out += [(a, p, k, n, -s, -t) for k, (t, n, _) in enumerate(fit, 1)]
    return sorted(out)


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as id", "1 as rank", "2 as v", "3 as block").repartition(3)
    return sorted(tuple(r[c] for c in NAMES) for r in mining.hard_negatives(df, mining.F.col("vec_id") % 10 == 0).collect())


def drawn(seed, n, spread):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 1, (4, 12))
    return [(i, (centres[i % 4] + spread * draw.normal(0, 1, 12)).tolist(), int(draw.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("block,spread", [(16_384, 0.5), (50, 2.0), (40, 0.05)])
def test_against_brute_force(spark, monkeypatch, block, spread):
    monkeypatch.setattr(mining, "BLOCK", block)
    monkeypatch.setattr(mining, "ANCHORS", 7)
    rows = drawn(5, 240, spread)
    rows += [(1000 + k, rows[3][1], k % 2) for k in range(30)]  # ties
    rows += [(2000, None, 1), (2001, rows[0][1], None), (None, rows[0][1], 1), (2010, [1.0, None], 1), (2020, [float("nan")], 0), (2030, [float("inf")], 0)]
    rows += [(7, [9.0] * 12, 0), (2040, [1.0, 2.0], 1), (2050, [], 2), (2**60, rows[8][1], 0), (2**60 + 1, rows[8][1], 1)]
    assert got(spark, rows) == brute(rows)


def test_large_components_are_exact(spark):
    rows = drawn(6, 60, 1.0) + [(500, [3e30, 1.0], 0), (510, [2.0**40, 3.0], 1), (511, [2.0**30, 1.0], 1), (512, [2.0**29, 1.0], 0), (513, [1e38] * 12, 1)]
    assert got(spark, rows) == brute(rows)


def test_cells_come_by_falling_bounds_that_hold():
    draw = np.random.default_rng(0)
    rows = np.floor(draw.normal(0, 200, (400, 10)))
    codes = (train_codes(rows[:, :5]), train_codes(rows[:, 5:]))
    index = MultiIndex(np.arange(400), np.zeros(400, np.int64), rows, codes)
    anchor = np.floor(draw.normal(0, 200, 10))
    cells, seen = list(index.cells(anchor)), 0
    assert [c[0] for c in cells] == sorted((c[0] for c in cells), reverse=True)
    for upper, lower, a, b in cells:
        scores = index.vectors[a:b] @ anchor
        assert (scores <= upper).all() and (scores >= lower).all()
        seen += b - a
    assert seen == 400
    best, far = Best(3), [Best(4, -2000, 9000), Best(2, 10**9, 10**10)]
    search(index, anchor, [best, *far], lambda ids, labels: ids % 2 == 1)
    want = sorted((-int(s), int(i)) for s, i in zip(index.vectors @ anchor, index.ids) if i % 2)
    assert list(zip((-best.scores).tolist(), best.ids.tolist())) == want[:3]
    assert list(zip((-far[0].scores).tolist(), far[0].ids.tolist())) == [x for x in want if -2000 <= -x[0] <= 9000][:4] and not len(far[1].ids)


def test_search_leaves_cells_alone(monkeypatch):
    """With tight clusters most rows are never scored."""
    draw = np.random.default_rng(1)
    centres = draw.normal(0, 1000, (30, 16))
    rows = np.floor(centres[draw.integers(0, 30, 6000)] + draw.normal(0, 5, (6000, 16)))
    index = MultiIndex(np.arange(6000), np.zeros(6000, np.int64), rows, (train_codes(rows[:2000, :8]), train_codes(rows[:2000, 8:])))
    scored, plain = [], mining.exact_scores
    monkeypatch.setattr(mining, "exact_scores", lambda v, a: scored.append(len(v)) or plain(v, a))
    best = Best(5)
    search(index, rows[0], [best], lambda ids, labels: ids != 0)
    assert sum(scored) < 1500 and best.scores.tolist() == sorted((rows[1:] @ rows[0]).astype(int).tolist(), reverse=True)[:5]


def test_odd_tables(spark):
    assert got(spark, [(10, [1.0], 0)]) == []
    assert mining.hard_negatives(spark.createDataFrame([], SCHEMA), mining.F.col("vec_id") % 10 == 0).count() == 0
