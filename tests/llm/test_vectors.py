import math

import numpy as np
from pyspark.sql import functions as F

from granary.llm import vectors


def brute(rows, k):
    kept = {}
    for i, v in sorted(rows, key=lambda r: (r[0], [math.floor(256 * x) for x in r[1]])):
        kept.setdefault(i, [math.floor(256 * x) for x in v])
    out = set()
    for q, v in kept.items():
        if q % 5 == 0:
            score = lambda w: min(max(sum(a * b for a, b in zip(v, w)), -(2**63)), 2**63 - 1)
            scores = sorted((-score(w), i) for i, w in kept.items() if i != q)[:k]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)}
    return out


def run(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "'x' as rank", "1 as q", "2 as block", "3 as id")
    return {tuple(r) for r in vectors.top_k(df, F.col("vec_id") % 5 == 0, k).collect()}


def test_matches_brute_force_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 40)
    monkeypatch.setattr(vectors, "QUERIES", 7)
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.3, 9)]) for i in range(150)]
    rows += [(1000 + i, [0.5] * 9) for i in range(12)]  # ties
    assert run(spark, rows) == brute(rows, 5)


def test_proof_comes_before_the_last_level():
    rng = np.random.default_rng(0)
    data = np.zeros((300, 8), np.int64)
    data[:, 0] = 1 << np.arange(300) % 16
    data[:, 1:] = rng.integers(-3, 4, (300, 7))
    index = vectors.ImpactIndex(np.arange(300), data)
    seen = []
    index.levels = [(seen.append(k) or s, left) for k, (s, left) in enumerate(index.levels)]
    (j, ids, scores), = index.top(np.array([-1]), data[15:16], 3)
    exact = data @ data[15]
    assert scores.tolist() == sorted(exact.tolist())[-3:][::-1]


def test_large_components_are_exact(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 20)
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 2, 5)]) for i in range(60)]
    rows += [(100, [float(np.float32(3e30)), 1.0]), (101, [2.0**40, 3.0]), (105, [2.0**24, 1.0]), (106, [2.0**24, 1.25]), (110, [-float(np.float32(1e38))] * 5)]
    assert run(spark, rows) == brute(rows, 5)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (5, [nan, 1.0]), (10, None), (15, [inf, 0.0]), (1, [1.0, None]), (2, [0.5]), (3, []), (4, [0.0, 9.0]), (0, [1.0, 0.0]),
            (20, [-1.0, 0.25]), (7, [0.5, 0.0])]
    got = run(spark, rows)
    clean = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    assert got == brute(clean, 5)
    assert run(spark, [(0, [1.0])]) == set() and run(spark, [(1, None)]) == set()
