"""Functions of the user's own, sparse decomposition, topics, and the indexes behind retrieval and fuzzy joins."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from granary.functions.distance import edit_distances
from granary.operators import custom, decompose, fuzzy, splits, stages, tablefunctions, topics
from granary.operators import text as textops


def test_states_merge_map_side_first(spark, monkeypatch):
    merged = custom.Aggregator(
        zero=lambda: (0, 0), update=lambda s, r: (s[0] + len(r["v"]), s[1] + int(r["v"].sum())), merge=lambda a, b: (a[0] + b[0], a[1] + b[1]),
        finish=lambda s: {"n": s[0], "total": s[1]}, returns="n BIGINT, total BIGINT",
    )
    big = 2**60 + 1
    rows = [("hot", 1)] * 900 + [("b", big), ("b", None), ("none", None), (None, 5)] + [(f"k{i}", i) for i in range(300)]
    df = spark.createDataFrame(rows, "k STRING, v LONG").repartition(5)
    monkeypatch.setattr(custom, "HELD", 50)
    got = {r.k: (r.n, r.total) for r in custom.aggregate(df, ["k"], ["v"], merged).collect()}
    assert got == {"hot": (900, 900), "b": (1, big), "none": (0, 0), **{f"k{i}": (1, i) for i in range(300)}}
    assert custom.aggregate(df, [], ["v"], merged).collect()[0].n == 1202
    assert custom.aggregate(df.limit(0), ["k"], ["v"], merged).count() == 0
    plan = custom.aggregate(df, ["k"], ["v"], merged)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("hashpartitioning(k") < plan.rindex("MapInArrow")  # states are made below the shuffle


def test_quantile_buckets(spark):
    draw = random.Random(1)
    values = [0, 1, 63, 64, 65, 127, 128, 2**40, 2**53, 2**53 - 1, 2**60 + 5, *[draw.randrange(10**6) for _ in range(500)]]
    df = spark.createDataFrame([(v, 1 + v % 3) for v in values], "v LONG, w LONG").repartition(4)
    (row,) = custom.aggregate(df, [], ["v", "w"], custom.weighted_quantiles("v", "w", (1, 50, 100))).collect()
    ordered = sorted(v for v in values for _ in range(1 + v % 3))
    assert row.weight == len(ordered)
    for p, got in ((1, row.p1), (50, row.p50), (100, row.p100)):
        want = ordered[max(0, -(-p * len(ordered) // 100) - 1)]
        assert abs(got - want) <= want / 2**5


def test_loaded_stages_give_equal_rows(spark, tmp_path):
    df = spark.createDataFrame([(i, "alpha beta " + "gamma " * (i % 3) + f"word{i % 4}x") for i in range(40)], "id LONG, text STRING").withColumn("other", F.lit(1))
    pipeline = Pipeline(stages=[stages.ColumnSelector(columns=["id", "text"]), stages.TermCounter(), stages.TermWeigher(minDf=2, maxDf=0.9)])
    model = pipeline.fit(df.filter("id < 20"))
    model.write().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    want, got = (sorted(map(tuple, m.transform(df.filter("id >= 20")).collect())) for m in (model, loaded))
    assert want == got and want and loaded.stages[2].getOrDefault("minDf") == 2 and loaded.stages[2].uid == model.stages[2].uid
    assert not {t for _, t, _, _ in got} & {"alpha", "beta"}


def test_rows_of_a_key_stream_by(spark):
    draw = random.Random(2)
    rows = [(i, draw.choice("aab"), draw.randrange(5000)) for i in range(400)] + [(900, None, 5), (901, "a", None), (2**60 + 1, "b", 7), (2**60 + 2, "b", 7)]
    df = spark.createDataFrame(rows, "id LONG, k STRING, s INT").select("id", "k", F.timestamp_seconds("s").alias("ts")).repartition(3)
    known = [r for r in rows if r[2] is not None]
    want = sorted((str(a[1]), a[0], b[0], (b[2] - a[2]) * 10**6) for a in known for b in known if a[1] == b[1] and (a[2], a[0]) < (b[2], b[0]) and b[2] <= a[2] + 60)
    for size in ("7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            got = tablefunctions.follow_ups(df, "k", "ts", "id", 60).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert sorted((str(r.k), r.id, r.next_id, r.microseconds) for r in got) == want
    said = spark.createDataFrame([(1, " a  bb\tc"), (2, None), (3, "one")], "id LONG, t STRING")
    assert [tuple(r) for r in tablefunctions.overlapping_pairs(said, "id", "t").orderBy("position").collect()] == [(1, 1, "a", "bb"), (1, 2, "bb", "c")]


def _cells(spark, matrix):
    rows = [(int(i), f"t{j}", float(matrix[i, j])) for i, j in zip(*np.nonzero(matrix))]
    return spark.createDataFrame(rows, "id LONG, term STRING, weight DOUBLE").repartition(4)


def test_svd_of_sparse_rows(spark):
    draw = np.random.default_rng(3)
    left, right = np.linalg.qr(draw.normal(size=(60, 12)))[0], np.linalg.qr(draw.normal(size=(25, 12)))[0]
    matrix = left @ np.diag(2.0 ** -np.arange(12) * 10) @ right.T
    scores, axes, values = decompose.truncated_svd(_cells(spark, matrix), "id", 4)
    u, s, v = np.linalg.svd(matrix)
    assert np.allclose(values, s[:4], atol=1e-9)
    found = {r.term: np.array(r.v) for r in axes.collect()}
    got = np.stack([found[f"t{j}"] for j in range(25)])
    assert np.linalg.norm(got @ got.T - v[:4].T @ v[:4]) < 1e-6  # the same subspace
    assert all(got[np.abs(got[:, i]).argmax(), i] > 0 for i in range(4))
    placed = {r.id: np.array(r.v) for r in scores.collect()}
    assert np.allclose(np.stack([placed[i] for i in range(60)]), matrix @ got, atol=1e-6)
    small = np.outer([1.0, 2.0, 0.5], [1.0, -3.0])  # of rank one
    scores, axes, values = decompose.truncated_svd(_cells(spark, small), "id", 4)
    assert len(values) == 1 and np.isclose(values[0], np.linalg.norm(small)) and scores.count() == 3
    assert decompose.truncated_svd(_cells(spark, np.zeros((2, 2))), "id", 4)[2] == []


def test_special_functions():
    x = np.array([0.01, 0.05, 0.5, 1.0, 2.5, 10.0, 1e4])
    from math import lgamma

    assert np.allclose(topics.log_gamma(x), [lgamma(v) for v in x], rtol=1e-9, atol=1e-9)
    step = 1e-5
    assert np.allclose(topics.digamma(x[2:]), [(lgamma(v + step) - lgamma(v - step)) / (2 * step) for v in x[2:]], atol=1e-5)


def test_topics_rise_and_part_the_words(spark, monkeypatch):
    draw, rows = random.Random(5), []
    for d in range(120):
        side = d % 2
        words = Counter(draw.choice(["cat", "dog", "cow", "hen"] if side == 0 else ["red", "blue", "green", "black"]) for _ in range(30))
        words["and"] = 3
        rows += [(2**60 + d, w, n) for w, n in words.items()]
    df = spark.createDataFrame(rows + [(None, "cat", 1)], "id LONG, term STRING, tf LONG").repartition(4)
    monkeypatch.setattr(topics, "TOGETHER", 100)
    made = topics.fit(df, "id", 2, passes=8, seed=1)
    assert len(made.bounds) == 8 and all(b >= a - 1e-6 * abs(a) for a, b in zip(made.bounds, made.bounds[1:])) and made.bounds[-1] > made.bounds[0]
    tops = {}
    for r in made.top_terms(4).collect():
        tops.setdefault(r.topic, set()).add(r.term)
    assert sorted(map(sorted, tops.values())) == [["black", "blue", "green", "red"], ["cat", "cow", "dog", "hen"]]
    own = {r.id: r.topic for r in made.dominant("id").collect()}
    assert len(own) == 120 and len({own[2**60 + d] for d in range(0, 120, 2)}) == 1 and own[2**60] != own[2**60 + 1]
    assert topics.fit(df.limit(0), "id", 2, 3, 1).top_terms(3).count() == 0


def test_blocks_are_skipped(spark):
    draw = random.Random(7)
    common = [f"c{i}" for i in range(40)]
    docs = [(i, [draw.choice(common) for _ in range(30)] + ([f"rare{i % 50}"] * 3 if i % 4 == 0 else [])) for i in range(3000)]
    d = spark.createDataFrame(docs, "id LONG, w ARRAY<STRING>")
    q = spark.createDataFrame([(k, [f"rare{2 * k}", *common[:6]]) for k in range(20)], "qid LONG, w ARRAY<STRING>")
    index = textops.BlockMaxIndex(d, "id", F.col("w"), q, "qid", F.col("w"), 1.2, 0.75)
    scored = index.scored(10)
    every = index._of(index.postings.select("_block").distinct().join(q.select("qid")))
    assert scored.count() < every.count() / 3

    def best(rows):
        found = {}
        for r in rows.collect():
            found.setdefault(r.qid, []).append((-round(r.score, 9), r.id))
        return {k: sorted(v)[:10] for k, v in found.items()}

    assert best(scored) == best(every)


@pytest.mark.parametrize("k", [1, 2, 3])
def test_segments_find_every_close_pair(spark, k):
    draw = random.Random(k)
    base = ["".join(draw.choice("abcd") for _ in range(draw.randrange(1, 13))) for _ in range(60)]

    def changed(w):
        w = list(w)
        for _ in range(draw.randrange(k + 1)):
            i = draw.randrange(len(w) + 1)
            how = draw.randrange(4)
            if how == 0:
                w.insert(i, draw.choice("abcd"))
            elif how == 1 and len(w) > 1:
                del w[min(i, len(w) - 1)]
            elif how == 2 and w:
                w[min(i, len(w) - 1)] = draw.choice("abcdé")
            elif len(w) > 1:
                i = min(i, len(w) - 2)
                w[i], w[i + 1] = w[i + 1], w[i]
        return "".join(w)

    words = sorted({changed(w) for w in base for _ in range(3)} | {"a", "ab", "xyz", "wxyz", ""})
    entries = sorted(set(base) | {"b", "ba", "zyx", "lmnop", ""})
    pairs = [p for p in itertools.product(words, entries) if p[0] and p[1]]
    import pandas as pd

    distance = edit_distances(pd.Series([a for a, _ in pairs]), pd.Series([b for _, b in pairs]))
    want = {(a, b, int(x)) for (a, b), x in zip(pairs, distance) if x <= k}
    left, right = (spark.createDataFrame([(x,) for x in xs], f"{n} STRING") for xs, n in ((words, "w"), (entries, "e")))
    assert {tuple(r) for r in fuzzy.fuzzy_pairs_by_segments(left, "w", right, "e", k).collect()} == want


def test_left_out_choices_are_numbered_in_order(spark):
    keys = ["b", "a", "d", "c", "e", "f"]
    df = spark.createDataFrame([(k,) for k in keys * 2] + [(None,)], "k STRING")
    for p in (1, 2, 3, 6):
        got = {}
        for r in splits.leave_p_out(df, "k", p).collect():
            got.setdefault(r.split, set()).add(r.test_key)
        assert [got[i] for i in range(len(got))] == [set(c) for c in itertools.combinations(sorted(keys), p)]
    assert splits.leave_p_out(df, "k", 7).count() == 0
