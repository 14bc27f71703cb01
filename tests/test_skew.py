"""Running values and quantiles of hot keys against plain windows and numpy."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.operators import quantiles, skew, windowing


def _rows(n=600, seed=1):
    rng = random.Random(seed)
    # one key holds most rows, one key is missing
    keys = ["hot"] * 6 + ["a", "b", None, "c"]
    return [(rng.choice(keys), i, rng.choice([None, rng.randint(-5, 9)])) for i in rng.sample(range(n * 3), n)]


def test_running_sums_match_a_plain_window(spark):
    df = spark.createDataFrame(_rows(), "k STRING, o INT, v INT").repartition(7)
    got = skew.running_sums(df, ["k"], ["o"], {"s": F.col("v").cast("long"), "n": F.lit(1).cast("long")})
    w = Window.partitionBy("k").orderBy("o").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.sum(F.col("v").cast("long")).over(w).alias("s"), F.count(F.lit(1)).over(w).alias("n"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_hot_key_is_cut_along_the_order(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = skew.with_pieces(spark.createDataFrame(_rows(), "k STRING, o INT, v INT"), ["k"], ["o"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per = {(r["k"], r["_piece"]): r["count"] for r in pieces.groupBy("k", "_piece").count().collect()}
    hot = [n for (k, _), n in per.items() if k == "hot"]
    assert len(hot) > 3 and max(hot) < sum(hot) / 2
    edges = pieces.filter("k = 'hot'").groupBy("_piece").agg(F.min("o"), F.max("o")).orderBy("_piece").collect()
    assert all(a[2] < b[1] for a, b in zip(edges, edges[1:]))


def test_no_rows_meet_in_one_task(spark):
    df = spark.range(1000).select("id", F.col("id").alias("o"))
    plan = skew.number_rows(df, ["o"], "n")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # a window that is dealt out names its keys before its order; the only one without is over the totals of the pieces
    unkeyed = [line for line in windows if line.count("], [") < 2]
    assert len(windows) == 2 and len(unkeyed) == 1 and "sum(_t_" in unkeyed[0]


def test_global_numbering_by_several_columns(spark):
    words = [(-(i % 3), f"w{i:03d}") for i in range(300)]
    df = spark.createDataFrame(words, "neg INT, term STRING").repartition(5)
    got = {r["term"]: r["n"] for r in skew.number_rows(df, ["neg", "term"], "n").collect()}
    assert got == {t: i for i, (_, t) in enumerate(sorted(words), 1)}


def test_numbering_by_timestamp(spark):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(minutes=7 * i), i) for i in range(200)]
    df = spark.createDataFrame(rows, "ts TIMESTAMP_NTZ, i INT").repartition(4)
    got = skew.number_rows(df, ["ts", "i"], "n").collect()
    assert all(r["n"] == r["i"] + 1 for r in got)


def test_attach_matches_missing_keys_and_keeps_rows(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k STRING, v INT")
    summary = spark.createDataFrame([("a", 10), (None, 20)], "k STRING, s INT")
    got = {r["v"]: r["s"] for r in skew.attach(df, summary, ["k"]).collect()}
    assert got == {1: 10, 2: 20, 3: None}


def test_exact_quantiles(spark):
    rng = np.random.default_rng(3)
    data = {
        "a": rng.normal(size=401),
        "b": rng.exponential(size=50) * 1e6,
        "c": np.array([2.0]),
        "d": np.repeat([1.0, 1.0, 5.0], 40),
    }
    rows = [(k, float(x)) for k, v in data.items() for x in v] + [("a", None)]
    df = spark.createDataFrame(rows, "k STRING, x DOUBLE").repartition(6)
    probs = {"q0": 0.0, "q1": 0.25, "m": 0.5, "q9": 0.9, "q100": 1.0}
    got = {r["k"]: r for r in quantiles.exact_quantiles(df, ["k"], {"x": probs}).collect()}
    for k, v in data.items():
        for name, p in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(v, p), rel=1e-12), (k, name)
    whole = quantiles.exact_quantiles(df, [], {"x": {"m": 0.5}}).first()["m"]
    assert whole == pytest.approx(np.median(np.concatenate(list(data.values()))))


def test_several_columns_of_quantiles(spark):
    df = spark.createDataFrame([("a", float(i), float(-i)) for i in range(100)], "k STRING, x DOUBLE, y DOUBLE")
    wanted = {"x": {"mx": 0.5}, "y": {"my": 0.1}}
    got = quantiles.exact_quantiles(df, ["k"], wanted).first()
    assert (got["k"], got["mx"], got["my"]) == ("a", 49.5, pytest.approx(-89.1))
    assert tuple(quantiles.exact_quantiles(df, [], wanted).first()) == (49.5, pytest.approx(-89.1))


def test_groups_and_columns_without_values_keep_their_rows(spark):
    rows = [("a", None, None, 1.0), ("a", None, None, 3.0), ("b", 1.0, None, 5.0), ("b", 3.0, None, None), (None, 7.0, None, 2.0)]
    df = spark.createDataFrame(rows, "k STRING, x DOUBLE, y DOUBLE, z DOUBLE")
    wanted = {"x": {"mx": 0.5}, "y": {"my": 0.5}, "z": {"mz": 0.5}}
    got = {r["k"]: tuple(r)[1:] for r in quantiles.exact_quantiles(df, ["k"], wanted).collect()}
    assert got == {"a": (None, None, 2.0), "b": (2.0, None, 5.0), None: (7.0, None, 2.0)}
    assert [tuple(r) for r in quantiles.exact_quantiles(df, [], {"y": {"my": 0.5}}).collect()] == [(None,)]
    assert [tuple(r) for r in quantiles.exact_quantiles(df.limit(0), [], wanted).collect()] == [(None, None, None)]


def test_run_lengths_round_trip(spark):
    rng = random.Random(5)
    bits = {k: [rng.random() < 0.6 for _ in range(n)] for k, n in (("u", 97), ("v", 5), ("w", 1))}
    bits["ones"], bits["zeros"] = [True] * 9, [False] * 9
    rows = [(k, i, int(b)) for k, v in bits.items() for i, b in enumerate(v)]
    df = spark.createDataFrame(rows, "k STRING, pos INT, bit INT").repartition(3)
    runs = windowing.run_lengths(df, ["k"], ["pos"], F.col("bit")).collect()
    back = {k: [False] * len(v) for k, v in bits.items()}
    for r in runs:
        for i in range(r["start"] - 1, r["start"] - 1 + r["length"]):
            assert not back[r["k"]][i]
            back[r["k"]][i] = True
    assert back == bits
    # runs are maximal: no two touch
    ends = {(r["k"], r["start"] + r["length"]) for r in runs}
    assert not any((r["k"], r["start"]) in ends for r in runs)


def test_running_product_with_zero_and_negative_factors(spark):
    values = {"a": [2.0, -3.0, None, -1.0, 0.5, 4.0], "b": [5.0, 0.0, 7.0]}
    rows = [(k, i, x) for k, v in values.items() for i, x in enumerate(v)]
    df = spark.createDataFrame(rows, "k STRING, o INT, x DOUBLE")
    got = {(r["k"], r["o"]): r["p"] for r in windowing.running_product(df, ["k"], ["o"], F.col("x"), "p").collect()}
    for k, v in values.items():
        running = 1.0
        for i, x in enumerate(v):
            running *= 1.0 if x is None else x
            assert got[k, i] == pytest.approx(running)
