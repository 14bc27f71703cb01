"""Roll-ups and profiles on small tables with the awkward cases in them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from granary.functions.aggspec import aggregate_columns, rollup
from granary.operators import clean, profile
from granary.operators import rollup as R


@pytest.fixture(scope="module")
def visits(spark):
    t = dt.datetime(2024, 1, 1, 10)
    rows = [
        ("one", t, "a", 5.0, 1),
        ("two", t, "a", None, 2),
        ("two", t + dt.timedelta(days=1, hours=23), "b", 3.0, 4),
        ("two", t + dt.timedelta(days=1, hours=23), None, None, 4),
        (None, t, "a", 9.0, 7),
    ]
    return spark.createDataFrame(rows, "visitor STRING, ts TIMESTAMP_NTZ, channel STRING, revenue DOUBLE, hits INT")


def test_session_rollup(visits):
    spec = {"hits": ["sum", "median", "var", "std", "nunique", "ptp"]}
    got = {r["visitor"]: r for r in R.session_rollup(visits, "visitor", "ts", "revenue", spec).collect()}
    assert set(got) == {"one", "two"}  # a missing key is no visitor
    assert got["one"]["hits_var"] is None and got["one"]["hits_std"] is None
    assert got["two"]["hits_median"] == 4.0 and got["two"]["hits_nunique"] == 2 and got["two"]["hits_ptp"] == 2
    assert got["two"]["date_diff"] == 1 and got["two"]["revenue_size"] == 3
    import math

    assert got["two"]["revenue_sum"] == pytest.approx(math.log1p(3.0))
    logs = {r["visitor"]: r["revenue_sum"] for r in R.session_rollup(visits, "visitor", "ts", "revenue", {}, True).collect()}
    assert logs["two"] == pytest.approx(math.log1p(3.0)) and logs["one"] == pytest.approx(math.log1p(5.0))


def test_distinct_counters_agree(spark):
    df = spark.createDataFrame([("k", 1), ("k", 1), ("k", 53), ("k", None), ("j", None)], "k STRING, w INT")
    got = {r["k"]: r for r in df.groupBy("k").agg(
        F.count_distinct("w").alias("a"),
        *[c.alias(n) for c, n in zip(aggregate_columns({"w": ["nunique_small", "nunique_bounded"]}), "bc")],
    ).collect()}
    assert (got["k"]["a"], got["k"]["b"], got["k"]["c"]) == (2, 2, 2)
    assert got["j"]["a"] == 0 and got["j"]["c"] == 0 and (got["j"]["b"] or 0) == 0


def test_size_counts_missing_values_and_count_does_not(visits):
    got = {r["channel"]: r for r in R.category_summary(visits, "channel", "revenue").collect()}
    assert got["a"]["size"] == 3 and got["a"]["non_null"] == 2 and None not in got


def test_aggregate_split_matches_two_rollups(spark):
    rows = [
        ("c1", 1, 10.0, "m1", 1), ("c1", 0, 20.0, "m2", 2), ("c1", 1, 30.0, "m1", 3), ("c2", 0, 5.0, None, 1), ("c3", 1, 7.0, "m3", 9),
    ]
    base = spark.createDataFrame(rows, "card STRING, authorized INT, amount DOUBLE, merchant STRING, installments INT")
    facts = base.select(
        "*",
        F.lit(1).alias("category_1"),
        F.lit(None).cast("int").alias("category_2"),
        F.lit("A").alias("category_3"),
        F.lit("x").alias("merchant_category"),
        F.lit(1).alias("state"),
        F.lit(2).alias("city"),
        F.lit("s").alias("subsector"),
        F.lit(dt.datetime(2001, 5, 1)).cast("timestamp_ntz").alias("purchase_ts"),
        F.lit(-3).alias("month_lag"),
    )
    facts = R.prepare_transactions(facts, "2001-08-02 00:00:00")
    side = F.when(F.col("authorized") == 1, "auth").otherwise("denied")
    both = R.aggregate_split(facts, side, ("auth", "denied"))
    auth = R.aggregate_transactions(facts.filter("authorized = 1"), prefix="auth_")
    want = {r["card"]: r.asDict() for r in auth.collect()}
    for r in both.collect():
        got = {k: v for k, v in r.asDict().items() if k == "card" or k.startswith("auth_")}
        if r["card"] in want:
            assert got == want[r["card"]]
        else:
            assert r["auth_transactions_count"] is None  # all purchases denied
    assert {r["card"]: r["denied_amount_sum"] for r in both.collect()} == {"c1": 20.0, "c2": 5.0, "c3": None}


def test_two_stage_aggregates(spark):
    df = spark.createDataFrame([("c", 1, 10.0), ("c", 1, 20.0), ("c", 2, 40.0), ("d", 1, 1.0)], "k STRING, p INT, v DOUBLE")
    got = {r["k"]: r for r in R.aggregate_per_period(df, "k", "p", {"v": ["sum"]}).collect()}
    assert got["c"]["v_sum_mean"] == 35.0 and got["c"]["p_mean"] == 1.5 and got["d"]["v_sum_std"] is None
    s = {r["k"]: r for r in R.successive_aggregates(df, "k", "p", "v").collect()}
    assert s["c"]["p_v_mean"] == 27.5 and s["c"]["p_v_max"] == 40.0


def test_value_counts_shares_add_up(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "x STRING")
    got = R.value_counts(df, "x").collect()
    assert sum(r["share"] for r in got) == pytest.approx(1.0) and len(got) == 2


def test_first_valid_is_per_column(spark):
    df = spark.createDataFrame([("d", 1, None, "x"), ("d", 2, "y", "z"), ("e", 1, None, None)], "k STRING, o INT, a STRING, b STRING")
    got = {r["k"]: (r["a"], r["b"]) for r in R.first_valid(df, "k", F.col("o"), ["a", "b"]).collect()}
    assert got == {"d": ("y", "x"), "e": (None, None)}


def test_majority_vote(spark):
    df = spark.createDataFrame([(1, 2, 2), (3, 1, 2), (None, 4, None), (None, None, None)], "a INT, b INT, c INT")
    got = [r[0] for r in df.select(R.majority_vote([F.col(c) for c in "abc"])).collect()]
    assert got == [2, 1, 4, None]


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("b", 9.99), ("b", None)], "p STRING, v DOUBLE")
    got = {(r["p"], r["bin"]): r["n"] for r in R.shared_histogram(df, "p", "v", 5).collect()}
    assert got == {("a", 0): 1, ("a", 4): 1, ("b", 4): 1}


def test_constant_columns(spark):
    df = spark.createDataFrame([(1, "c", None, "x"), (2, "c", None, None)], "id INT, same STRING, none STRING, half STRING")
    assert profile.constant_columns(df, df.columns) == ["same", "none"]
    assert profile.constant_columns(df, df.columns, null_is_value=False, keep=["same"]) == ["none", "half"]


def test_profiles_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a STRING, v DOUBLE")
    assert [tuple(r) for r in profile.missing_profile(df, ["a", "v"]).collect()] == [("a", 0, None), ("v", 0, None)]
    assert rollup(df, ["a"], {"v": ["mean"]}).count() == 0


def test_key_overlap(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k INT")
    b = spark.createDataFrame([(2,), (3,)], "k INT")
    assert tuple(profile.key_overlap(a, b, "k").first()) == (2, 2, 1)


def test_narrow_types_and_cast(spark):
    df = spark.createDataFrame([(1, 40_000, 0.5), (100, -5, 2.5)], "a BIGINT, b BIGINT, c DOUBLE")
    suggested = profile.narrow_types(df, ["a", "b", "c"])
    assert {r["column"]: r["suggested_type"] for r in suggested.collect()} == {"a": "tinyint", "b": "int", "c": "float"}
    assert dict(profile.apply_types(df, suggested).dtypes) == {"a": "tinyint", "b": "int", "c": "float"}


def test_classify_columns_at_the_limit(spark):
    df = spark.range(100).select((F.col("id") % 24).alias("a"), (F.col("id") % 25).alias("b"), F.col("id").alias("c"))
    got = {r["column"]: r["kind"] for r in profile.classify_columns(df, ["a", "b", "c"]).collect()}
    assert got == {"a": "categorical", "b": "continuous", "c": "continuous"}


def test_intraclass_correlation_limits(spark):
    same = spark.createDataFrame([(g, float(g)) for g in range(4) for _ in range(5)], "g INT, v DOUBLE")
    assert R.intraclass_correlation(same, "g", "v").first()["icc"] == pytest.approx(1.0)


def test_nan_becomes_missing(spark):
    df = spark.createDataFrame([("a", float("nan")), ("a", 1.0)], "k STRING, v DOUBLE")
    assert clean.nan_to_null(df).agg(F.avg("v")).first()[0] == 1.0


def test_scaling_round_trip_and_constant_column(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0), (None, 7.0)], "x DOUBLE, c DOUBLE")
    scaled = clean.min_max_scale(df, df, ["x", "c"], -1.0, 1.0)
    assert [r["x"] for r in scaled.collect()] == [-1.0, 1.0, None]
    assert all(r["c"] is None for r in scaled.collect())
    assert [r["x"] for r in clean.min_max_unscale(df, scaled, ["x"], -1.0, 1.0).collect()] == [1.0, 3.0, None]


def test_constant_columns_do_not_divide_by_zero(spark):
    df = spark.createDataFrame([("g", 2.0, 1.0), ("g", 2.0, 5.0)], "g STRING, x DOUBLE, y DOUBLE")
    assert profile.correlation_pairs(df, ["x", "y"]).first()["corr"] is None
    assert [(r["bin"], r["n"]) for r in R.shared_histogram(df, "g", "x", 4).collect()] == [(0, 2)]
    assert R.intraclass_correlation(df, "g", "y").first()["icc"] is None
