"""Joins, set operations, windows over series, encodings, splits and scans."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from granary.functions import dates, numeric
from granary.operators import clean, encode, relational, splits, windowing
from granary.sources import files


def test_flag_split_keeps_unflagged(spark):
    entity = spark.createDataFrame([(1,), (2,), (3,)], "k INT")
    flags = spark.createDataFrame([(1, 1), (2, 0)], "k INT, f INT")
    hit, rest = relational.flag_split(entity, flags, "k", "f")
    assert [r["k"] for r in hit.collect()] == [1] and sorted(r["k"] for r in rest.collect()) == [2, 3]


def test_overlay_and_template(spark):
    base = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k INT, v DOUBLE")
    patch = spark.createDataFrame([(2, 9.0), (5, 5.0)], "k INT, v DOUBLE")
    assert sorted(map(tuple, relational.overlay(base, patch, "k", "v").collect())) == [(1, 1.0), (2, 9.0)]
    wanted = spark.createDataFrame([(2,), (3,)], "k INT")
    assert sorted(map(tuple, relational.to_template(wanted, base, "k", {"v": 0.0}).collect())) == [(2, 2.0), (3, 0.0)]


def test_star_join_repeats_rows_on_duplicate_dimension_keys(spark):
    fact = spark.createDataFrame([(1, "d1"), (2, "d2"), (3, None)], "id INT, day STRING")
    dim = spark.createDataFrame([("d1", "x"), ("d1", "y")], "day STRING, id STRING")
    got = relational.star_join(fact, [(dim, {"day": "day"}, "e_")])
    assert sorted(map(str, got.select("id", "e_id").collect())) == sorted(
        ["Row(id=1, e_id='x')", "Row(id=1, e_id='y')", "Row(id=2, e_id=None)", "Row(id=3, e_id=None)"]
    )


def test_top_with_ties_and_drop_last(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 9), ("d", 1)], "k STRING, n INT")
    assert {r["k"] for r in relational.top_with_ties(df, "n", 2).collect()} == {"a", "b", "c"}
    assert {r["k"] for r in relational.drop_last(df, "k", F.col("n"), 1).collect()} == {"a", "b", "d"}


def test_set_operations(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k INT")
    b = spark.createDataFrame([(2,), (3,)], "k INT")
    assert sorted(map(str, relational.symmetric_difference(a, b).collect())) == ["Row(k=1)", "Row(k=3)", "Row(k=None)"]
    stacked = a.unionAll(b).unionAll(b)
    assert [r["k"] for r in relational.rows_occurring_once(stacked).collect()] == [None]


def series(spark):
    d = dt.date(2024, 1, 1)
    y = [None, 1.0, None, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    rows = [("s", d + dt.timedelta(days=i), v) for i, v in enumerate(y)] + [("short", d, 2.0)]
    return spark.createDataFrame(rows, "s STRING, d DATE, y DOUBLE")


def test_series_windows(spark):
    df = series(spark)
    filled = {(r["s"], r["d"].day): r["f"] for r in windowing.forward_fill(df, ["s"], "d", "y", "f").collect()}
    assert filled["s", 1] is None and filled["s", 3] == 1.0
    trailing = {(r["s"], r["d"].day): r["m"] for r in windowing.trailing_mean(df, ["s"], "d", "y", 7, "m").collect()}
    assert trailing["s", 9] is None and trailing["s", 10] == 6.0 and trailing["short", 1] is None
    lagged = windowing.lags(df, ["s"], "d", "y", 2, complete=True).collect()
    assert {r["d"].day for r in lagged} == {6, 7, 8, 9, 10}


def test_partial_autocorrelation_of_a_memoryless_step(spark):
    acf = spark.createDataFrame([("s", 0.5, 0.25, 0.125)], "s STRING, acf_1 DOUBLE, acf_2 DOUBLE, acf_3 DOUBLE")
    got = windowing.partial_autocorrelations(acf, ["s"], 3).first()
    assert got["pacf_1"] == pytest.approx(0.5) and got["pacf_2"] == pytest.approx(0.0) and got["pacf_3"] == pytest.approx(0.0)


def test_calendar_spine_and_fill(spark):
    df = series(spark).filter("y IS NOT NULL").select("d").distinct()
    assert relational.calendar_spine(df, "d").count() == 10
    m = spark.createDataFrame([("a", 1, 5.0), ("b", 3, 7.0)], "k STRING, m INT, v DOUBLE")
    got = sorted(map(tuple, relational.fill_periods(m, ["k"], "m", [1, 2, 3], ["v"]).collect()))
    assert [v for k, _, v in got] == [5.0, 0.0, 0.0, 0.0, 0.0, 7.0]


def test_fixed_bins_are_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 1.5, 2.0, 2.5, None)], "x DOUBLE")
    got = [r[0] for r in df.select(encode.fixed_bins(F.col("x"), [0, 1, 2])).collect()]
    assert got == [None, 0, 1, 1, None, None]
    binned = encode.quantile_bins(spark.range(101).select(F.col("id").cast("double").alias("x")), "x", 10)
    counts = {r["bin"]: r["count"] for r in binned.groupBy("bin").count().collect()}
    assert counts == {None: 1, **{i: 10 for i in range(10)}}


def test_factorize_first_appearance_and_unseen(spark):
    train = spark.createDataFrame([(3, "a"), (1, "b"), (2, "a"), (4, None)], "o INT, x STRING")
    codes = encode.factorize(train, "x", "o")
    assert {r["x"]: r["code"] for r in codes.collect()} == {"b": 0, "a": 1}
    test = spark.createDataFrame([("a",), ("new",), (None,)], "x STRING")
    assert [r["c"] for r in encode.apply_codes(test, codes, "x", "c").collect()] == [1, -1, -1]


def test_one_hot_and_lumping(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), ("c",), (None,)], "x STRING")
    coded = encode.one_hot(df, "x", encode.levels_of(df, "x"), "x")
    assert [sum(r[c] for c in ("x_a", "x_b", "x_c")) for r in coded.collect()] == [1, 1, 1, 1, 1, 0]
    lumped = {r["x"]: r["count"] for r in encode.lump_rare(df, "x", share=0.3, missing="(none)").groupBy("x").count().collect()}
    assert lumped == {"a": 3, "Other": 2, "(none)": 1}
    assert len(encode.levels_of(spark.range(2000), "id")) == 2000


def test_last_rule_wins(spark):
    df = spark.createDataFrame([(1,), (5,), (9,)], "x INT")
    got = [r[0] for r in df.select(numeric.last_match([(F.col("x") > 3, "mid"), (F.col("x") > 7, "high")], "low")).collect()]
    assert got == ["low", "mid", "high"]


def test_clip_keeps_missing_and_wraps_degrees(spark):
    df = spark.createDataFrame([(-30,), (400,), (None,)], "x INT")
    got = [tuple(r) for r in df.select(numeric.clip(F.col("x"), 0, 255), numeric.wrap_degrees(F.col("x"))).collect()]
    assert got == [(0, 330), (255, 40), (None, None)]


def test_whole_days_floor_negative_spans(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 1), dt.datetime(2024, 1, 2))], "a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    got = df.select(dates.whole_days_between(F.col("a"), F.col("b")), dates.whole_days_between(F.col("b"), F.col("a"))).first()
    assert tuple(got) == (-1, 0)


def test_stretch_clamps_per_group(spark):
    rows = [("a", float(i)) for i in range(101)] + [("b", 5.0), ("b", 5.0)]
    got = clean.stretch(spark.createDataFrame(rows, "g STRING, x DOUBLE"), ["g"], "x", "s").collect()
    a = {r["x"]: r["s"] for r in got if r["g"] == "a"}
    assert a[0.0] == 0.0 and a[100.0] == 1.0 and a[50.0] == pytest.approx(0.5)
    assert all(r["s"] is None for r in got if r["g"] == "b")


def test_folds_partition_the_keys(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"))
    folds = df.select(splits.fold(F.col("id"), 5, 1).alias("f")).groupBy("f").count().collect()
    assert sum(r["count"] for r in folds) == 1000 and {r["f"] for r in folds} == set(range(5))
    per = splits.stratified_folds(df, "id", "y", 5, 1).groupBy("y", "fold").count().collect()
    assert {r["count"] for r in per if r["y"] == 1} == {20} and {r["count"] for r in per if r["y"] == 0} == {180}
    a, b = splits.sample_fraction(df, "id", 0.3, 9)
    assert a.count() + b.count() == 1000 and a.join(b, "id").count() == 0 and 200 < a.count() < 400
    assert splits.sample_rows(df, "id", 7, 1).count() == 7


def test_hash_does_not_depend_on_partitioning(spark):
    a = spark.range(500).filter(splits.in_fraction(F.col("id"), 0.4, 2)).count()
    assert a == spark.range(500).repartition(13).filter(splits.in_fraction(F.col("id"), 0.4, 2)).count()


def test_expanding_splits_never_look_ahead(spark):
    df = spark.range(23).withColumnRenamed("id", "t")
    rows = splits.expanding_splits(df, "t", 4).collect()
    for i in range(4):
        train = [r["t"] for r in rows if r["split"] == i and r["role"] == "train"]
        test = [r["t"] for r in rows if r["split"] == i and r["role"] == "test"]
        assert len(test) == 4 and max(train) + 1 == min(test) and min(train) == 0


def test_leave_p_out(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,)], "k INT")
    rows = splits.leave_p_out(df, "k", 2).collect()
    assert len({r["split"] for r in rows}) == 6 and len(rows) == 12


def test_vertical_split_is_complete(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "k INT, a INT, b INT, c INT, d INT")
    a, b = splits.vertical_split(df, "k", 0.6, 3)
    assert set(a.columns) & set(b.columns) == {"k"} and set(a.columns) | set(b.columns) == set(df.columns)


def test_delimited_scan_keeps_text_ids(spark, tmp_path):
    (tmp_path / "x.csv").write_text("id,day,v\n00012,20240131,1.5\n7,notaday,\n")
    got = files.scan_delimited(spark, str(tmp_path), "id STRING, day STRING, v DOUBLE", ["id", "day"], dates={"day": "yyyyMMdd"}).collect()
    assert [tuple(r) for r in got] == [("00012", dt.date(2024, 1, 31)), ("7", None)]
    assert files.scan_delimited(spark, str(tmp_path), "id STRING, day STRING, v DOUBLE", rows=1).count() == 1


def test_json_lines_drop_bad_rows(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"id": 1, "t": "a"}\nnot json\n{"id": 2, "other": 5}\n')
    got = files.scan_json_lines(spark, str(tmp_path), "id INT, t STRING", ["id", "t"]).collect()
    assert [tuple(r) for r in got] == [(1, "a"), (2, None)]


def test_flatten_nested_json(spark):
    doc = json.dumps({"hits": 3, "click": {"page": "p", "slot": "top"}})
    df = spark.createDataFrame([(1, doc), (2, '{"hits": 4}'), (3, None)], "id INT, totals STRING")
    schema = files.json_schema(df, "totals")
    got = files.flatten_json(df, {"totals": schema})
    assert set(got.columns) == {"id", "totals.hits", "totals.click.page", "totals.click.slot"}
    rows = {r["id"]: r for r in got.collect()}
    assert rows[1]["totals.click.slot"] == "top" and rows[2]["totals.click.page"] is None and rows[3]["totals.hits"] is None


def test_a_key_that_comes_late_is_in_the_schema(spark):
    late = F.when(F.col("id") == 11_999, F.lit('{"OBJECT<": {"late": "x"}}')).otherwise(F.lit('{"k": 1}'))
    df = spark.range(12_000).select("id", late.alias("p")).coalesce(1)
    got = files.flatten_json(df, {"p": files.json_schema(df, "p")})
    assert set(got.columns) == {"id", "p.k", "p.OBJECT<.late"} and got.filter("`p.OBJECT<.late` = 'x'").count() == 1
    none = df.select(F.lit(None).cast("string").alias("p"))
    assert files.json_schema(none, "p").fields == []


def test_repeated_splits_are_unrelated(spark):
    df = spark.range(20_000).select(F.col("id").alias("k"))
    sides = splits.repeated_splits(df, "k", 3, 0.5, 31).filter("role = 'test'").groupBy("k").agg(F.sum(F.pow(F.lit(2), F.col("split")).cast("long")).alias("s"))
    counts = {r["s"]: r["count"] for r in sides.groupBy("s").count().collect()}
    assert all(abs(counts[s] - 2500) < 250 for s in range(1, 8))
    moved = df.select((splits.arithmetic_hash(F.col("k"), splits.split_seed(31, 1)) == splits.arithmetic_hash(F.col("k") + 1, splits.split_seed(31, 0))).alias("same"))
    assert moved.filter("same").count() < 10


def test_splits_are_one_dataset(spark, tmp_path):
    df = spark.range(100).select("id", F.when(F.col("id") < 60, "train").otherwise("test").alias("split"))
    files.write_splits(df, str(tmp_path / "out"), "split")
    assert spark.read.parquet(str(tmp_path / "out/split=train")).count() == 60
