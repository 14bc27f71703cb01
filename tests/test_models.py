"""Linear models, decomposition, metrics and the model loops."""

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from granary.operators import linear, metrics, models, vectors


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 2)) + [3.0, 100.0]
    y = 2.0 * x[:, 0] - 0.5 * x[:, 1] + rng.normal(scale=0.3, size=200)
    rows = [(i, i % 4, float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id BIGINT, fold INT, a DOUBLE, b DOUBLE, y DOUBLE"), x, y


def closed_form(x, y, alpha):
    mx, my = x.mean(0), y.mean()
    w = np.linalg.solve((x - mx).T @ (x - mx) + alpha * np.eye(x.shape[1]), (x - mx).T @ (y - my))
    return my - w @ mx, w


@pytest.mark.parametrize("alpha", [0.0, 5.0])
def test_ridge(data, alpha):
    df, x, y = data
    got = linear.ridge(df, ["a", "b"], "y", alpha)
    intercept, w = closed_form(x, y, alpha)
    assert got["intercept"] == pytest.approx(intercept) and [got["a"], got["b"]] == pytest.approx(w.tolist())


def test_cross_validated_ridge_matches_refitting(data):
    df, x, y = data
    table, chosen = linear.ridge_by_cross_validation(df, ["a", "b"], "y", "fold", [0.1, 50.0])
    fold = np.arange(200) % 4
    for r in table.collect():
        error = 0.0
        for i in range(4):
            c, w = closed_form(x[fold != i], y[fold != i], r["alpha"])
            error += ((y[fold == i] - c - x[fold == i] @ w) ** 2).sum()
        assert r["rmse"] == pytest.approx(np.sqrt(error / 200))
    assert chosen["alpha"] == 0.1


def test_one_model_per_series(data):
    df, x, y = data
    got = {r["fold"]: r for r in linear.series_models(df, ["fold"], ["a", "b"], "y").collect()}
    for i in range(4):
        c, w = closed_form(x[i::4], y[i::4], 0.0)
        assert got[i]["intercept"] == pytest.approx(c) and got[i]["b_b"] == pytest.approx(w[1])


def test_diagnostics_flag_collinear_columns(spark, data):
    df, x, y = data
    out = {r["feature"]: r for r in linear.regression_diagnostics(df, ["a", "b"], "y").collect()}
    c, w = closed_form(x, y, 0.0)
    sse = ((y - c - x @ w) ** 2).sum()
    assert out["a"]["sse"] == pytest.approx(sse) and out["a"]["r2"] == pytest.approx(1 - sse / ((y - y.mean()) ** 2).sum())
    assert not out["a"]["collinear"]
    twin = df.withColumn("c", F.col("a") * 2 + F.col("b") * 1e-3)
    assert any(r["collinear"] for r in linear.regression_diagnostics(twin, ["a", "b", "c"], "y").collect())


def test_truncated_svd(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 6))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id INT, v ARRAY<DOUBLE>").repartition(5)
    got = vectors.truncated_svd(df, "id", "v", 2).orderBy("id").collect()
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    for k in range(2):
        assert np.abs([r[f"component_{k + 1}"] for r in got]) == pytest.approx(np.abs(u[:, k] * s[k]))


def test_nearest_centroid_and_kmeans(spark):
    pts = [(0, [0.0, 0.1]), (1, [0.1, 0.0]), (2, [5.0, 5.0]), (3, [5.1, 5.0])]
    df = spark.createDataFrame(pts, "id INT, v ARRAY<DOUBLE>")
    got = {r["id"]: (r["centroid"], r["distance"]) for r in vectors.nearest_centroid(df, "id", "v", {7: [0.0, 0.0], 9: [5.0, 5.0]}).collect()}
    assert got[0] == (7, pytest.approx(0.1)) and got[2] == (9, 0.0)
    km = {r["id"]: r["cluster"] for r in vectors.kmeans(df, "id", "v", 2, 1).collect()}
    assert km[0] == km[1] != km[2] == km[3]


def test_threshold_sweep_against_brute_force(spark):
    rng = np.random.default_rng(2)
    truth, score = rng.integers(0, 2, 300), np.round(rng.random(300), 3)
    score[:3] = [0.0, 1.0, 10 / 49]
    df = spark.createDataFrame([(int(t), float(s)) for t, s in zip(truth, score)], "t INT, s DOUBLE")
    for r in metrics.threshold_sweep(df, "t", "s", 50).collect():
        above = np.round(score * 49, 9) > r["step"]
        assert (r["tp"], r["fp"], r["fn"]) == ((above & (truth == 1)).sum(), (above & (truth == 0)).sum(), (~above & (truth == 1)).sum())
    best = metrics.best_threshold(metrics.threshold_sweep(df, "t", "s", 50), 9, 40).first()
    assert 9 <= best["step"] < 40


def test_class_report_with_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0), (2, 2), (2, 0)], "t INT, p INT")
    got = {r["label"]: r for r in metrics.class_report(df, "t", "p").collect()}
    assert got[1]["precision"] == 0.0 and got[1]["recall"] == 0.0 and got[1]["f1"] == 0.0 and got[1]["support"] == 1
    assert got[0]["precision"] == 0.5 and got[0]["recall"] == 1.0 and got[2]["recall"] == 0.5


def test_error_metrics_skip_missing_predictions(spark):
    df = spark.createDataFrame([(3.0, 1.0), (5.0, None), (2.0, 2.0)], "y DOUBLE, p DOUBLE")
    got = metrics.error_metrics(df, "y", "p").first()
    assert got["n"] == 2 and got["rmse"] == pytest.approx(np.sqrt(2.0)) and got["mae"] == 1.0


def test_out_of_fold_predicts_every_row_once(data):
    df, x, y = data
    plain = lambda: LinearRegression(labelCol="y", featuresCol="features")
    own, averaged = models.out_of_fold(df, "id", ["a", "b"], "y", plain, 4, 1, test=df.select("id", "a", "b"))
    rows = own.collect()
    assert sorted(r["id"] for r in rows) == list(range(200))
    assert np.corrcoef([r["y"] for r in rows], [r["prediction"] for r in rows])[0, 1] > 0.95
    assert averaged.count() == 200


def test_permuted_column_keeps_its_values(spark, data):
    df, _, _ = data
    shuffled = models.permuted(df, "id", "a", 5)
    before = {r["id"]: r["a"] for r in df.collect()}
    after = {r["id"]: r["a"] for r in shuffled.collect()}
    assert sorted(before.values()) == sorted(after.values()) and before != after
