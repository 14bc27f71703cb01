"""Sparse ridge against numpy, and brands filled from names."""

import random

import numpy as np

from granary.operators import listing, sparse


def test_ridge_against_numpy(spark):
    draw = random.Random(9)
    cells = [(i, f"{b}={draw.randrange(9)}", draw.random()) for i in range(80) for b in ("name", "brand", "text")]
    y = {i: draw.random() * 5 for i in range(78)}
    df = spark.createDataFrame(cells, "id LONG, term STRING, weight DOUBLE")
    goals = spark.createDataFrame([*y.items(), (78, None)], "id LONG, y DOUBLE")
    coefficients, offset = sparse.ridge(df, goals, "id", 0.4, tolerance=1e-10)
    got = {r.term: r.value for r in coefficients.collect()}
    terms = sorted({t for i, t, _ in cells if i in y})
    x = np.zeros((78, len(terms)))
    for i, t, w in cells:
        if i in y:
            x[i, terms.index(t)] += w
    mean = np.mean(list(y.values()))
    want = np.linalg.solve(x.T @ x + 0.4 * np.eye(len(terms)), x.T @ (np.array([y[i] for i in range(78)]) - mean))
    assert sorted(got) == terms and abs(offset - mean) < 1e-12
    assert np.abs(np.array([got[t] for t in terms]) - want).max() < 1e-8
    rows = spark.createDataFrame([(0,), (999,)], "id LONG")
    said = {r.id: r.prediction for r in sparse.predict(df, rows, coefficients, offset, "id").collect()}
    assert abs(said[0] - (mean + x[0] @ want)) < 1e-8 and abs(said[999] - mean) < 1e-12


def test_ridge_without_rows(spark):
    df = spark.createDataFrame([(1, "a", 1.0)], "id LONG, term STRING, weight DOUBLE")
    coefficients, offset = sparse.ridge(df, spark.createDataFrame([], "id LONG, y DOUBLE"), "id", 1.0)
    assert coefficients.count() == 0 and offset is None
    assert [r.prediction for r in sparse.predict(df, df.select("id"), coefficients, offset, "id").collect()] == [None]


def test_brands_from_names(spark):
    rows = [(1, "red under armour shirt", None, 1), (2, "shirt", "under armour", 2), (3, "nike shoe", " ", 3), (4, "old nike", "nike", 4), (5, "armour", None, 5), (6, None, None, 6)]
    df = spark.createDataFrame(rows, "item_id INT, name STRING, brand STRING, _kept INT")
    got = listing.fill_brands(df, "item_id")
    assert got.columns == df.columns
    assert {r.item_id: r.brand for r in got.collect()} == {1: "under armour", 2: "under armour", 3: "nike", 4: "nike", 5: None, 6: None}
