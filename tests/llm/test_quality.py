import tracemalloc
import zlib

import numpy as np

from granary.llm import quality
from granary.llm.common import table


def auc(score, label):
    order = np.argsort(np.argsort(score)) + 1
    good = label == 1
    return (order[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = quality.classify(table(spark, sf, "documents"), table(spark, sf, "labels")).toPandas()
    labels = table(spark, sf, "labels").toPandas()
    assert len(out) == 1000 and out.score.between(0, 1).all() and ((out.score >= 0.5) == out.predicted.astype(bool)).all()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in out.doc_id]).all()
    held = out[out.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.97 and auc(held.score.to_numpy(), held.quality.to_numpy()) > 0.98


def test_votes_are_exact_neighbours():
    rng = np.random.default_rng(0)
    found, labels = rng.integers(0, 9, (60, quality.FEATURES)).astype(np.float32), rng.integers(0, 2, 60)
    model = quality.fit(found, labels)
    vectors = model.project(found)
    cosine = vectors[5] @ model.vectors.T
    near = np.argsort(-cosine)[: quality.NEIGHBOURS]
    weight = np.maximum(cosine[near].astype(float), 0) ** quality.SHARPNESS
    assert abs(model.score(found[5:6])[0] - (weight * labels[near]).sum() / weight.sum()) < 1e-6


def test_held_out_labels_are_not_used(spark):
    docs = spark.createDataFrame([(i, "good text here" if i % 2 else "### $$$ %%%") for i in range(60)], "doc_id long, text string")
    rows = [(i, i % 2) for i in range(60)]
    other = [(i, (1 - q) if zlib.crc32(str(i).encode()) % 3 == 1 else q) for i, q in rows]
    a, b = (quality.classify(docs, spark.createDataFrame(r, "doc_id long, quality int")).collect() for r in (rows, other))
    assert a == b and {r.predicted for r in a if r.doc_id % 2} == {1}


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "x"), (None, "good text"), (5, "é" * 100_000), (5, "é" * 100_000)], "doc_id long, text string")
    docs = docs.selectExpr("*", "'a' as quality", "'b' as h", "'c' as counts", "'d' as score")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 1), (None, 1), (5, 7), (5, 1), (5, 1)], "doc_id long, quality int").selectExpr("*", "'t' as text")
    out = quality.classify(docs, labels).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    assert quality.keep_good(docs, labels).columns == docs.columns
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {1}
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_training_holds_the_sample_once_on_the_driver(spark):
    docs = spark.range(1500).selectExpr("id as doc_id", "concat_ws(' ', transform(sequence(1, 40), k -> sha2(string(id * k), 256))) as text")
    labels = spark.range(1500).selectExpr("id as doc_id", "int(id % 2) as quality")
    tracemalloc.start()
    try:
        model = quality.train(docs, labels)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    sample = len(model.labels) * quality.FEATURES * 4
    assert len(model.labels) > 900 and peak < 2 * sample


def test_rows_weighted_in_place_give_the_same_model():
    rng = np.random.default_rng(0)
    for n in (1, quality.BLOCK, 2 * quality.BLOCK + 1):
        found, labels = rng.integers(0, 3, (n, quality.FEATURES)).astype(np.float32), rng.integers(0, 2, n)
        found[0] = 0
        kept = found.copy()
        apart = quality.fit(found, labels)
        assert (found == kept).all()
        placed = quality.fit(found, labels, found)
        assert all((getattr(apart, x) == getattr(placed, x)).all() for x in ("weight", "axes", "vectors", "labels")) and apart.prior == placed.prior
