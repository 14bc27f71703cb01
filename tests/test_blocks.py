"""Blocks of sparse rows and what is dealt, sorted or written first, on rows of the tests' own."""

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from granary import session
from granary.operators import blocks, clusters, custom, decompose, listing, topics, windowing


def test_sweeps_move_terms_of_blocks_and_not_cells(spark, monkeypatch):
    monkeypatch.setattr(blocks, "LEAST", 60)
    draw = np.random.default_rng(2)
    cells = [(f"r{i}", f"t{j}", float(w)) for i in range(40) for j, w in enumerate(draw.random(12)) if w > 0.4]
    cells += [("r0", "t0", 0.5), ("r0", "t0", 0.25)]  # a repeated cell counts as the sum
    df = spark.createDataFrame(cells, "id STRING, term STRING, weight DOUBLE").repartition(3)
    made = blocks.packed(df, "id")
    assert made.count > 1 and made.needs.count() < len(cells) / 2  # the old way sent a vector for each cell
    dense = {f"r{i}": np.zeros(12) for i in range(40)}
    for i, t, w in cells:
        dense[i][int(t[1:])] += w
    vectors = draw.random((12, 3))
    sent = made.terms.select("number", F.create_map(*[x for j in range(12) for x in (F.lit(f"t{j}"), F.array(*map(F.lit, vectors[j].tolist())))])[F.col("term")].alias("v"))
    there = made.swept(sent, 3, lambda b, v: pa.table({"id": b.ids, "v": blocks.lists(b.times(v))}), "id STRING, v ARRAY<DOUBLE>")
    got = {r.id: r.v for r in there.collect()}
    assert got.keys() == dense.keys() and all(np.allclose(got[i], x @ vectors) for i, x in dense.items())
    back = made.swept(sent, 3, lambda b, v: pa.table({"number": b.numbers, "v": blocks.lists(b.back(b.times(v)))}), "number BIGINT, v ARRAY<DOUBLE>")
    got = {r.term: r.v for r in blocks.summed(back, 3, "number").join(made.terms, "number").collect()}
    matrix = np.stack([dense[f"r{i}"] for i in range(40)])
    assert all(np.allclose(got[f"t{j}"], (matrix.T @ matrix @ vectors)[j]) for j in range(12))


def test_topics_of_a_document_follow_no_grouping():
    draw = np.random.default_rng(4)
    words, counts = draw.random((60, 3)), draw.integers(1, 5, 60).astype(float)
    together, _, _ = topics.shares(np.array([0, 20, 25, 60]), counts, words, 0.3)
    for i, (s, e) in enumerate([(0, 20), (20, 25), (25, 60)]):
        assert np.allclose(together[i], topics.shares(np.array([0, e - s]), counts[s:e], words[s:e], 0.3)[0][0], rtol=1e-12)


def test_listings_are_dealt_out_before_their_features(spark, monkeypatch):
    monkeypatch.setattr(listing, "PER_PART", 3)
    rows = [(i % 50, f"red chair {i}", "a/b/c", None, 1, 0) for i in range(100)]
    df = spark.createDataFrame(rows, "item_id INT, name STRING, category STRING, brand STRING, condition INT, shipping INT").coalesce(1)
    assert listing.dealt_out(df, "item_id").rdd.getNumPartitions() >= 34
    got = {(r.item_id, r.feature): r.n for r in listing.feature_table(df, "item_id").collect()}
    assert got[(7, "name=red")] == 2 and len({i for i, _ in got}) == 50  # rows of one item count together


def test_a_group_is_folded_once_a_batch(spark):
    df = spark.range(40_000).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"), F.lit(1).cast("long").alias("w")).coalesce(1)
    calls = spark.sparkContext.accumulator(0)
    plain = custom.weighted_quantiles("v", "w", [50])

    def counted(state, rows):
        calls.add(1)
        return plain.update(state, rows)

    got = custom.aggregate(df, ["k"], ["v", "w"], custom.Aggregator(dict, counted, plain.merge, plain.finish, plain.returns)).collect()
    assert {r.k: r.weight for r in got} == dict.fromkeys(range(500), 80) and calls.value < 600  # before: 500 a batch, 2,000


def test_a_small_summary_deals_no_rows(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = windowing.attach_aggregates(df, ["k"], {"m": F.avg("v")})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Broadcast" in plan
    assert {(r.k, r.m) for r in out.collect()} == {(0, 499.5), (1, 499.0), (2, 500.0)}


def _shuffled(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {f.getName() for f in (found.apply(i) for i in range(found.size())) if f.getName().startswith("shuffle_")}


def test_what_a_written_table_shuffled_is_dropped(spark):
    before = _shuffled(spark)
    kept = session.durable(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
    assert not _shuffled(spark) - before and session.is_durable(kept)
    assert {r["count"] for r in kept.collect()} == {142, 143}
    path = kept._granary_path.removeprefix("file:")
    session.discard(kept, spark.range(1))
    assert not os.path.exists(path)


def test_passes_leave_no_tables_behind(spark):
    rows = [(i, f"w{(i * j) % 11}", 1 + j) for i in range(30) for j in range(5)]
    df = spark.createDataFrame(rows, "id LONG, term STRING, tf LONG").groupBy("id", "term").agg(F.sum("tf").alias("tf"))
    folder = session.shared_dir(spark).removeprefix("file:")

    def left(work):
        before = set(os.listdir(folder))
        work()
        return len([x for x in set(os.listdir(folder)) - before if x.startswith("table-")])

    assert left(lambda: topics.fit(df, "id", 2, 1, 1)) >= left(lambda: topics.fit(df, "id", 2, 4, 1))
    cells = df.withColumnRenamed("tf", "weight")
    assert left(lambda: decompose.truncated_svd(cells, "id", 2, passes=1)) >= left(lambda: decompose.truncated_svd(cells, "id", 2, passes=4))


def test_rounds_of_blocks_add_up(spark, monkeypatch):
    monkeypatch.setattr(blocks, "MOST", 20)
    monkeypatch.setattr(blocks, "FEW", 4)
    draw = np.random.default_rng(6)
    matrix = np.where(draw.random((50, 14)) < 0.5, draw.integers(1, 90_000, (50, 14)) / 2, 0.0)  # some weights are whole and small
    cells = [(int(i), f"t{j}", float(matrix[i, j])) for i, j in zip(*np.nonzero(matrix))]
    made = blocks.packed(spark.createDataFrame(cells, "id LONG, term STRING, weight DOUBLE"), "id")
    start = draw.random((14, 2))
    vectors = made.terms.select("number", F.create_map(*[x for j in range(14) for x in (F.lit(f"t{j}"), F.array(*map(F.lit, start[j].tolist())))])[F.col("term")].alias("v"))
    state = made.state(vectors, 2)
    want = matrix.T @ matrix @ (2 * start) + 1
    for least, rounds in ((10**9, 1), (1, made.count // spark.sparkContext.defaultParallelism)):
        monkeypatch.setattr(blocks, "ROUND", least)
        assert made.rounds() == rounds and len(made.sizes) > 1
        out = made.there_and_back(state, lambda m: 2 * m, lambda b, v: (b.back(b.times(v)), len(b.ids)), 2, lambda m: m + 1)
        got = {r.term: r.v for r in made.listed(out).join(made.terms, "number").collect()}
        assert all(np.allclose(got[f"t{j}"], want[j]) for j in range(14)) and out.agg(F.sum("x")).first()[0] == 50


def test_few_centres_are_spread_out_at_a_time(monkeypatch):
    draw = np.random.default_rng(8)
    starts = np.arange(0, 241, 6)
    block = blocks.Block(pa.array(range(40)), starts, draw.integers(0, 30, 240).astype(np.int32), draw.random(240), np.arange(30))
    place, at, value = draw.integers(0, 30, 200), draw.integers(0, 25, 200), draw.random(200)
    centres = np.zeros((30, 25))
    np.add.at(centres, (place, at), value)
    whole = clusters._chosen(block, place, at, value, (centres**2).sum(axis=0), 10**6)
    spread, plain = [], np.zeros
    monkeypatch.setattr(np, "zeros", lambda shape, *a: spread.append(np.prod(shape)) or plain(shape, *a))
    pieces = clusters._chosen(block, place, at, value, (centres**2).sum(axis=0), 90)
    assert max(spread) <= 90 and all(np.allclose(a, b) for a, b in zip(whole, pieces))


def test_clusters_of_repeated_cells(spark):
    rows = [(i, f"t{i % 3}{j}", 0.5) for i in range(24) for j in range(4)]
    df = spark.createDataFrame(rows + rows[:40], "id LONG, term STRING, weight DOUBLE")  # some rows come twice
    centres = clusters.fit(df, "id", 3, seed=1, batches=2, passes=1)
    got = {r.id: r.cluster for r in clusters.nearest(df, centres, "id").collect()}
    assert len(got) == 24 and len({(i % 3, c) for i, c in got.items()}) == 3
