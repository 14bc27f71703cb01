"""Text expressions, fuzzy joins and retrieval against plain Python on small inputs."""

import math
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from granary.functions import distance, text
from granary.operators import fuzzy, relational
from granary.operators import text as T
from granary.plans import features


def one(spark, value, expr, schema="x STRING"):
    return spark.createDataFrame([(value,)], schema).select(expr).first()[0]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("14 karat ring ", "14k ring "),
        ("14kt gold", "14k gold"),
        ("18-carats.", "18k."),
        ("10 oz jar", "10oz jar"),
        ("5-ml tube", "5ml tube"),
        ("10 ounce jar", "10 ounce jar"),
        ("no unit", "no unit"),
    ],
)
def test_units(spark, raw, want):
    assert one(spark, raw, text.normalise_units(F.col("x"))) == want


@pytest.mark.parametrize(
    "path, want",
    [
        ("a/b/c", ["a", "b", "c", "a/b"]),
        ("a/b/c/d", ["a", "b", "c", "a/b"]),
        ("a/b", ["other", "other", "other", "other/other"]),
        (None, ["other", "other", "other", "other/other"]),
    ],
)
def test_paths(spark, path, want):
    got = one(spark, path, F.array(*text.path_levels(F.col("x")), text.path_pair(F.col("x"))))
    assert got == want


@pytest.mark.parametrize("cite, want", [("Phys.D76:013009,2007", 2007), ("Phys. D76,(2007)", 2007), ("none", None), (None, None), ("12345", 2345)])
def test_citation_year(spark, cite, want):
    assert one(spark, cite, text.citation_year(F.col("x"))) == want


def test_words_and_tokens(spark):
    raw = "The Quick-brown fox, 3 foxes; ÉÈÉ éàü 123 ab x1y"
    assert one(spark, raw, text.tokens(F.col("x"))) == ["quick", "brown", "fox", "foxes"]
    assert one(spark, raw, text.word_count(F.col("x"))) == 3
    assert one(spark, None, text.word_count(F.col("x"))) == 0
    assert one(spark, "", text.blank_token_count(F.col("x"))) == 0


def test_ngrams_of_short_texts(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w ARRAY<STRING>")
    got = [r[0] for r in df.select(text.ngrams(F.col("w"), 2)).collect()]
    assert got == [["a b", "b c"], [], []]


def test_dictionary_dialect(spark):
    raw = "{'visits': '1', 'isX': True, 'n': None}"
    j = text.literal_to_json(F.col("x"))
    assert one(spark, raw, text.json_number(j, "visits")) == 1.0
    assert one(spark, raw, text.json_number(j, "absent")) == 0.0
    assert one(spark, raw, text.json_text(j, "isX")) == "true"
    assert one(spark, raw, text.json_text(j, "absent")) is None


def naive_distance(a, b):
    d = [[max(i, j) if min(i, j) == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[-1][-1]


def test_edit_distance():
    pairs = [("ba", "abc", 2), ("fee", "deed", 2), ("abcd", "bacde", 2), ("", "ab", 2), ("é", "e", 1), ("same", "same", 0)]
    got = distance.edit_distances(pd.Series([p[0] for p in pairs]), pd.Series([p[1] for p in pairs]))
    assert got.tolist() == [p[2] for p in pairs]
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abç") for _ in range(rng.randint(0, 7)))
    a, b = [word() for _ in range(400)], [word() for _ in range(400)]
    assert distance.edit_distances(pd.Series(a), pd.Series(b)).tolist() == [naive_distance(x, y) for x, y in zip(a, b)]


def naive_deletions(word, k):
    level = found = {word}
    for _ in range(k):
        level = {w[:i] + w[i + 1 :] for w in level if len(w) > 1 for i in range(len(w))}
        found = found | level
    return found


@pytest.mark.parametrize("k", [1, 2])
def test_fuzzy_pairs_against_brute_force(spark, k):
    rng = random.Random(k)
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))) for _ in range(60)})
    queries = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(1, 6))) for _ in range(25)})
    left = spark.createDataFrame([(q,) for q in queries], "q STRING")
    right = spark.createDataFrame([(w,) for w in words], "w STRING")
    got = {(r["q"], r["w"]): r["distance"] for r in fuzzy.fuzzy_pairs(left, "q", right, "w", k).collect()}
    shared = {(q, w) for q in queries for w in words if naive_deletions(q, k) & naive_deletions(w, k)}
    assert got == {(q, w): naive_distance(q, w) for q, w in shared if naive_distance(q, w) <= k}
    # nothing is missed but words without a common letter
    near = {(q, w) for q in queries for w in words if naive_distance(q, w) <= k and set(q) & set(w)}
    assert all(len(q) <= k and len(w) <= k for q, w in near - set(got))


def test_best_suggestion_order(spark):
    pairs = spark.createDataFrame(
        [("x", "far", 2, 99), ("x", "rare", 1, 1), ("x", "often", 1, 7), ("x", "also", 1, 7)], "q STRING, w STRING, distance INT, n INT"
    )
    assert fuzzy.best_suggestions(pairs, "q", "w", "n").first()["w"] == "also"


WORD = r"[a-z0-9*/+\-'’?!.,|&%®™ôèéü]+"


def test_brand_filling_order(spark):
    rows = [
        (1, "kate spade bag", None, "by coach"),  # two-word brand opens the name
        (2, "bag", "", "kate spade tote coach"),  # two-word brand opens the description
        (3, "red coach bag", None, "nike"),  # one-word brand in the name beats the description
        (4, "bag", None, "a nike shoe coach"),  # first one-word brand of the description
        (5, "nike bag", "gucci", "coach"),  # a given brand stays
        (6, "the kate spade", None, "plain"),  # a two-word brand inside the name does not count
        (7, "x", "kate spade", None),
        (8, "y", "coach", None),
        (9, "z", "nike", None),
    ]
    df = spark.createDataFrame(rows, "id INT, name STRING, brand STRING, description STRING")
    got = {r["id"]: r["brand"] for r in relational.fill_from_dictionary(df, "id", "brand", ["name", "description"], WORD).collect()}
    assert got == {1: "kate spade", 2: "kate spade", 3: "coach", 4: "nike", 5: "gucci", 6: None, 7: "kate spade", 8: "coach", 9: "nike"}


DOCS = [(1, "a b b c"), (2, "b c d"), (3, "d d e"), (4, "")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "id INT, text STRING")




def split_words():
    return F.filter(F.split("text", " "), lambda w: w != "")



def test_tf_idf(docs):
    counts = T.term_counts(docs, "id", split_words())
    got = {(r["id"], r["term"]): r["weight"] for r in T.tf_idf(counts, "id", F.lit(4)).collect()}
    df = Counter(t for _, x in DOCS for t in set(x.split()))
    for i, x in DOCS:
        tf = Counter(x.split())
        raw = {t: n * (math.log(5 / (1 + df[t])) + 1) for t, n in tf.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        for t, v in raw.items():
            assert got[i, t] == pytest.approx(v / norm)


def test_prune_and_vocabulary(docs):
    counts = T.term_counts(docs, "id", split_words())
    kept = T.prune_by_document_frequency(counts, F.lit(4), min_df=2, max_df=0.5)
    assert {r["term"] for r in kept.collect()} == {"b", "c", "d"}
    with pytest.raises(ValueError):
        T.prune_by_document_frequency(counts, F.lit(4), max_df=2.0)
    ids = {r["term"]: r["word_id"] for r in T.vocabulary_ids(docs, split_words()).collect()}
    assert ids == {"b": 1, "d": 2, "c": 3, "a": 4, "e": 5}


def test_sequences_keep_the_tail_and_pad_on_the_left(docs):
    ids = T.vocabulary_ids(docs, split_words())
    got = {r["id"]: (r["full_length"], r["sequence"]) for r in T.id_sequences(docs, "id", split_words(), ids, 3).collect()}
    assert got == {1: (4, [1, 1, 3]), 2: (3, [1, 3, 2]), 3: (3, [2, 2, 5]), 4: (0, [0, 0, 0])}


def test_keyword_in_context(docs):
    got = T.keyword_in_context(docs, "id", split_words(), ["b", "c"], 1).collect()
    assert {(r["id"], r["position"], r["before"], r["keyword"], r["after"]) for r in got} == {(1, 3, "b", "b c", ""), (2, 1, "", "b c", "d")}


def test_shared_terms(docs):
    counts = T.term_counts(docs, "id", split_words())
    a, b = T.shared_terms(counts.filter("id = 1"), counts.filter("id > 1"))
    assert {r["term"] for r in a.collect()} == {"b", "c"} == {r["term"] for r in b.collect()}


def test_hashed_counts_have_unit_length(docs):
    h = T.hashed_counts(docs, "id", split_words(), (1, 2), 2**27)
    for r in h.groupBy("id").agg(F.sum(F.col("weight") * F.col("weight")).alias("s")).collect():
        assert r["s"] == pytest.approx(1.0)
    assert {r["bucket"] >= 0 and r["bucket"] < 2**27 for r in h.collect()} == {True}


@pytest.mark.parametrize("signed", [True, False])
def test_hashed_counts_with_collisions(spark, docs, signed):
    got = {(r["id"], r["bucket"]): r["n"] for r in T.hashed_counts(docs, "id", split_words(), (1, 2), 3, signed).collect()}
    grams = docs.select("id", F.explode(F.concat(split_words(), text.ngrams(split_words(), 2))).alias("g"))
    h = F.xxhash64("g")
    sign = F.when(h >= 0, 1).otherwise(-1) if signed else F.lit(1)
    want = grams.groupBy("id", F.pmod(h, F.lit(3)).alias("b")).agg(F.sum(sign).alias("n")).collect()
    assert got == {(r["id"], r["b"]): r["n"] for r in want}


def test_bm25_against_the_formula(spark, docs):
    q = spark.createDataFrame([("q1", "b d d"), ("q2", "zzz")], "qid STRING, text STRING")
    got = {(r["qid"], r["id"]): r["score"] for r in T.bm25(docs, "id", split_words(), q, "qid", split_words(), 10).collect()}
    lengths = {i: len(x.split()) for i, x in DOCS}
    mean = sum(lengths.values()) / len(DOCS)
    df = Counter(t for _, x in DOCS for t in set(x.split()))
    want = {}
    for i, x in DOCS:
        tf = Counter(x.split())
        s = sum(
            n * math.log(1 + (len(DOCS) - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * lengths[i] / mean))
            for t, n in Counter("b d d".split()).items()
            if tf[t]
        )
        if s:
            want["q1", i] = pytest.approx(s)
    assert got == want


def test_all_pairs_within_three_edits(spark):
    draw = random.Random(8)
    words = {"a", "b", "ab", "abc", "xyz", "wxyz"} | {"".join(draw.choice("abcdé") for _ in range(draw.randint(1, 9))) for _ in range(90)}
    entries = {"".join(draw.sample(w, len(w))) if draw.random() < 0.5 else w[1:] + "ba" for w in words} | {"c", "uvw"}
    left, right = spark.createDataFrame([(w,) for w in words], "word string"), spark.createDataFrame([(w,) for w in entries], "term string")
    grid = [(w, e) for w in words for e in entries]
    far = distance.edit_distances(*(pd.Series(x) for x in zip(*grid)))
    got = {(r.word, r.term): r.distance for r in fuzzy.fuzzy_pairs(left, "word", right, "term", 3, whole=True).collect()}
    assert got == {pair: d for pair, d in zip(grid, far) if d <= 3} and {1, 2, 3} <= set(got.values())


def test_words_of_one_file_are_made_in_many_tasks(spark, tmp_path):
    rows = [(i, f"word{i} and an other word{i % 7} here") for i in range(400)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' AS lang", "'s' AS source", "1L AS n_chars").coalesce(1).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    hashed = features.f01_hashed_ngrams(spark, str(tmp_path))
    assert hashed.select(F.spark_partition_id().alias("p")).distinct().count() > 4
    assert hashed.groupBy("doc_id").count().count() == 400
    assert len(features._counts(spark, str(tmp_path)).inputFiles()) > 4
