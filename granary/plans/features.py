"""Text features, vectors and retrieval."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import text as tf
from granary.functions.numeric import arithmetic_hash, arithmetic_hash_sql
from granary.operators import clusters, decompose, listing, text as textops, topics, vectors
from granary.operators.blocks import packed
from granary.plans.aggregates import rounded
from granary.plans.registry import fx, query
from granary.plans.tables import ITEMS_SQL, items, table
from granary.plans.texts import TOKENS_SQL, WORDS_SQL, dealt_docs, docs, words
from granary.session import discard, durable

_COUNTS_SQL = f"""w AS (SELECT doc_id, unnest({TOKENS_SQL}) AS term FROM documents),
c AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2), d AS (SELECT term, count(*) AS df FROM c GROUP BY 1),
t AS (SELECT count(*) AS total FROM documents)"""


_STOP_SQL = ", ".join(f"'{w}'" for w in tf.LISTING_STOP_WORDS)


def _counts(spark, sf):
    """Terms of every document, counted; written once, so that no use reads the texts again."""
    return durable(textops.term_counts(dealt_docs(spark, sf), "doc_id", tf.tokens(F.col("text"))))


def _weights(spark, sf):
    """TF-IDF of every document's terms, written once."""
    counts = _counts(spark, sf)
    weights = durable(textops.tf_idf(counts, "doc_id", _total(spark, sf)).select("doc_id", "term", "weight"))
    discard(counts)
    return weights


def _total(spark, sf):
    return table(spark, sf, "documents").agg(F.count(F.lit(1))).scalar()


def _listing_words():
    return F.filter(
        F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}_]{2,})"), 1),
        lambda w: ~w.isin(*tf.LISTING_STOP_WORDS),
    )


@query("f01_hashed_ngrams")
def f01_hashed_ngrams(spark, sf):
    return textops.hashed_counts(dealt_docs(spark, sf), "doc_id", _listing_words(), (1, 2), 2**27, signed=True)


@query(
    "f01b_hashed_ngram_totals",
    rf"""WITH w AS (SELECT doc_id, len(list_filter(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}'), lambda w: w NOT IN ({_STOP_SQL}))) AS n FROM documents)
SELECT doc_id, CAST(n + greatest(n - 1, 0) + greatest(n - 2, 0) AS BIGINT) AS grams, CAST(1 AS DOUBLE) AS squared_length FROM w WHERE n > 0""",
)
def f01b_hashed_ngram_totals(spark, sf):
    """What the hash function cannot change: the grams of a document and its unit length."""
    h = textops.hashed_counts(dealt_docs(spark, sf), "doc_id", _listing_words(), (1, 2, 3), 2**27, signed=False)
    return rounded(
        h.groupBy("doc_id").agg(
            F.sum("n").alias("grams"), F.sum(F.col("weight") * F.col("weight")).alias("squared_length")
        )
    )


@query(
    "f02_count_vectors",
    f"WITH {_COUNTS_SQL} SELECT doc_id, term, tf FROM c WHERE term IN (SELECT term FROM d, t WHERE df >= 10 AND df <= total * 0.5)",
)
def f02_count_vectors(spark, sf):
    return textops.prune_by_document_frequency(_counts(spark, sf), _total(spark, sf), min_df=10, max_df=0.5)


@query(
    "f02b_largest_vocabulary",
    f"""WITH {_COUNTS_SQL}, v AS (SELECT term FROM c GROUP BY 1 ORDER BY sum(tf) DESC, term LIMIT 500)
SELECT doc_id, term, tf FROM c WHERE term IN (SELECT term FROM v)""",
)
def f02b_largest_vocabulary(spark, sf):
    """Count vectors over the most frequent terms only."""
    return textops.largest_vocabulary(_counts(spark, sf), 500)


@query(
    "f03_tf_idf",
    f"""WITH {_COUNTS_SQL}, x AS (SELECT doc_id, term, tf, tf * (ln((1 + total) / (1 + df)) + 1) AS raw FROM c JOIN d USING (term), t)
SELECT doc_id, term, tf, {fx("raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id))", 6)} AS weight FROM x""",
)
def f03_tf_idf(spark, sf):
    return rounded(textops.tf_idf(_counts(spark, sf), "doc_id", _total(spark, sf)), 6)


@query(
    "f04_idf_extremes",
    f"""WITH {_COUNTS_SQL}, i AS (SELECT term, df, {fx("ln((1 + total) / (1 + df)) + 1", 6)} AS idf FROM d, t)
(SELECT *, 'lowest' AS side FROM i ORDER BY idf, term LIMIT 10) UNION ALL (SELECT *, 'highest' FROM i ORDER BY idf DESC, term LIMIT 10)""",
)
def f04_idf_extremes(spark, sf):
    idf = rounded(textops.inverse_document_frequencies(_counts(spark, sf), _total(spark, sf)), 6)
    low = idf.orderBy("idf", "term").limit(10).withColumn("side", F.lit("lowest"))
    return low.unionAll(idf.orderBy(F.col("idf").desc(), "term").limit(10).withColumn("side", F.lit("highest")))


@query(
    "f05_prune_terms",
    f"WITH {_COUNTS_SQL} SELECT term, df FROM d, t WHERE df >= 3 AND df <= total * 0.2",
)
def f05_prune_terms(spark, sf):
    kept = textops.prune_by_document_frequency(_counts(spark, sf), _total(spark, sf), min_df=3, max_df=0.2)
    return textops.document_frequencies(kept)


@query(
    "f06_shared_terms",
    f"""WITH {_COUNTS_SQL}, s AS (SELECT c.*, {arithmetic_hash_sql('doc_id', 5)} < 600000 AS train FROM c),
k AS (SELECT term FROM s GROUP BY 1 HAVING count(*) FILTER (train) >= 2 AND count(*) FILTER (NOT train) >= 2)
SELECT doc_id, term, tf, CASE WHEN train THEN 'train' ELSE 'test' END AS side FROM s WHERE term IN (SELECT term FROM k)""",
)
def f06_shared_terms(spark, sf):
    counts = _counts(spark, sf)
    train = arithmetic_hash(F.col("doc_id"), 5) < 600_000
    a, b = textops.shared_terms(counts.filter(train), counts.filter(~train), min_df=2)
    return a.withColumn("side", F.lit("train")).unionAll(b.withColumn("side", F.lit("test")))


@query(
    "f07_feature_union",
    f"""WITH {ITEMS_SQL}, l AS (SELECT *, string_split(category, '/') AS p, string_split(name, ' ') AS w FROM items),
f AS (SELECT item_id, 'name=' || unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM l
 UNION ALL SELECT item_id, unnest(CASE WHEN len(p) >= 3 THEN ['category=' || p[1], 'category=' || p[2], 'category=' || p[3], 'category=' || p[1] || '/' || p[2]]
   ELSE ['category=other', 'category=other', 'category=other', 'category=other/other'] END) FROM l
 UNION ALL SELECT item_id, 'brand=' || brand FROM l WHERE brand IS NOT NULL
 UNION ALL SELECT item_id, 'general_condition=' || CASE WHEN len(p) >= 3 THEN p[1] ELSE 'other' END || '_' || condition FROM l
 UNION ALL SELECT item_id, 'has_brand=' || CAST(brand IS NOT NULL AS INT) FROM l
 UNION ALL SELECT item_id, 'shipping=' || shipping FROM l UNION ALL SELECT item_id, 'condition=' || condition FROM l),
c AS (SELECT item_id, feature, count(*) AS n FROM f GROUP BY 1, 2)
SELECT * FROM c WHERE feature IN (SELECT feature FROM c GROUP BY 1 HAVING count(*) >= 2)""",
)
def f07_feature_union(spark, sf):
    return listing.feature_table(items(spark, sf), "item_id", min_df=2)


_F07_SQL = """WITH {items}, l AS (SELECT *, string_split(category, '/') AS p, string_split(name, ' ') AS w FROM items),
 d AS (SELECT item_id, list_filter(string_split(description, ' '), lambda w: w NOT IN ({stop}) AND w <> '') AS s FROM items),
 f AS (SELECT item_id, 'name=' || unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature
   FROM (SELECT item_id, list_filter(w, lambda x: x NOT IN ({stop})) AS w FROM l)
 UNION ALL SELECT item_id, unnest(CASE WHEN len(p) >= 3 THEN ['category=' || p[1], 'category=' || p[2], 'category=' || p[3], 'category=' || p[1] || '/' || p[2]]
   ELSE ['category=other', 'category=other', 'category=other', 'category=other/other'] END) FROM l
 UNION ALL SELECT item_id, 'brand=' || brand FROM l WHERE brand IS NOT NULL
 UNION ALL SELECT item_id, unnest(['general_condition=' || CASE WHEN len(p) >= 3 THEN p[1] ELSE 'other' END || '_' || condition,
   'sub_condition=' || CASE WHEN len(p) >= 3 THEN p[2] ELSE 'other' END || '_' || condition,
   'leaf_condition=' || CASE WHEN len(p) >= 3 THEN p[3] ELSE 'other' END || '_' || condition]) FROM l
 UNION ALL SELECT item_id, 'has_brand=' || CAST(brand IS NOT NULL AS INT) FROM l
 UNION ALL SELECT item_id, 'shipping=' || shipping FROM l UNION ALL SELECT item_id, 'condition=' || condition FROM l
 UNION ALL SELECT item_id, 'description=' || unnest(list_concat(s, list_transform(range(1, len(s)), lambda i: s[i] || ' ' || s[i + 1]),
   list_transform(range(1, len(s) - 1), lambda i: s[i] || ' ' || s[i + 1] || ' ' || s[i + 2]))) FROM d),
c AS (SELECT item_id, feature, count(*) AS n FROM f GROUP BY 1, 2)
SELECT * FROM c WHERE feature IN (SELECT feature FROM c GROUP BY 1 HAVING count(*) >= 2)"""


@query("f07b_all_blocks", _F07_SQL.format(items=ITEMS_SQL, stop=_STOP_SQL))
def f07b_all_blocks(spark, sf):
    """All ten blocks of the listings side by side, the description's n-grams of up to three words among them."""
    return listing.feature_table(items(spark, sf), "item_id", min_df=2, of=listing.all_blocks)


@query("f08_truncated_svd")
def f08_truncated_svd(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    return vectors.truncated_svd(e, "vec_id", "embedding", 5)


@query(
    "f08b_full_width_scores",
    f"SELECT vec_id, {fx('list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))')} AS squared_length FROM embeddings",
)
def f08b_full_width_scores(spark, sf):
    """Over all directions the scores only turn a vector, so its length stays."""
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    scores = vectors.truncated_svd(e, "vec_id", "embedding", 64)
    squares = F.transform(F.array(*[c for c in scores.columns if c != "vec_id"]), lambda x: x * x)
    return rounded(scores.select("vec_id", F.aggregate(squares, F.lit(0.0), lambda a, x: a + x).alias("squared_length")))


@query("f09_kmeans")
def f09_kmeans(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    return vectors.kmeans(e, "vec_id", "embedding", 10, seed=7)


@query(
    "f09b_nearest_centroid",
    f"""WITH x AS (SELECT vec_id, label, unnest(embedding) AS v, unnest(range(1, 65)) AS i FROM embeddings),
m AS (SELECT label AS c, i, avg(CAST(v AS DOUBLE)) AS m FROM x GROUP BY 1, 2),
s AS (SELECT vec_id, c, sum((v - m) ** 2) AS dist FROM x JOIN m USING (i) GROUP BY 1, 2)
SELECT vec_id, c AS centroid, {fx("sqrt(dist)", 5)} AS distance FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(dist, 9), c) = 1""",
)
def f09b_nearest_centroid(spark, sf):
    """Assignment to given centres, here the mean vector of each label."""
    e = table(spark, sf, "embeddings")
    centres = vectors.group_means(e, "label", "embedding", 64)
    return rounded(vectors.nearest_centroid(e, "vec_id", "embedding", centres), 5)


@query("f09c_cluster_terms")
def f09c_cluster_terms(spark, sf):
    """K-means on hashed TF-IDF vectors of the documents and the heaviest terms of each cluster."""
    counts = _counts(spark, sf)
    weights = textops.tf_idf(counts, "doc_id", _total(spark, sf))
    clusters = vectors.text_clusters(docs(spark, sf), "doc_id", tf.tokens(F.col("text")), 8, seed=7)
    return vectors.cluster_terms(weights, clusters, "doc_id", 10)


@query("f09d_sparse_clusters")
def f09d_sparse_clusters(spark, sf):
    """30 clusters of the documents by mini-batch k-means on their TF-IDF, and the heaviest terms of each."""
    weights = _weights(spark, sf)
    assigned = clusters.nearest(weights, clusters.fit(weights, "doc_id", 30, seed=7), "doc_id")
    return vectors.cluster_terms(weights, assigned.select("doc_id", "cluster"), "doc_id", 10)


@query(
    "f09e_nearest_sparse_centre",
    f"""WITH {_COUNTS_SQL}, x AS (SELECT doc_id, term, tf * (ln((1 + total) / (1 + df)) + 1) AS raw FROM c JOIN d USING (term), t),
u AS MATERIALIZED (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM x),
n AS (SELECT source, count(*) AS n FROM documents GROUP BY 1),
m AS MATERIALIZED (SELECT source AS cluster, term, sum(weight) / max(n) AS value FROM u JOIN documents USING (doc_id) JOIN n USING (source) GROUP BY 1, 2),
r AS (SELECT cluster, sum(value * value) AS norm FROM m GROUP BY 1), i AS (SELECT doc_id, sum(weight * weight) AS own FROM u GROUP BY 1),
k AS (SELECT doc_id, cluster, sum(weight * value) AS dot FROM u JOIN m USING (term) GROUP BY 1, 2),
s AS (SELECT doc_id, cluster, own, round(norm - 2 * coalesce(dot, 0), 9) AS score FROM i CROSS JOIN r LEFT JOIN k USING (doc_id, cluster))
SELECT doc_id, cluster, {fx("sqrt(greatest(0, own + score))", 5)} AS distance FROM s
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score, cluster) = 1""",
)
def f09e_nearest_sparse_centre(spark, sf):
    """The source whose mean TF-IDF is nearest to each document's."""
    weights = _weights(spark, sf)
    sources = docs(spark, sf).select("doc_id", F.col("source").alias("cluster")).where("cluster IS NOT NULL")
    centres = durable(clusters.means(weights, sources, "doc_id"))
    blocks = packed(weights, "doc_id")
    discard(weights)
    return rounded(clusters.nearest(blocks, centres, "doc_id"), 5)


def _grams():
    """Single words and pairs of neighbours."""
    return F.concat(F.col("_w"), tf.ngrams(F.col("_w"), 2))


def _gram_counts(spark, sf, min_df):
    staged = dealt_docs(spark, sf).select("doc_id", tf.tokens(F.col("text")).alias("_w"))
    counts = durable(textops.term_counts(staged, "doc_id", _grams()))
    kept = durable(textops.prune_by_document_frequency(counts, _total(spark, sf), min_df=min_df, max_df=1.0))
    discard(counts)  # most pairs are in one or two documents
    return kept


@query("f08c_tf_idf_svd")
def f08c_tf_idf_svd(spark, sf):
    """The documents on the 30 leading axes of their TF-IDF over words and pairs of at least ten documents."""
    weights = textops.tf_idf(_gram_counts(spark, sf, 10), "doc_id", _total(spark, sf))
    scores, _, values = decompose.truncated_svd(weights, "doc_id", 30)
    return scores.select("doc_id", *[F.get("v", F.lit(i)).alias(f"component_{i + 1}") for i in range(len(values))])


def _topics(spark, sf):
    return topics.fit(_gram_counts(spark, sf, 4), "doc_id", 20, passes=20, seed=7)


@query("f10_lda_topics")
def f10_lda_topics(spark, sf):
    """20 topics over words and pairs, by 20 passes over all documents."""
    return _topics(spark, sf).top_terms(10)


@query("f10b_lda_documents")
def f10b_lda_documents(spark, sf):
    return _topics(spark, sf).dominant("doc_id")


@query(
    "f11_bm25",
    f"""WITH d AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents), n AS (SELECT count(*) AS total, avg(len(w)) AS avgdl FROM d),
q AS (SELECT item_id, term, count(*) AS qtf FROM (SELECT item_id, unnest({WORDS_SQL}) AS term FROM benchmark) GROUP BY 1, 2),
p AS (SELECT doc_id, dl, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS dl, unnest(w) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY 1, 2, 3),
f AS (SELECT term, count(*) AS df FROM p GROUP BY 1),
s AS (SELECT item_id, doc_id, sum(qtf * ln(1 + (total - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / avgdl))) AS score
 FROM q JOIN p USING (term) JOIN f USING (term), n GROUP BY 1, 2)
SELECT item_id, doc_id, {fx("score", 5)} AS score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id) AS INT) AS rank
FROM s QUALIFY rank <= 10""",
)
def f11_bm25(spark, sf):
    q = table(spark, sf, "benchmark")
    return rounded(textops.bm25(dealt_docs(spark, sf), "doc_id", words(), q, "item_id", words(), 10), 5)
