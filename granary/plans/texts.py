"""Text queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from granary.functions import text as tf
from granary.functions.distance import edit_distance
from granary.functions.numeric import correlation, fixed
from granary.operators import text as textops
from granary.operators.skew import attach
from granary.plans.aggregates import rounded
from granary.plans.registry import fx, query
from granary.plans.tables import ITEMS_SQL, items, table

_STOP = ", ".join("'" + w.replace("'", "''") + "'" for w in tf.STOP_WORDS)
_NOISE = tf.NOISE.replace("'", "''")


def clean_sql(least):
    """Cleaned words of ``documents.text`` with at least ``least`` letters."""
    return (
        f"list_filter(string_split(regexp_replace(lower(text), '{_NOISE}', ' ', 'g'), ' '), "
        f"lambda w: length(w) >= {least} AND w NOT IN ({_STOP}))"
    )


TOKENS_SQL = f"list_filter({clean_sql(3)}, lambda w: regexp_matches(w, '[a-z]'))"


def words():
    return F.regexp_extract_all(F.lower("text"), F.lit("(\\p{L}+)"), 1)


WORDS_SQL = "regexp_extract_all(lower(text), '\\p{L}+')"


def docs(spark, sf, *columns):
    d = table(spark, sf, "documents")
    return d.select(*(columns or ("doc_id", "text", "lang", "source", "n_chars")))


#: Documents of a part, before their words become features.
PER_PART = 500


def dealt_docs(spark, sf):
    """doc_id and text, dealt out: one file of few row groups would leave the words of all to a few tasks."""
    d = docs(spark, sf, "doc_id", "text")
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(d.count() / PER_PART))
    return d.repartition(parts, "doc_id", "text")


@query(
    "t01_compose_text",
    f"""WITH {ITEMS_SQL} SELECT item_id, lower(coalesce(name, '')) || ' ' || lower(coalesce(brand, '')) || ' ' || lower(coalesce(description, ''))
 || ' ' || lower(coalesce(category, '')) AS composed FROM items""",
)
def t01_compose_text(spark, sf):
    parts = [F.col(c) for c in ("name", "brand", "description", "category")]
    return items(spark, sf).select("item_id", tf.compose(*parts).alias("composed"))


@query(
    "t02_normalise_units",
    rf"""WITH {ITEMS_SQL} SELECT item_id, regexp_replace(regexp_replace(description, '{tf.CARATS}', '\1k\4', 'g'), '{tf.UNITS}', '\1\2\3', 'g') AS description FROM items""",
)
def t02_normalise_units(spark, sf):
    return items(spark, sf).select("item_id", tf.normalise_units(F.col("description")).alias("description"))


@query(
    "t02b_normalise_units_in_documents",
    rf"""SELECT doc_id, regexp_replace(regexp_replace(lower(text), '{tf.CARATS}', '\1k\4', 'g'), '{tf.UNITS}', '\1\2\3', 'g') AS text FROM documents""",
)
def t02b_normalise_units_in_documents(spark, sf):
    return docs(spark, sf).select("doc_id", tf.normalise_units(F.lower("text")).alias("text"))


@query(
    "t03_path_levels",
    f"""WITH {ITEMS_SQL}, l AS (SELECT item_id, string_split(category, '/') AS p FROM items)
SELECT item_id, CASE WHEN len(p) >= 3 THEN p[1] ELSE 'other' END AS level_1, CASE WHEN len(p) >= 3 THEN p[2] ELSE 'other' END AS level_2,
 CASE WHEN len(p) >= 3 THEN p[3] ELSE 'other' END AS level_3, CASE WHEN len(p) >= 3 THEN p[1] || '/' || p[2] ELSE 'other/other' END AS pair FROM l""",
)
def t03_path_levels(spark, sf):
    levels = tf.path_levels(F.col("category"))
    return items(spark, sf).select(
        "item_id",
        *[e.alias(f"level_{i}") for i, e in enumerate(levels, 1)],
        tf.path_pair(F.col("category")).alias("pair"),
    )


@query("t04_word_count", f"SELECT doc_id, CAST(len({clean_sql(4)}) AS INT) AS words FROM documents")
def t04_word_count(spark, sf):
    return docs(spark, sf).select("doc_id", tf.word_count(F.col("text")).alias("words"))


@query("t05_tokens", f"SELECT doc_id, array_to_string({TOKENS_SQL}, ' ') AS tokens FROM documents")
def t05_tokens(spark, sf):
    return docs(spark, sf).select("doc_id", F.array_join(tf.tokens(F.col("text")), " ").alias("tokens"))


@query(
    "t06_token_lengths",
    r"SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS INT) AS blank_tokens, CAST(length(text) AS INT) AS chars FROM documents",
)
def t06_token_lengths(spark, sf):
    return docs(spark, sf).select(
        "doc_id", tf.blank_token_count(F.col("text")).alias("blank_tokens"), F.length("text").alias("chars")
    )


@query(
    "t07_length_correlation",
    f"""WITH d AS (SELECT lang, CASE WHEN source <> 'src3' THEN length(text) END AS x, CASE WHEN source <> 'src3' THEN quality END AS y
 FROM documents JOIN labels USING (doc_id))
SELECT lang, {fx("covar_pop(x, y) / nullif(stddev_pop(x) * stddev_pop(y), 0)")} AS corr, count(x) AS n FROM d GROUP BY lang""",
)
def t07_length_correlation(spark, sf):
    """Texts of one source stand for "no description" and become missing first."""
    d = docs(spark, sf, "doc_id", "lang", "source", F.length("text").alias("chars"))
    j = d.join(table(spark, sf, "labels"), "doc_id")
    length = F.when(F.col("source") != "src3", F.col("chars"))
    return j.groupBy("lang").agg(
        fixed(correlation(length, F.col("quality"))).alias("corr"), F.count(length).alias("n")
    )


@query(
    "t08_contains_share",
    f"""WITH {ITEMS_SQL} SELECT condition, count(*) AS n, {fx("avg(CASE WHEN contains(name, brand) THEN 1.0 ELSE 0.0 END)")} AS share
FROM items WHERE brand IS NOT NULL GROUP BY condition""",
)
def t08_contains_share(spark, sf):
    i = items(spark, sf).filter(F.col("brand").isNotNull())
    hit = F.contains(F.col("name"), F.col("brand")).cast("double")
    return rounded(i.groupBy("condition").agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("share")))


@query(
    "t09_domain_parts",
    """WITH h AS (SELECT page_id, string_split(split_part(split_part(url, '//', 2), '/', 1), '.') AS p FROM pages)
SELECT page_id, p[2] AS second_label, p[-1] AS last_label FROM h""",
)
def t09_domain_parts(spark, sf):
    p = table(spark, sf, "pages").select("page_id", tf.host_labels(F.col("url")).alias("p"))
    return p.select(
        "page_id", F.try_element_at("p", F.lit(2)).alias("second_label"), F.element_at("p", -1).alias("last_label")
    )


@query(
    "t10_citation_year",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000""",
)
def t10_citation_year(spark, sf):
    year = F.year("o_orderdate").cast("string")
    text = F.concat(F.lit("Vol. "), F.col("o_orderkey").cast("string"), F.lit(", "))
    odd = F.col("o_orderkey") % 2 == 1
    citation = F.when(odd, F.concat(text, F.lit("("), year, F.lit(")"))).otherwise(F.concat(text, year))
    o = table(spark, sf, "orders").select("o_orderkey", tf.citation_year(citation).alias("year"))
    return o.filter(F.col("year").between(1996, 2000))


@query(
    "t11_edit_distance",
    """SELECT p_partkey, CAST(damerau_levenshtein(split_part(p_name, ' ', 1), split_part(p_name, ' ', 2)) AS INT) AS words_apart,
 CAST(damerau_levenshtein(lower(p_type), lower(p_brand)) AS INT) AS type_from_brand FROM part""",
)
def t11_edit_distance(spark, sf):
    parts = F.split("p_name", " ")
    return table(spark, sf, "part").select(
        "p_partkey",
        edit_distance(parts[0], parts[1]).alias("words_apart"),
        edit_distance(F.lower("p_type"), F.lower("p_brand")).alias("type_from_brand"),
    )


def _ngram_sql(n):
    grams = f"list_transform(range(1, len(t) - {n - 2}), lambda i: array_to_string(t[i:i + {n - 1}], ' '))" if n > 1 else "t"
    return f"""WITH w AS (SELECT {TOKENS_SQL} AS t FROM documents), g AS (SELECT unnest({grams}) AS ngram FROM w)
SELECT ngram, count(*) AS n FROM g GROUP BY 1 ORDER BY n DESC, ngram LIMIT 25"""


def _ngrams(n):
    @query(f"t12_ngrams_{n}", _ngram_sql(n))
    def run(spark, sf):
        return textops.ngram_frequencies(docs(spark, sf), tf.tokens(F.col("text")), n, 25)

    return run


t12_ngrams_1, t12_ngrams_2, t12_ngrams_3 = _ngrams(1), _ngrams(2), _ngrams(3)


@query(
    "t13_keyword_in_context",
    f"""WITH w AS (SELECT doc_id, {WORDS_SQL} AS t FROM documents), p AS (SELECT doc_id, t, unnest(range(1, len(t))) AS i FROM w)
SELECT doc_id, CAST(i AS INT) AS position, array_to_string(t[greatest(i - 5, 1):i - 1], ' ') AS before, array_to_string(t[i:i + 1], ' ') AS keyword,
 array_to_string(t[i + 2:i + 6], ' ') AS after FROM p WHERE t[i] = 'of' AND t[i + 1] = 'the'""",
)
def t13_keyword_in_context(spark, sf):
    return textops.keyword_in_context(docs(spark, sf), "doc_id", words(), ["of", "the"], 5)


@query(
    "t14_id_sequences",
    f"""WITH w AS (SELECT doc_id, {WORDS_SQL} AS t FROM documents), v AS (SELECT term, count(*) AS n FROM (SELECT unnest(t) AS term FROM w) GROUP BY 1),
ids AS (SELECT term, row_number() OVER (ORDER BY n DESC, term) AS id FROM v),
p AS (SELECT doc_id, t, len(t) AS m, unnest(range(greatest(len(t) - 19, 1), len(t) + 1)) AS i FROM w),
s AS (SELECT doc_id, m, list(id ORDER BY i) AS s FROM p JOIN ids ON t[i] = term GROUP BY 1, 2)
SELECT doc_id, CAST(m AS INT) AS full_length, repeat('0 ', 20 - len(s)) || array_to_string(s, ' ') AS sequence FROM s""",
)
def t14_id_sequences(spark, sf):
    d = docs(spark, sf)
    ids = textops.vocabulary_ids(d, words())
    seq = textops.id_sequences(d, "doc_id", words(), ids, 20)
    return seq.withColumn("sequence", F.array_join("sequence", " "))


@query(
    "t14b_vocabulary_ids",
    f"""WITH v AS (SELECT term, count(*) AS n FROM (SELECT unnest({WORDS_SQL}) AS term FROM documents) GROUP BY 1)
SELECT term, row_number() OVER (ORDER BY n DESC, term) AS word_id, n FROM v""",
)
def t14b_vocabulary_ids(spark, sf):
    return textops.vocabulary_ids(docs(spark, sf), words())


@query(
    "t14c_longest_sequence",
    f"SELECT lang, CAST(max(len({WORDS_SQL})) AS INT) AS longest FROM documents GROUP BY 1",
)
def t14c_longest_sequence(spark, sf):
    return docs(spark, sf).groupBy("lang").agg(F.max(F.size(words())).alias("longest"))


@query(
    "t15_common_words",
    f"""WITH w AS (SELECT lang, unnest({TOKENS_SQL}) AS term FROM documents), c AS (SELECT lang, term, count(*) AS n FROM w GROUP BY 1, 2)
SELECT lang, term, n, CAST(row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) AS INT) AS rank FROM c QUALIFY rank <= 20""",
)
def t15_common_words(spark, sf):
    counts = textops.group_term_counts(docs(spark, sf), ["lang"], tf.tokens(F.col("text")))
    return textops.top_terms(counts, ["lang"], "n", 20)


@query(
    "t15b_common_words_overall",
    f"""WITH w AS (SELECT unnest({TOKENS_SQL}) AS term FROM documents)
SELECT term, count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, term LIMIT 20""",
)
def t15b_common_words_overall(spark, sf):
    return textops.ngram_frequencies(docs(spark, sf), tf.tokens(F.col("text")), 1, 20).withColumnRenamed("ngram", "term")


@query(
    "t16_mean_by_length",
    rf"""SELECT CAST(len(regexp_extract_all(text, '\S+')) AS INT) AS length, count(*) AS n, {fx("avg(quality)")} AS mean_quality
FROM documents JOIN labels USING (doc_id) GROUP BY 1""",
)
def t16_mean_by_length(spark, sf):
    d = docs(spark, sf, "doc_id", tf.blank_token_count(F.col("text")).alias("length"))
    j = d.join(table(spark, sf, "labels"), "doc_id")
    return rounded(j.groupBy("length").agg(F.count(F.lit(1)).alias("n"), F.avg("quality").alias("mean_quality")))


@query(
    "t17_tokens_summary",
    rf"""WITH t AS (SELECT source, lang, len(regexp_extract_all(text, '\S+')) AS n FROM documents)
SELECT source, lang, count(*) AS docs, CAST(min(n) AS INT) AS least, {fx("median(n)")} AS middle, CAST(max(n) AS INT) AS most FROM t GROUP BY 1, 2""",
)
def t17_tokens_summary(spark, sf):
    from granary.operators.quantiles import exact_quantiles

    t = docs(spark, sf, "source", "lang", tf.blank_token_count(F.col("text")).alias("n"))
    ends = t.groupBy("source", "lang").agg(
        F.count(F.lit(1)).alias("docs"), F.min("n").alias("least"), F.max("n").alias("most")
    )
    return rounded(attach(ends, exact_quantiles(t, ["source", "lang"], {"n": {"middle": 0.5}}), ["source", "lang"]))


@query(
    "k01_json_keys",
    """SELECT event_id, coalesce(CAST(json_extract(props, '$.k') AS DOUBLE), 0.0) AS k, CAST(0 AS DOUBLE) AS absent,
 json_extract_string(props, '$.k') AS k_text, CAST(NULL AS VARCHAR) AS absent_text FROM events""",
)
def k01_json_keys(spark, sf):
    """Keys of the stored documents, read through the single-quoted dictionary dialect."""
    e = table(spark, sf, "events").select("event_id", F.replace("props", F.lit('"'), F.lit("'")).alias("d"))
    j = tf.literal_to_json(F.col("d"))
    return e.select(
        "event_id",
        tf.json_number(j, "k").alias("k"),
        tf.json_number(j, "nothing").alias("absent"),
        tf.json_text(j, "k").alias("k_text"),
        tf.json_text(j, "nothing").alias("absent_text"),
    )


LANGUAGES = {"en": "English", "fr": "French", "de": "German", "es": "Spanish"}


def label_sets(df):
    """Label names of a document: its language, and a second label for long texts."""
    names = F.create_map(*[x for k, v in LANGUAGES.items() for x in (F.lit(k), F.lit(v))])
    codes = F.when(F.length("text") > 2000, F.array(F.col("lang"), F.lit("long"))).otherwise(F.array(F.col("lang")))
    return F.transform(codes, lambda c: F.coalesce(names[c], c))


@query(
    "v01_label_one_hot",
    "SELECT doc_id, "
    + ", ".join(f"CASE WHEN lang = '{k}' THEN 1 ELSE 0 END AS is_{v.lower()}" for k, v in LANGUAGES.items())
    + ", CASE WHEN length(text) > 2000 THEN 1 ELSE 0 END AS is_long FROM documents",
)
def v01_label_one_hot(spark, sf):
    d = docs(spark, sf)
    d = d.select("doc_id", label_sets(d).alias("labels"))
    return d.select(
        "doc_id",
        *[F.array_contains("labels", v).cast("int").alias(f"is_{v.lower()}") for v in [*LANGUAGES.values(), "long"]],
    )
