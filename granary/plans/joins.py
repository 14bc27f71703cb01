"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.numeric import fixed
from granary.operators import fuzzy, relational, rollup, windowing
from granary.operators.text import vocabulary
from granary.plans.aggregates import MONTH_SPEC, PREPARED_SQL, RECENT, _spec_sql, months_sql, rounded
from granary.plans.registry import fx, query
from granary.plans.tables import AS_OF, DAILY_SQL, ITEMS_SQL, PANEL_SQL, SESSIONS_SQL, daily, items, panel, table, txns
from granary.plans.texts import docs
from granary.session import durable


def _side_sql(name, where):
    spec = _spec_sql(rollup.CARD_SPEC, f"{name}_")
    return f"{name} AS (SELECT card, count(*) AS {name}_transactions_count, {spec} FROM prepared WHERE {where} GROUP BY card)"


# pairs of the successive aggregates, fixed values
SUCCESSIVE = (("category_1", "amount"), ("installments", "amount"), ("city", "amount"), ("category_1", "installments"))


def _successive_sql(i, first, second):
    m = f"{first}_{second}"
    return f"""s{i} AS (SELECT card, {fx("avg(m)")} AS {m}_mean, {fx("min(m)")} AS {m}_min, {fx("max(m)")} AS {m}_max,
  {fx("stddev_samp(m)")} AS {m}_std FROM (SELECT card, {first}, avg({second}) AS m FROM recent GROUP BY 1, 2) GROUP BY card)"""


@query(
    "j01_card_features",
    f"""WITH {PREPARED_SQL}, recent AS (SELECT * FROM prepared WHERE month_lag >= {RECENT}),
approved AS (SELECT * FROM prepared WHERE month_lag < {RECENT} AND authorized = 1),
{_side_sql("denied", f"month_lag < {RECENT} AND authorized = 0")}, {_side_sql("auth", f"month_lag < {RECENT} AND authorized = 1")},
{_side_sql("new", f"month_lag >= {RECENT}")},
am AS (SELECT card, {fx("avg(authorized)")} AS authorized_mean FROM txns WHERE month_lag < {RECENT} GROUP BY card),
{months_sql("approved")}, {", ".join(_successive_sql(i, *pair) for i, pair in enumerate(SUCCESSIVE))}
SELECT c_custkey AS card, c_mktsegment AS feature, {fx("c_acctbal", 2)} AS target, am.* EXCLUDE (card), denied.* EXCLUDE (card),
  auth.* EXCLUDE (card), new.* EXCLUDE (card), months.* EXCLUDE (card), {", ".join(f"s{i}.* EXCLUDE (card)" for i in range(len(SUCCESSIVE)))}
FROM customer {" ".join(f"LEFT JOIN {t} ON c_custkey = {t}.card" for t in ("am", "denied", "auth", "new", "months", *(f"s{i}" for i in range(len(SUCCESSIVE)))))}""",
)
def j01_card_features(spark, sf):
    """The whole card feature table: roll-ups of three populations, monthly and successive aggregates.

    The joined facts are written once; every part reads the written table.
    """
    facts = durable(rollup.prepare_transactions(txns(spark, sf), AS_OF))
    entity = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("card"), F.col("c_mktsegment").alias("feature"), F.col("c_acctbal").alias("target")
    )
    old, approved = F.col("month_lag") < RECENT, F.col("authorized") == 1
    side = F.when(~old, "new").when(approved, "auth").otherwise("denied")
    sides = rollup.aggregate_split(facts, side, ("auth", "denied", "new"))
    yes, no = (F.coalesce(f"{side}_transactions_count", F.lit(0)) for side in ("auth", "denied"))
    # the share of approved purchases follows from the two counts, without another pass
    sides = sides.withColumn("authorized_mean", F.try_divide(yes, yes + no))
    monthly = rollup.aggregate_per_period(facts.filter(old & approved), "card", "month_lag", MONTH_SPEC)
    successive = [rollup.successive_aggregates(facts.filter(~old), "card", *pair) for pair in SUCCESSIVE]
    out = relational.join_features(entity, [sides, monthly, *successive], "card")
    return rounded(out.withColumn("target", fixed(F.col("target"), 2)))


@query(
    "j02_star_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate, p_brand AS part_p_brand, s_name AS supp_s_name,
 c_mktsegment AS cust_c_mktsegment FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
 LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN customer ON o_custkey = c_custkey""",
)
def j02_star_join(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    out = relational.star_join(
        li,
        [
            (o, {"l_orderkey": "o_orderkey"}, "ord_"),
            (table(spark, sf, "part").select("p_partkey", "p_brand"), {"l_partkey": "p_partkey"}, "part_"),
            (table(spark, sf, "supplier").select("s_suppkey", "s_name"), {"l_suppkey": "s_suppkey"}, "supp_"),
            (table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), {"ord_o_custkey": "c_custkey"}, "cust_"),
        ],
    )
    return out.withColumnRenamed("ord_o_orderdate", "o_orderdate").drop("ord_o_custkey")


@query(
    "j02b_star_join_fan_out",
    """WITH cal AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS kind FROM orders)
SELECT event_id, kind AS cal_kind FROM events LEFT JOIN cal ON CAST(ts AS DATE) - INTERVAL 9132 DAY = cal.d""",
)
def j02b_star_join_fan_out(spark, sf):
    """Several calendar rows per date repeat the fact, as with several holidays on one day."""
    # January 2024 is moved back 9132 days (25 years) onto the range of the orders
    e = table(spark, sf, "events").select("event_id", F.date_sub(F.to_date("ts"), 9132).alias("day"))
    o = table(spark, sf, "orders")
    cal = o.select(F.to_date("o_orderdate").alias("d"), F.col("o_orderpriority").alias("kind")).distinct()
    return relational.star_join(e, [(cal, {"day": "d"}, "cal_")]).drop("day")


YEARS = range(1995, 2002)


def _year_sql(y):
    return f"(SELECT CAST(month(o_orderdate) AS INT) AS m, avg(o_totalprice) AS v FROM orders WHERE year(o_orderdate) = {y} GROUP BY 1) t{y}"


@query(
    "j03_year_chain",
    f"""SELECT t{YEARS[0]}.m AS month, {", ".join(f"{fx(f't{y}.v', 3)} AS y{y}" for y in YEARS)} FROM {_year_sql(YEARS[0])}
 {" ".join(f"JOIN {_year_sql(y)} ON t{YEARS[0]}.m = t{y}.m" for y in YEARS[1:])}""",
)
def j03_year_chain(spark, sf):
    # a pivot reads the facts once where a chain of joins would read them once per year;
    # months missing in any year drop out, as with inner joins
    o = table(spark, sf, "orders").select(
        F.month("o_orderdate").alias("month"), F.concat(F.lit("y"), F.year("o_orderdate")).alias("y"), "o_totalprice"
    )
    wide = o.groupBy("month").pivot("y", [f"y{y}" for y in YEARS]).agg(F.avg("o_totalprice"))
    return rounded(wide.dropna(), 3)


@query(
    "j04_template_join",
    f"""SELECT c_custkey AS custkey, {fx("coalesce(total, 0)", 2)} AS total FROM
 (SELECT o_custkey, sum(o_totalprice) AS total FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) RIGHT JOIN customer ON o_custkey = c_custkey""",
)
def j04_template_join(spark, sf):
    o = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    totals = o.groupBy(F.col("o_custkey").alias("custkey")).agg(F.sum("o_totalprice").alias("total"))
    required = table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))
    return rounded(relational.to_template(required, totals, "custkey", {"total": 0.0}), 2)


@query(
    "j05_overlay",
    f"""WITH patch AS (SELECT o_custkey, max(o_totalprice) / 100 AS v FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1)
SELECT c_custkey, {fx("coalesce(v, c_acctbal)")} AS c_acctbal FROM customer LEFT JOIN patch ON o_custkey = c_custkey""",
)
def j05_overlay(spark, sf):
    o = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    patch = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg((F.max("o_totalprice") / 100).alias("c_acctbal"))
    return rounded(relational.overlay(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), patch, "c_custkey", "c_acctbal"))


@query("j06_semi_join", "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def j06_semi_join(spark, sf):
    good = table(spark, sf, "labels").filter("quality = 1")
    return table(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(good, "doc_id", "left_semi")


@query("j06b_anti_join", "SELECT doc_id, lang, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j06b_anti_join(spark, sf):
    return table(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(table(spark, sf, "labels"), "doc_id", "left_anti")


@query(
    "j07_keyed_concat",
    f"""WITH {SESSIONS_SQL} SELECT e.event_id, e.event_type, e.value, s.hits, s.pageviews
FROM events e JOIN sessions s ON e.event_id = s.session_id""",
)
def j07_keyed_concat(spark, sf):
    # the columns of the JSON document join their own row in place: no join is needed
    e = table(spark, sf, "events")
    j = F.from_json("props", "k INT")
    return e.select(
        "event_id",
        "event_type",
        "value",
        F.coalesce(j["k"], F.lit(0)).alias("hits"),
        F.floor(F.coalesce(j["k"], F.lit(0)) / 4).cast("int").alias("pageviews"),
    )


@query(
    "j08_map_values",
    f"""WITH d AS (SELECT c_mktsegment AS s, avg(c_acctbal) AS code FROM customer WHERE c_acctbal > 0 GROUP BY 1)
SELECT c_custkey, {fx("code")} AS segment_code FROM customer LEFT JOIN d ON s = c_mktsegment""",
)
def j08_map_values(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    codes = c.filter("c_acctbal > 0").groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("code"))
    out = relational.map_values(c, "c_mktsegment", codes, "c_mktsegment", "code", "segment_code")
    return rounded(out.select("c_custkey", "segment_code"))


@query(
    "j09_calendar_spine",
    f"""WITH {DAILY_SQL}, busy AS (SELECT d, y FROM daily WHERE isodow(d) < 6),
spine AS (SELECT CAST(unnest(generate_series((SELECT min(d) FROM busy), (SELECT max(d) FROM busy), INTERVAL 1 DAY)) AS DATE) AS d)
SELECT spine.d, {fx("y", 2)} AS y FROM spine LEFT JOIN busy ON spine.d = busy.d""",
)
def j09_calendar_spine(spark, sf):
    busy = daily(spark, sf).filter(F.weekday("d") < 5).select("d", "y")
    return rounded(relational.calendar_spine(busy, "d").join(busy, "d", "left"), 2)


# pattern of one token of a listing text (fixed value)
BRAND_WORD = r"[a-z0-9*/+\-'’?!.,|&%®™ôèéü]+"


@query(
    "j10_fill_brand",
    rf"""WITH {ITEMS_SQL}, two AS (SELECT item_id, CASE WHEN brand IS NOT NULL THEN
  CASE WHEN item_id % 3 = 0 THEN split_part(category, '/', 1) || ' ' || brand ELSE brand END END AS brand,
  CASE WHEN item_id % 4 = 0 AND category IS NOT NULL THEN split_part(category, '/', 1) || ' ' || split_part(category, '/', 2) || ' ' || name ELSE name END AS name,
  description FROM items),
known AS (SELECT DISTINCT brand FROM two WHERE brand IS NOT NULL),
gaps AS (SELECT * FROM two WHERE brand IS NULL),
c AS (SELECT item_id, 0 AS r, 0 AS p, regexp_extract(name, '^{BRAND_WORD.replace("'", "''")}\s{BRAND_WORD.replace("'", "''")}') AS t FROM gaps
  UNION ALL SELECT item_id, 1, 0, regexp_extract(description, '^{BRAND_WORD.replace("'", "''")}\s{BRAND_WORD.replace("'", "''")}') FROM gaps
  UNION ALL SELECT item_id, 2, p, w[p] FROM (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS p FROM (SELECT item_id, regexp_extract_all(name, '{BRAND_WORD.replace("'", "''")}') AS w FROM gaps))
  UNION ALL SELECT item_id, 3, p, w[p] FROM (SELECT item_id, w, unnest(range(1, len(w) + 1)) AS p FROM (SELECT item_id, regexp_extract_all(description, '{BRAND_WORD.replace("'", "''")}') AS w FROM gaps))),
hit AS (SELECT item_id, arg_min(t, r * 1000000 + p) AS t FROM c JOIN known ON t = known.brand GROUP BY 1)
SELECT two.item_id, coalesce(brand, t) AS brand FROM two LEFT JOIN hit ON two.item_id = hit.item_id""",
)
def j10_fill_brand(spark, sf):
    i = items(spark, sf)
    path = F.split("category", "/")
    pair = F.when(F.col("item_id") % 3 == 0, F.concat_ws(" ", path[0], "brand")).otherwise(F.col("brand"))
    staged = i.select(
        "item_id",
        F.when(F.col("brand").isNotNull() & F.when(F.col("item_id") % 3 == 0, F.col("category").isNotNull()).otherwise(F.lit(True)), pair).alias("brand"),
        F.when(
            (F.col("item_id") % 4 == 0) & F.col("category").isNotNull(), F.concat_ws(" ", path[0], path[1], "name")
        )
        .otherwise(F.col("name"))
        .alias("name"),
        "description",
    )
    return relational.fill_from_dictionary(staged, "item_id", "brand", ["name", "description"], BRAND_WORD).select("item_id", "brand")


@query(
    "j11_lagged_join",
    f"""WITH {PANEL_SQL} SELECT d, nation, segment, {fx("y", 2)} AS y,
 {fx("lag(y) OVER (PARTITION BY nation, segment ORDER BY d)", 2)} AS y_lag1 FROM panel""",
)
def j11_lagged_join(spark, sf):
    return rounded(windowing.lags(panel(spark, sf), ["nation", "segment"], "d", "y", 1), 2)


@query(
    "j12_country_lookup",
    """SELECT s_suppkey, s_name, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
 LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def j12_country_lookup(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf, "nation")
    named = n.join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return s.join(named, F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", "s_name", "n_name", "r_name")


_VOCAB_SQL = """v AS MATERIALIZED (SELECT w AS term, count(*) AS n FROM
 (SELECT unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS w FROM documents) GROUP BY 1)"""


def _one_edit_sql(words):
    """Distinct words at most one edit apart from vocabulary terms, by the positions of the deleted letters."""
    deleted = (
        "SELECT {c}, {c} AS d, 0 AS i FROM {t} UNION ALL SELECT {c}, substr({c}, 1, i - 1) || substr({c}, i + 1), i FROM "
        "(SELECT {c}, unnest(range(1, length({c}) + 1)) AS i FROM {t} WHERE length({c}) > 1)"
    )
    return f"""WITH {_VOCAB_SQL}, q AS MATERIALIZED ({words}),
dv AS MATERIALIZED ({deleted.format(c="term", t="v")}), dq AS MATERIALIZED ({deleted.format(c="word", t="q")}),
pairs AS MATERIALIZED (SELECT word, term, min(CASE WHEN word = term THEN 0 WHEN dq.i = 0 OR dv.i = 0 OR dq.i = dv.i THEN 1
  WHEN dv.i = dq.i + 1 AND substr(word, dq.i, 1) = substr(term, dv.i, 1) AND substr(word, dv.i, 1) = substr(term, dq.i, 1) THEN 1
  ELSE 2 END) AS dist FROM dq JOIN dv ON dq.d = dv.d GROUP BY ALL),
r AS (SELECT word, term AS suggestion, n AS frequency, CAST(dist AS INT) AS distance FROM pairs JOIN v USING (term) WHERE dist <= 1)"""


@query(
    "j13_fuzzy_pairs",
    _one_edit_sql("SELECT DISTINCT unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS word FROM benchmark")
    + " SELECT * FROM r",
)
def j13_fuzzy_pairs(spark, sf):
    """Words of the questions against the vocabulary of all documents, one edit apart at most."""
    v = durable(vocabulary(docs(spark, sf), "text", r"\p{L}+"))  # read for the pairs and for the frequencies
    q = vocabulary(table(spark, sf, "benchmark"), "text", r"\p{L}+").select(F.col("term").alias("word"))
    pairs = fuzzy.fuzzy_pairs(q, "word", v, "term", 1)
    return pairs.join(v, "term").select("word", F.col("term").alias("suggestion"), F.col("n").alias("frequency"), "distance")


@query(
    "j13b_best_suggestion",
    _one_edit_sql(
        "SELECT DISTINCT substr(w, 1, length(w) - 1) || 'x' AS word FROM "
        "(SELECT unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS w FROM benchmark)"
    )
    + """ SELECT word, suggestion, distance, frequency FROM r
QUALIFY row_number() OVER (PARTITION BY word ORDER BY distance, frequency DESC, suggestion) = 1""",
)
def j13b_best_suggestion(spark, sf):
    """Best correction of misspelt words: the last letter of each question word is replaced."""
    v = durable(vocabulary(docs(spark, sf), "text", r"\p{L}+"))  # read for the pairs and for the frequencies
    q = vocabulary(table(spark, sf, "benchmark"), "text", r"\p{L}+")
    q = q.select(F.concat(F.substring("term", F.lit(1), F.length("term") - 1), F.lit("x")).alias("word")).distinct()
    pairs = fuzzy.fuzzy_pairs(q, "word", v, "term", 1).join(v.withColumnRenamed("n", "frequency"), "term")
    best = fuzzy.best_suggestions(pairs, "word", "term", "frequency")
    return best.select("word", F.col("term").alias("suggestion"), "distance", "frequency")


@query("j13c_fuzzy_pairs_3")
def j13c_fuzzy_pairs_3(spark, sf):
    """As j13 with up to three edits, the original operator's distance."""
    v = durable(vocabulary(docs(spark, sf), "text", r"\p{L}+"))  # read for the pairs and for the frequencies
    q = vocabulary(table(spark, sf, "benchmark"), "text", r"\p{L}+").select(F.col("term").alias("word"))
    pairs = fuzzy.fuzzy_pairs_by_segments(q, "word", v, "term", 3)
    return pairs.join(v, "term").select("word", F.col("term").alias("suggestion"), F.col("n").alias("frequency"), "distance")


@query("j13d_best_suggestion_3")
def j13d_best_suggestion_3(spark, sf):
    """As j13b with up to three edits."""
    v = durable(vocabulary(docs(spark, sf), "text", r"\p{L}+"))  # read for the pairs and for the frequencies
    q = vocabulary(table(spark, sf, "benchmark"), "text", r"\p{L}+")
    q = q.select(F.concat(F.substring("term", F.lit(1), F.length("term") - 1), F.lit("x")).alias("word")).distinct()
    pairs = fuzzy.fuzzy_pairs_by_segments(q, "word", v, "term", 3).join(v.withColumnRenamed("n", "frequency"), "term")
    best = fuzzy.best_suggestions(pairs, "word", "term", "frequency")
    return best.select("word", F.col("term").alias("suggestion"), "distance", "frequency")


@query(
    "j14_flag_split",
    """WITH f AS (SELECT o_custkey, max(CASE WHEN o_totalprice > 450000 THEN 1 ELSE 0 END) AS big FROM orders WHERE o_orderpriority = '2-HIGH' GROUP BY 1)
SELECT c_custkey, CASE WHEN big IS NOT DISTINCT FROM 1 THEN 'flagged' ELSE 'other' END AS side FROM customer LEFT JOIN f ON o_custkey = c_custkey""",
)
def j14_flag_split(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderpriority = '2-HIGH'")
    flags = o.groupBy(F.col("o_custkey").alias("c_custkey")).agg((F.max("o_totalprice") > 450000).cast("int").alias("big"))
    hit, rest = relational.flag_split(table(spark, sf, "customer").select("c_custkey"), flags, "c_custkey", "big")
    return hit.select("c_custkey", F.lit("flagged").alias("side")).unionByName(rest.select("c_custkey", F.lit("other").alias("side")))
