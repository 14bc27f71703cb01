"""Surfaces for functions of the user's own: aggregates, fitted stages, table functions."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from granary.functions.numeric import arithmetic_hash, arithmetic_hash_sql
from granary.operators import custom, encode, rollup, stages, tablefunctions
from granary.plans.aggregates import SESSION_SPEC, _spec_sql, rounded
from granary.plans.registry import fx, query
from granary.plans.tables import ITEMS_SQL, SESSIONS_SQL, items, sessions, table
from granary.plans.texts import TOKENS_SQL, docs
from granary.session import shared_path

_PERCENTS = (10, 50, 90)


@query(
    "y02_weighted_quantiles",
    f"""WITH x AS (SELECT l_suppkey, l_returnflag, CAST(round(l_extendedprice * 100) AS BIGINT) AS v, CAST(l_quantity AS BIGINT) AS w FROM lineitem),
b AS (SELECT *, greatest(length(bin(v)) - {custom.DIGITS}, 0) AS s FROM x),
c AS (SELECT l_suppkey, l_returnflag, (v >> s) << s AS low, s, sum(w) AS w FROM b GROUP BY ALL),
r AS (SELECT *, sum(w) OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY low) AS running, sum(w) OVER (PARTITION BY l_suppkey, l_returnflag) AS total FROM c),
q AS (SELECT *, low + CASE WHEN s > 0 THEN CAST(1 << s AS DOUBLE) / 2 ELSE 0 END AS middle FROM r)
SELECT l_suppkey, l_returnflag, CAST(any_value(total) AS BIGINT) AS weight,
 {", ".join(f"min(middle) FILTER (running * 100 >= {p} * total) AS p{p}" for p in _PERCENTS)} FROM q GROUP BY 1, 2""",
)
def y02_weighted_quantiles(spark, sf):
    """Price quantiles weighted by quantity, as a mergeable state of the user's own."""
    li = table(spark, sf, "lineitem")
    rows = li.select("l_suppkey", "l_returnflag", F.round(F.col("l_extendedprice") * 100).cast("long").alias("v"), F.col("l_quantity").cast("long").alias("w"))
    return custom.aggregate(rows, ["l_suppkey", "l_returnflag"], ["v", "w"], custom.weighted_quantiles("v", "w", _PERCENTS))


@query(
    "y02b_peak_to_peak",
    f"SELECT o_orderpriority, {fx('max(o_totalprice) - min(o_totalprice)', 2)} AS ptp FROM orders GROUP BY 1",
)
def y02b_peak_to_peak(spark, sf):
    spread = custom.aggregate(table(spark, sf, "orders"), ["o_orderpriority"], ["o_totalprice"], custom.peak_to_peak("o_totalprice"))
    return rounded(spread, 2)


@query(
    "y03_saved_pipeline",
    f"""WITH w AS (SELECT doc_id, {arithmetic_hash_sql('doc_id', 11)} < 600000 AS train, unnest({TOKENS_SQL}) AS term FROM documents),
c AS (SELECT doc_id, train, term, count(*) AS tf FROM w GROUP BY ALL), t AS (SELECT count(DISTINCT doc_id) AS total FROM c WHERE train),
d AS (SELECT term, count(*) AS df FROM c WHERE train GROUP BY 1)
SELECT doc_id, term, tf, {fx("tf * (ln((1 + total) / (1 + df)) + 1)", 6)} AS weight FROM c JOIN d USING (term), t WHERE NOT train AND df >= 3 AND df <= total * 0.5""",
)
def y03_saved_pipeline(spark, sf):
    """Term weights fitted on one part of the documents, saved, loaded and applied to the other."""
    train = arithmetic_hash(F.col("doc_id"), 11) < 600_000
    pipeline = Pipeline(stages=[
        stages.ColumnSelector(columns=["doc_id", "text"]), stages.TermCounter(idCol="doc_id", textCol="text"),
        stages.TermWeigher(idCol="doc_id", minDf=3, maxDf=0.5),
    ])
    path = shared_path(spark, "pipeline")
    pipeline.fit(docs(spark, sf).filter(train)).write().save(path)
    return rounded(PipelineModel.load(path).transform(docs(spark, sf).filter(~train)), 6)


@query(
    "y04_overlapping_pairs",
    f"""WITH {ITEMS_SQL}, w AS (SELECT item_id, list_filter(string_split(name || ' ' || description, ' '), lambda x: x <> '') AS w FROM items)
SELECT item_id, CAST(i AS INT) AS position, w[i] AS first, w[i + 1] AS second FROM (SELECT *, unnest(range(1, len(w))) AS i FROM w)""",
)
def y04_overlapping_pairs(spark, sf):
    """Each listing as many rows: every word with the next one, by a table function whose matches overlap."""
    said = items(spark, sf).select("item_id", F.concat_ws(" ", "name", "description").alias("said"))
    return tablefunctions.overlapping_pairs(said, "item_id", "said")


@query(
    "y04b_follow_ups",
    """SELECT a.user_id, a.event_id, b.event_id AS next_event_id, CAST(epoch_us(b.ts) - epoch_us(a.ts) AS BIGINT) AS microseconds
FROM events a JOIN events b ON a.user_id = b.user_id AND (b.ts > a.ts OR (b.ts = a.ts AND b.event_id > a.event_id)) AND b.ts <= a.ts + INTERVAL 2 HOUR""",
)
def y04b_follow_ups(spark, sf):
    """Every event with each later one of its user within two hours; the rows of a user stream by."""
    return tablefunctions.follow_ups(table(spark, sf, "events"), "user_id", "ts", "event_id", 2 * 3600)


_CATEGORIES = ("channel", "weekday", "band")
_CATEGORY_SPEC = {
    **SESSION_SPEC, "new_visits": ["sum", "mean", "median"], **{c: ["min", "max", "mean", "median", "var", "std"] for c in _CATEGORIES},
}


def _codes_sql(c):
    return f"c_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY min(session_id)) - 1 AS code FROM s WHERE {c} IS NOT NULL GROUP BY 1)"


@query(
    "a01c_session_rollup_categories",
    f"""WITH {SESSIONS_SQL}, s AS (SELECT *, dayname(ts) AS weekday, CASE WHEN hits >= 66 THEN 'high' WHEN hits >= 33 THEN 'middle' END AS band,
  CASE WHEN hits % 3 = 0 THEN 1 ELSE 0 END AS new_visits FROM sessions), {", ".join(map(_codes_sql, _CATEGORIES))},
f AS (SELECT s.* EXCLUDE ({", ".join(_CATEGORIES)}), {", ".join(f"coalesce(c_{c}.code, -1) AS {c}" for c in _CATEGORIES)}
  FROM s {" ".join(f"LEFT JOIN c_{c} ON c_{c}.v = s.{c}" for c in _CATEGORIES)})
SELECT visitor, min(ts) AS ts_min, max(ts) AS ts_max, {fx("ln(1 + coalesce(sum(revenue), 0))")} AS revenue_sum, count(*) AS revenue_size,
  {_spec_sql(_CATEGORY_SPEC)},
  CAST(floor((floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 86400) AS BIGINT) AS date_diff
FROM f GROUP BY visitor""",
)
def a01c_session_rollup_categories(spark, sf):
    """The whole roll-up: first-appearance codes of the text columns among the aggregates, and new visits."""
    band = F.when(F.col("hits") >= 66, "high").when(F.col("hits") >= 33, "middle")
    s = sessions(spark, sf).withColumns({
        "weekday": F.date_format("ts", "EEEE"), "band": band, "new_visits": F.when(F.col("hits") % 3 == 0, 1).otherwise(0),
    })
    codes = encode.factorize_many(s, _CATEGORIES, "session_id")
    coded = encode.apply_many_codes(s, codes, _CATEGORIES)
    return rounded(rollup.session_rollup(coded, "visitor", "ts", "revenue", _CATEGORY_SPEC))
