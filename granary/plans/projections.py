"""Projections, filters and cleaning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.dates import compact_date
from granary.functions.numeric import clip, fixed, flag_map, last_match, row_stats, wrap_degrees
from granary.functions.text import path_levels
from granary.operators import clean, profile, relational
from granary.plans.aggregates import rounded
from granary.plans.registry import fx, query
from granary.plans.tables import DAILY_SQL, ITEMS_SQL, SESSIONS_SQL, TXNS_SQL, daily, items, sessions, table, txns

LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LINE_KEY_SQL = ", ".join(LINE_KEY)


@query(
    "p01_rename",
    f"""WITH {TXNS_SQL} SELECT card, {fx("sum(amount)", 2)} AS hist_amount_sum, {fx("max(amount)", 2)} AS hist_amount_max,
 CAST(sum(installments) AS BIGINT) AS hist_installments_sum FROM txns GROUP BY card""",
)
def p01_rename(spark, sf):
    from granary.functions.aggspec import rollup

    wide = rollup(txns(spark, sf), ["card"], {"amount": ["sum", "max"], "installments": ["sum"]})
    return rounded(clean.prefix_columns(wide, "hist_", keep=["card"]), 2)


@query("p01b_anonymise", "SELECT c_custkey, c_name AS x0, c_nationkey AS x1, c_acctbal AS x2, c_mktsegment AS x3 FROM customer")
def p01b_anonymise(spark, sf):
    return clean.anonymise_columns(table(spark, sf, "customer"), keep=["c_custkey"])


@query("p02_drop_constant", "SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'x' END AS half FROM orders")
def p02_drop_constant(spark, sf):
    """Constant columns go; a column that is partly missing stays, since missing counts as a value."""
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.lit("web").alias("always"),
        F.lit(None).cast("string").alias("never"),
        F.when(F.col("o_orderstatus") == "F", "x").alias("half"),
    )
    return profile.drop_constant_columns(o)


@query("p02b_drop_constant_ignoring_missing", "SELECT o_orderkey, o_custkey, 'web' AS always FROM orders")
def p02b_drop_constant_ignoring_missing(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.lit("web").alias("always"), F.when(F.col("o_orderstatus") == "F", "x").alias("half")
    )
    return profile.drop_constant_columns(o, null_is_value=False, keep=["always"])


@query("p03_column_difference", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def p03_column_difference(spark, sf):
    """Columns that the other table lacks go; those that only the other one has play no part."""
    c = table(spark, sf, "customer")
    other = c.select("c_custkey", F.col("c_name"), "c_acctbal", F.lit(1).alias("score"))
    return c.drop(*clean.columns_missing_in(c, other))


@query(
    "p04_sentinels",
    "SELECT event_id, nullif(event_type, 'error') AS event_type, CASE WHEN props <> '{\"k\": 0}' THEN props END AS props FROM events",
)
def p04_sentinels(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "props")
    return clean.sentinels_to_null(e, ["error", '{"k": 0}'])


@query(
    "p05_impute",
    f"""WITH {ITEMS_SQL} SELECT item_id, coalesce(brand, 'missing') AS brand, coalesce(category, 'other/other/other') AS category,
 CAST(brand IS NOT NULL AS INT) AS has_brand, CAST(category IS NOT NULL AS INT) AS has_category FROM items""",
)
def p05_impute(spark, sf):
    i = items(spark, sf).select("item_id", "brand", "category")
    return clean.impute(i, {"brand": "missing", "category": "other/other/other"}, indicator="has_")


@query(
    "p06_cast",
    """SELECT event_id, CAST(ts AS DATE) AS day, CAST(value AS BIGINT) AS whole_value, CAST(user_id AS VARCHAR) AS visitor,
 TRY_CAST(event_type AS INT) AS type_number FROM (SELECT event_id, ts, floor(value) AS value, user_id, event_type FROM events)""",
)
def p06_cast(spark, sf):
    e = table(spark, sf, "events")
    return e.select(
        "event_id",
        compact_date(F.date_format("ts", "yyyyMMdd")).alias("day"),
        F.floor("value").cast("long").alias("whole_value"),
        F.col("user_id").cast("string").alias("visitor"),
        F.col("event_type").try_cast("int").alias("type_number"),
    )


@query(
    "p07_flag_map",
    f"""SELECT {LINE_KEY_SQL}, CASE l_linestatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS status_flag,
 CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 END AS return_flag FROM lineitem""",
)
def p07_flag_map(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.select(
        *LINE_KEY,
        flag_map(F.col("l_linestatus"), {"F": 1, "O": 0}).alias("status_flag"),
        flag_map(F.col("l_returnflag"), {"A": 1, "N": 0}).alias("return_flag"),
    )


@query("p08_unit_scale", f"WITH {SESSIONS_SQL} SELECT session_id, {fx('revenue / 1e3', 6)} AS thousands FROM sessions")
def p08_unit_scale(spark, sf):
    return rounded(sessions(spark, sf).select("session_id", (F.col("revenue") / 1e3).alias("thousands")), 6)


@query(
    "p09_override_rules",
    f"""WITH {DAILY_SQL}, k AS (SELECT d, n, CASE WHEN n % 11 = 0 THEN 'Bridge' WHEN n % 7 = 0 THEN 'Work Day' WHEN n % 5 = 0 THEN 'Holiday' END AS kind,
 n % 2 = 0 AS transferred FROM daily)
SELECT d, CASE WHEN kind = 'Holiday' AND transferred THEN 1 WHEN kind = 'Holiday' AND NOT transferred THEN 0 WHEN kind = 'Bridge' THEN 0
 WHEN kind = 'Work Day' THEN 1 WHEN isodow(d) > 5 THEN 0 ELSE 1 END AS working_day FROM k""",
)
def p09_override_rules(spark, sf):
    n, kind = F.col("n"), F.col("kind")
    cal = daily(spark, sf).select(
        "d",
        F.when(n % 11 == 0, "Bridge").when(n % 7 == 0, "Work Day").when(n % 5 == 0, "Holiday").alias("kind"),
        (n % 2 == 0).alias("transferred"),
    )
    rules = [
        (F.weekday("d") > 4, 0),
        (kind == "Work Day", 1),
        (kind == "Transfer", 0),
        (kind == "Bridge", 0),
        ((kind == "Holiday") & ~F.col("transferred"), 0),
        ((kind == "Holiday") & F.col("transferred"), 1),
    ]
    return cal.select("d", last_match(rules, 1).alias("working_day"))


@query("p10_threshold_flag", "SELECT c_custkey, CASE WHEN c_acctbal < -500 THEN 1 ELSE 0 END AS outlier FROM customer")
def p10_threshold_flag(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") < -500).cast("int").alias("outlier"))


@query(
    "p11_row_filter",
    """SELECT event_id, user_id, event_type, value FROM events WHERE event_type NOT IN ('error', 'signup') AND value > 10
 AND ts < TIMESTAMP '2024-01-20 00:00:00'""",
)
def p11_row_filter(spark, sf):
    e = table(spark, sf, "events")
    cut = F.to_timestamp_ntz(F.lit("2024-01-20 00:00:00"))
    return e.filter(~F.col("event_type").isin("error", "signup") & (F.col("value") > 10) & (F.col("ts") < cut)).select(
        "event_id", "user_id", "event_type", "value"
    )


@query(
    "p12_frequent_levels",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_suppkey IN
 (SELECT l_suppkey FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, l_suppkey LIMIT 5)""",
)
def p12_frequent_levels(spark, sf):
    return relational.most_frequent_levels(table(spark, sf, "lineitem").select(*LINE_KEY), "l_suppkey", 5)


@query(
    "p13_clip_wrap",
    f"""SELECT {LINE_KEY_SQL}, least(greatest(l_quantity, 5), 45) AS clipped, greatest(l_quantity - 25, 0) AS floored,
 {fx("((l_extendedprice % 360) + 360) % 360", 2)} AS degrees FROM lineitem""",
)
def p13_clip_wrap(spark, sf):
    q = F.col("l_quantity")
    li = table(spark, sf, "lineitem").select(
        *LINE_KEY,
        clip(q, 5.0, 45.0).alias("clipped"),
        clip(q - 25, 0.0).alias("floored"),
        fixed(wrap_degrees(F.col("l_extendedprice")), 2).alias("degrees"),
    )
    return li


@query(
    "p14_percentile_stretch",
    f"""WITH b AS (SELECT l_returnflag AS f, quantile_cont(l_extendedprice, 0.05) AS lo, quantile_cont(l_extendedprice, 0.95) AS hi FROM lineitem GROUP BY 1)
SELECT {LINE_KEY_SQL}, {fx("least(greatest((l_extendedprice - lo) / (hi - lo), 0), 1)")} AS stretched FROM lineitem JOIN b ON l_returnflag = f""",
)
def p14_percentile_stretch(spark, sf):
    li = table(spark, sf, "lineitem").select(*LINE_KEY, "l_returnflag", "l_extendedprice")
    return rounded(clean.stretch(li, ["l_returnflag"], "l_extendedprice", "stretched").select(*LINE_KEY, "stretched"))


NARROW = ["l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_discount"]


@query(
    "p15_narrow_types",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) + 0.0 AS min_value, CAST(max({c}) AS DOUBLE) + 0.0 AS max_value, """
        + (
            "'float'"
            if c in ("l_quantity", "l_discount")
            else f"""CASE WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint' WHEN min({c}) >= -32768 AND max({c}) <= 32767
 THEN 'smallint' WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' ELSE 'bigint' END"""
        )
        + " AS suggested_type FROM lineitem"
        for c in NARROW
    ),
)
def p15_narrow_types(spark, sf):
    return profile.narrow_types(table(spark, sf, "lineitem"), NARROW)


@query(
    "p16_derived_arithmetic",
    f"""SELECT {LINE_KEY_SQL}, {fx("abs(l_quantity) + abs(l_discount * 100)")} AS l1, {fx("sqrt(l_quantity ** 2 + (l_discount * 100) ** 2)")} AS l2,
 {fx("l_extendedprice * (1 - l_discount) * (1 + l_tax)", 3)} AS total, {fx("l_tax / nullif(l_quantity, 0)", 6)} AS ratio FROM lineitem""",
)
def p16_derived_arithmetic(spark, sf):
    q, d, t, p = F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax"), F.col("l_extendedprice")
    return table(spark, sf, "lineitem").select(
        *LINE_KEY,
        fixed(F.abs(q) + F.abs(d)).alias("l1"),
        fixed(F.sqrt(q * q + d * d)).alias("l2"),
        fixed(p * (1 - F.col("l_discount")) * (1 + t), 3).alias("total"),
        fixed(t / F.nullif(q, F.lit(0.0)), 6).alias("ratio"),
    )


@query(
    "p17_row_statistics",
    f"""WITH m AS (SELECT *, (l_quantity + l_discount * 100 + l_tax * 100) / 3 AS mu FROM lineitem)
SELECT {LINE_KEY_SQL}, {fx("mu")} AS row_mean, {fx("sqrt(((l_quantity - mu) ** 2 + (l_discount * 100 - mu) ** 2 + (l_tax * 100 - mu) ** 2) / 2)")} AS row_std,
 {fx("least(l_quantity, l_discount * 100, l_tax * 100)")} AS row_min, {fx("greatest(l_quantity, l_discount * 100, l_tax * 100)")} AS row_max FROM m""",
)
def p17_row_statistics(spark, sf):
    stats = row_stats([F.col("l_quantity"), F.col("l_discount") * 100, F.col("l_tax") * 100])
    return rounded(table(spark, sf, "lineitem").select(*LINE_KEY, *[e.alias(f"row_{n}") for n, e in stats.items()]))


@query(
    "p18_interaction_key",
    f"""WITH {ITEMS_SQL}, l AS (SELECT item_id, condition, string_split(category, '/') AS p FROM items)
SELECT item_id, CASE WHEN len(p) >= 3 THEN p[1] ELSE 'other' END || '_' || condition AS general_condition,
 CASE WHEN len(p) >= 3 THEN p[2] ELSE 'other' END || '_' || condition AS sub_condition FROM l""",
)
def p18_interaction_key(spark, sf):
    general, sub, _ = path_levels(F.col("category"))
    return items(spark, sf).select(
        "item_id",
        F.concat_ws("_", general, F.col("condition").cast("string")).alias("general_condition"),
        F.concat_ws("_", sub, F.col("condition").cast("string")).alias("sub_condition"),
    )


@query(
    "p19_drop_single_classes",
    "SELECT url_path, page_id FROM (SELECT page_id, split_part(split_part(url, '//', 2), '/', 1) AS url_path FROM pages) "
    "QUALIFY count(*) OVER (PARTITION BY url_path) >= 2",
)
def p19_drop_single_classes(spark, sf):
    p = table(spark, sf, "pages").select("page_id", F.split(F.split("url", "//")[1], "/")[0].alias("url_path"))
    return clean.drop_single_classes(p, "url_path")


@query("p20_complete_cases", f"WITH {ITEMS_SQL} SELECT item_id, brand, category FROM items WHERE brand IS NOT NULL AND category IS NOT NULL")
def p20_complete_cases(spark, sf):
    return clean.complete_cases(items(spark, sf).select("item_id", "brand", "category"), ["brand", "category"])


LINE_COLUMNS = ["l_linenumber", "l_returnflag", "l_linestatus", "l_discount", "l_quantity", "l_extendedprice", "l_partkey"]


@query(
    "p21_classify_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CASE WHEN count(DISTINCT {c}) < 25 THEN 'categorical' ELSE 'continuous' END AS kind FROM lineitem"
        for c in LINE_COLUMNS
    ),
)
def p21_classify_columns(spark, sf):
    return profile.classify_columns(table(spark, sf, "lineitem"), LINE_COLUMNS)
