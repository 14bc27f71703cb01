"""Sorts, limits and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators import relational
from granary.plans.aggregates import rounded
from granary.plans.registry import fx, query
from granary.plans.tables import DAILY_SQL, daily, table


@query("o01_sort_head", "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 20")
def o01_sort_head(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "value")
    return e.orderBy(F.col("value").desc(), "event_id").limit(20)


@query(
    "o02_largest_totals",
    f"""SELECT o_custkey, {fx("total", 2)} AS total FROM (SELECT o_custkey, sum(o_totalprice) AS total FROM orders GROUP BY 1)
ORDER BY total DESC, o_custkey LIMIT 10""",
)
def o02_largest_totals(spark, sf):
    totals = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    return rounded(totals.orderBy(F.col("total").desc(), "o_custkey").limit(10), 2)


@query(
    "o03_top_with_ties",
    """WITH g AS (SELECT user_id, count(*) AS n FROM events GROUP BY 1)
SELECT user_id, n FROM g QUALIFY rank() OVER (ORDER BY n DESC) <= 10""",
)
def o03_top_with_ties(spark, sf):
    counts = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return relational.top_with_ties(counts, "n", 10)


@query(
    "o04_drop_last",
    f"WITH {DAILY_SQL} SELECT d, n FROM daily QUALIFY row_number() OVER (ORDER BY d DESC) > 15",
)
def o04_drop_last(spark, sf):
    return relational.drop_last(daily(spark, sf).select("d", "n"), "d", F.col("d"), 15)


@query(
    "o05_top_ids_join",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN
 (SELECT c_custkey FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 25)""",
)
def o05_top_ids_join(spark, sf):
    best = table(spark, sf, "customer").orderBy(F.col("c_acctbal").desc(), "c_custkey").limit(25)
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return o.join(F.broadcast(best), F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@query(
    "o06_average_then_filter",
    f"""WITH m AS (SELECT s, avg(q) AS imp FROM (SELECT l_suppkey AS s, l_linenumber, avg(l_quantity) AS q FROM lineitem GROUP BY 1, 2) GROUP BY 1),
top AS (SELECT s FROM m ORDER BY round(imp, 9) DESC, s LIMIT 30)
SELECT l_suppkey AS feature, l_linenumber AS fold, {fx("avg(l_quantity)")} AS importance FROM lineitem WHERE l_suppkey IN (SELECT s FROM top) GROUP BY 1, 2""",
)
def o06_average_then_filter(spark, sf):
    """Importances per fold, kept for the features with the highest mean over folds."""
    per_fold = (
        table(spark, sf, "lineitem")
        .groupBy(F.col("l_suppkey").alias("feature"), F.col("l_linenumber").alias("fold"))
        .agg(F.avg("l_quantity").alias("importance"))
    )
    mean = per_fold.groupBy("feature").agg(F.round(F.avg("importance"), 9).alias("mean"))
    best = mean.orderBy(F.col("mean").desc(), "feature").limit(30).select("feature")
    return rounded(per_fold.join(F.broadcast(best), "feature", "left_semi"))


@query(
    "u01_stack_tables",
    """SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment, 'customer' AS origin FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL, 'supplier' FROM supplier""",
)
def u01_stack_tables(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"), F.lit("customer").alias("origin"),
    )
    s = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"),
        F.lit("supplier").alias("origin"),
    )
    return c.unionByName(s, allowMissingColumns=True)


@query(
    "u02_symmetric_difference",
    """WITH a AS (SELECT DISTINCT CAST(strftime(o_orderdate, '%m%d') AS INT) AS md FROM orders WHERE o_totalprice > 450000),
b AS (SELECT DISTINCT CAST(strftime(ts, '%m%d') AS INT) AS md FROM events)
(SELECT * FROM a UNION SELECT * FROM b) EXCEPT (SELECT * FROM a INTERSECT SELECT * FROM b)""",
)
def u02_symmetric_difference(spark, sf):
    o = table(spark, sf, "orders").filter("o_totalprice > 450000")
    a = o.select(F.date_format("o_orderdate", "MMdd").cast("int").alias("md"))
    b = table(spark, sf, "events").select(F.date_format("ts", "MMdd").cast("int").alias("md"))
    return relational.symmetric_difference(a, b)


@query("u03_intersection", "SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def u03_intersection(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("k")).intersect(o.select("o_custkey"))


@query(
    "u04_rows_occurring_once",
    """WITH s AS (SELECT c_custkey, c_mktsegment FROM customer UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal < 2000
 UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal < 2000)
SELECT c_custkey, c_mktsegment FROM s GROUP BY ALL HAVING count(*) = 1""",
)
def u04_rows_occurring_once(spark, sf):
    a = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    b = a.filter("c_acctbal < 2000").drop("c_acctbal")
    return relational.rows_occurring_once(a.drop("c_acctbal").unionAll(b).unionAll(b))


@query(
    "u05_fill_periods",
    f"""WITH k AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P'), m AS (SELECT CAST(unnest(range(1, 13)) AS INT) AS month),
v AS (SELECT o_custkey, month(o_orderdate) AS month, sum(o_totalprice) AS total FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2)
SELECT k.o_custkey, m.month, {fx("coalesce(total, 0)", 2)} AS total FROM k CROSS JOIN m LEFT JOIN v ON v.o_custkey = k.o_custkey AND v.month = m.month""",
)
def u05_fill_periods(spark, sf):
    o = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    monthly = o.groupBy("o_custkey", F.month("o_orderdate").alias("month")).agg(F.sum("o_totalprice").alias("total"))
    return rounded(relational.fill_periods(monthly, ["o_custkey"], "month", list(range(1, 13)), ["total"]), 2)
