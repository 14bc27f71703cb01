"""The given tables and the four shapes the operators are bound to.

``sessions`` (visits of a visitor), ``txns`` (purchases of a card), ``items`` (listings)
and ``panel`` (daily series per nation and segment) are derived by Spark from the tables;
the ``*_SQL`` texts state the same derivations for the comparison engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


AS_OF = "2001-08-02 00:00:00"  # reference instant of the card features, one day past the last order


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per visit; ``totals`` is parsed once for all of its fields."""
    e = table(spark, sf_dir, "events")
    parsed = e.withColumn("j", F.from_json("props", "k INT"))
    return parsed.select(
        F.col("user_id").alias("visitor"),
        F.col("event_id").alias("session_id"),
        F.col("ts"),
        F.col("event_type").alias("channel"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("revenue"),
        F.coalesce(F.col("j.k"), F.lit(0)).alias("hits"),
        F.floor(F.coalesce(F.col("j.k"), F.lit(0)) / 4).cast("int").alias("pageviews"),
        F.when(F.col("j.k") < 10, 1).otherwise(0).alias("bounces"),
        F.weekday("ts").alias("sess_dow"),
        F.dayofmonth("ts").alias("sess_dom"),
        F.hour("ts").alias("sess_hour"),
    )


SESSIONS_SQL = """
sessions AS (
  SELECT user_id AS visitor, event_id AS session_id, ts, event_type AS channel,
         CASE WHEN event_type = 'purchase' THEN value END AS revenue,
         coalesce(CAST(json_extract(props, '$.k') AS INT), 0) AS hits,
         CAST(floor(coalesce(CAST(json_extract(props, '$.k') AS INT), 0) / 4) AS INT) AS pageviews,
         CASE WHEN CAST(json_extract(props, '$.k') AS INT) < 10 THEN 1 ELSE 0 END AS bounces,
         CAST(isodow(ts) - 1 AS INT) AS sess_dow, CAST(day(ts) AS INT) AS sess_dom,
         CAST(hour(ts) AS INT) AS sess_hour
  FROM events)
"""


def txns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per purchase. No join hint: the sizes of the sides decide."""
    li = table(spark, sf_dir, "lineitem").drop("l_discount", "l_tax", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    s = s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    joined = (
        li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(p, F.col("l_partkey") == F.col("p_partkey"))
        .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
    )
    return joined.select(
        F.col("o_custkey").alias("card"),
        F.col("l_suppkey").alias("merchant"),
        F.col("p_brand").alias("merchant_category"),
        F.col("p_type").alias("subsector"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_quantity").cast("int").alias("installments"),
        F.col("o_orderdate").alias("purchase_ts"),
        ((F.year("o_orderdate") - 2001) * 12 + F.month("o_orderdate") - 8).alias("month_lag"),
        (F.col("l_returnflag") != "R").cast("int").alias("authorized"),
        (F.col("l_linestatus") == "F").cast("int").alias("category_1"),
        F.when(F.col("l_linenumber") <= 5, F.col("l_linenumber").cast("int")).alias("category_2"),
        F.col("l_returnflag").alias("category_3"),
        F.col("s_nationkey").alias("city"),
        F.col("n_regionkey").alias("state"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
    )


TXNS_SQL = """
txns AS (
  SELECT o_custkey AS card, l_suppkey AS merchant, p_brand AS merchant_category, p_type AS subsector,
         l_extendedprice AS amount, CAST(l_quantity AS INT) AS installments, o_orderdate AS purchase_ts,
         CAST((year(o_orderdate) - 2001) * 12 + month(o_orderdate) - 8 AS INT) AS month_lag,
         CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END AS authorized,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS category_1,
         CASE WHEN l_linenumber <= 5 THEN CAST(l_linenumber AS INT) END AS category_2,
         l_returnflag AS category_3, s_nationkey AS city, n_regionkey AS state,
         l_orderkey, l_linenumber, l_partkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per listing: every fifth brand is missing, even listings carry it in the name."""
    p = table(spark, sf_dir, "part")
    brand = F.lower(F.regexp_replace("p_brand", "#", ""))
    even = F.col("p_partkey") % 2 == 0
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.when(even, F.concat_ws(" ", F.lower("p_name"), brand)).otherwise(F.lower("p_name")).alias("name"),
        F.when(F.col("p_partkey") % 5 != 0, brand).alias("brand"),
        F.when(
            F.col("p_partkey") % 7 != 0,
            F.when(F.col("p_partkey") % 11 == 0, F.concat_ws("/", F.lower("p_type"), brand)).otherwise(
                F.concat_ws("/", F.lower("p_type"), brand, F.col("p_size").cast("string"))
            ),
        ).alias("category"),
        (F.col("p_size") % 5 + 1).alias("condition"),
        (F.col("p_partkey") % 3 == 0).cast("int").alias("shipping"),
        F.col("p_retailprice").alias("price"),
        F.concat(
            F.col("p_size").cast("string"),
            F.when(even, F.lit(" kt ring ")).otherwise(F.lit(" oz jar ")),
            F.lower("p_type"),
            F.lit(" "),
            F.lower("p_name"),
        ).alias("description"),
    )


ITEMS_SQL = """
items AS (
  SELECT p_partkey AS item_id,
         CASE WHEN p_partkey % 2 = 0 THEN lower(p_name) || ' ' || lower(replace(p_brand, '#', ''))
              ELSE lower(p_name) END AS name,
         CASE WHEN p_partkey % 5 <> 0 THEN lower(replace(p_brand, '#', '')) END AS brand,
         CASE WHEN p_partkey % 7 <> 0 THEN
              CASE WHEN p_partkey % 11 = 0 THEN lower(p_type) || '/' || lower(replace(p_brand, '#', ''))
                   ELSE lower(p_type) || '/' || lower(replace(p_brand, '#', '')) || '/' || p_size END END AS category,
         CAST(p_size % 5 + 1 AS INT) AS condition, CASE WHEN p_partkey % 3 = 0 THEN 1 ELSE 0 END AS shipping,
         p_retailprice AS price,
         p_size || CASE WHEN p_partkey % 2 = 0 THEN ' kt ring ' ELSE ' oz jar ' END
           || lower(p_type) || ' ' || lower(p_name) AS description
  FROM part)
"""


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales per series; a series has at most one row per calendar day."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("d"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # sums per customer and day first: the join then moves fewer rows
    daily = o.groupBy("o_custkey", "d").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("part_sum"))
    return (
        daily.join(c, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("d", F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"))
        .agg(F.sum("part_sum").cast("double").alias("y"))
    )


PANEL_SQL = """
panel AS (
  SELECT CAST(o_orderdate AS DATE) AS d, c_nationkey AS nation, c_mktsegment AS segment,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
"""

# one row per day over the whole range: every order of that day
DAILY_SQL = """
daily AS (
  SELECT CAST(o_orderdate AS DATE) AS d, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS y,
         count(*) AS n FROM orders GROUP BY 1)
"""


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("d")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("y"),
        F.count(F.lit(1)).alias("n"),
    )
