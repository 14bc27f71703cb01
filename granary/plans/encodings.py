"""Encoding and binning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators import encode, relational
from granary.plans.aggregates import rounded
from granary.plans.registry import fx, query
from granary.plans.tables import table

CUT = "1998-01-01 00:00:00"


@query(
    "e01_factorize",
    """WITH f AS (SELECT p_brand AS b, min(o_orderkey) AS first FROM orders JOIN part ON o_custkey = p_partkey WHERE o_orderstatus = 'P' GROUP BY 1),
codes AS (SELECT b, row_number() OVER (ORDER BY first) - 1 AS code FROM f)
SELECT p_partkey, coalesce(code, -1) AS brand_code FROM part LEFT JOIN codes ON p_brand = b AND p_partkey % 5 <> 0""",
)
def e01_factorize(spark, sf):
    """Codes in order of first appearance on one table, applied to another with gaps and unseen levels."""
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    seen = table(spark, sf, "orders").filter("o_orderstatus = 'P'").select("o_orderkey", "o_custkey")
    seen = seen.join(p, F.col("o_custkey") == F.col("p_partkey")).select("o_orderkey", "p_brand")
    codes = encode.factorize(seen, "p_brand", "o_orderkey")
    other = p.withColumn("p_brand", F.when(F.col("p_partkey") % 5 != 0, F.col("p_brand")))
    return encode.apply_codes(other, codes, "p_brand", "brand_code").select("p_partkey", "brand_code")


@query(
    "e02_label_encode",
    """WITH l AS (SELECT c_name AS v FROM customer UNION SELECT s_name FROM supplier)
SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM l""",
)
def e02_label_encode(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_name").alias("v"))
    s = table(spark, sf, "supplier").select(F.col("s_name").alias("v"))
    return encode.label_encode([c, s], "v")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "e03_one_hot",
    "SELECT o_orderkey, "
    + ", ".join(
        f"CASE WHEN o_orderpriority = '{p}' AND o_orderstatus <> 'P' THEN 1 ELSE 0 END AS \"priority_{p}\"" for p in PRIORITIES[1:]
    )
    + " FROM orders",
)
def e03_one_hot(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("p")
    )
    return encode.one_hot(o, "p", encode.levels_of(o, "p"), "priority", drop_first=True).drop("p")


@query(
    "e04_target_means",
    f"""WITH m AS (SELECT c_mktsegment, avg(CASE WHEN c_acctbal < 0 THEN 1.0 ELSE 0.0 END) AS e FROM customer
 WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '{CUT}') GROUP BY 1)
SELECT c_custkey, {fx("e")} AS segment_rate FROM customer LEFT JOIN m USING (c_mktsegment)""",
)
def e04_target_means(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    early = table(spark, sf, "orders").filter(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < F.to_timestamp_ntz(F.lit(CUT)))
    )
    train = c.join(early, F.col("c_custkey") == F.col("o_custkey"), "left_semi")
    means = encode.target_means(train, "c_mktsegment", (F.col("c_acctbal") < 0).cast("double"))
    out = relational.map_values(c, "c_mktsegment", means, "c_mktsegment", "encoded", "segment_rate")
    return rounded(out.select("c_custkey", "segment_rate"))


@query(
    "e05_fixed_bins",
    """SELECT p_partkey, CASE WHEN p_retailprice > 900 AND p_retailprice <= 950 THEN 0 WHEN p_retailprice > 950 AND p_retailprice <= 1000 THEN 1
 WHEN p_retailprice > 1000 AND p_retailprice <= 1100 THEN 2 END AS bin FROM part""",
)
def e05_fixed_bins(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", encode.fixed_bins(F.col("p_retailprice"), [900, 950, 1000, 1100]).alias("bin")
    )


@query(
    "e06_decile_bins",
    "WITH q AS (SELECT "
    + ", ".join(f"quantile_cont(c_acctbal, {i / 10}) AS q{i}" for i in range(11))
    + " FROM customer) SELECT c_custkey, CASE "
    + " ".join(f"WHEN c_acctbal > q{i} AND c_acctbal <= q{i + 1} THEN {i}" for i in range(10))
    + " END AS bin FROM customer, q",
)
def e06_decile_bins(spark, sf):
    return encode.quantile_bins(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "c_acctbal", 10).drop("c_acctbal")


@query(
    "e07_coverage_class",
    "SELECT l_returnflag, CAST(ceil(round(l_discount * 10, 6)) AS BIGINT) AS coverage, count(*) AS n FROM lineitem GROUP BY 1, 2",
)
def e07_coverage_class(spark, sf):
    coverage = F.ceil(F.round(F.col("l_discount") * 10, 6)).cast("long").alias("coverage")
    return table(spark, sf, "lineitem").groupBy("l_returnflag", coverage).agg(F.count(F.lit(1)).alias("n"))


@query(
    "e08_model_matrix",
    f"""WITH t AS (SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN p_type END AS t, p_size, p_retailprice FROM part),
f AS (SELECT t, count(*) / (SELECT count(*) FROM t) AS share FROM t WHERE t IS NOT NULL GROUP BY 1),
l AS (SELECT p_partkey, CASE WHEN t.t IS NULL THEN '(missing)' WHEN share >= 0.132 THEN t.t ELSE 'Other' END AS t, p_size, p_retailprice FROM t LEFT JOIN f ON t.t = f.t),
s AS (SELECT avg(p_size) AS ma, stddev_samp(p_size) AS sa, avg(p_retailprice) AS mp, stddev_samp(p_retailprice) AS sp FROM part),
k AS (SELECT t, row_number() OVER (ORDER BY t) AS r FROM (SELECT DISTINCT t FROM l))
SELECT p_partkey, (SELECT t FROM k WHERE r = 2) AS level_2, CAST(l.t = (SELECT t FROM k WHERE r = 2) AS INT) AS flag_2,
 (SELECT t FROM k WHERE r = 3) AS level_3, CAST(l.t = (SELECT t FROM k WHERE r = 3) AS INT) AS flag_3,
 {fx("(p_size - ma) / sa")} AS p_size, {fx("(p_retailprice - mp) / sp")} AS p_retailprice FROM l, s""",
)
def e08_model_matrix(spark, sf):
    p = table(spark, sf, "part").select(
        "p_partkey", F.when(F.col("p_partkey") % 5 != 0, F.col("p_type")).alias("t"), "p_size", "p_retailprice"
    )
    matrix = encode.model_matrix(p, "t", ["p_size", "p_retailprice"], share=0.132)
    flags = [c for c in matrix.columns if c.startswith("t_")]
    # the level names depend on the data, so the first two flags are shown under fixed names
    out = matrix.select(
        "p_partkey",
        F.lit(flags[0][2:]).alias("level_2"),
        F.col(f"`{flags[0]}`").alias("flag_2"),
        F.lit(flags[1][2:]).alias("level_3"),
        F.col(f"`{flags[1]}`").alias("flag_3"),
        "p_size",
        "p_retailprice",
    )
    return rounded(out)
