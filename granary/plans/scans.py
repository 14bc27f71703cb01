"""Sources and sinks. Round trips write to a new folder of the shared directory each time."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from granary.functions.numeric import arithmetic_hash, arithmetic_hash_sql
from granary.plans.aggregates import rounded
from granary.plans.registry import fx, query
from granary.plans.tables import table
from granary.session import shared_dir
from granary.sources import files


def _new_path(spark):
    return f"{shared_dir(spark)}/scan-{uuid.uuid4().hex}"


@query(
    "s01_delimited_scan",
    f"SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, {fx('o_totalprice', 2)} AS o_totalprice FROM orders",
)
def s01_delimited_scan(spark, sf):
    path = _new_path(spark)
    files.write_result(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), path)
    schema = "o_orderkey STRING, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"
    return rounded(files.scan_delimited(spark, path, schema, ["o_orderkey", "o_orderstatus", "o_totalprice"]), 2)


@query(
    "s02_date_scan",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders",
)
def s02_date_scan(spark, sf):
    path = _new_path(spark)
    o = table(spark, sf, "orders")
    files.write_result(o.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("day")), path)
    return files.scan_delimited(spark, path, "o_orderkey BIGINT, day STRING", dates={"day": "yyyyMMdd"})


@query("s03_tab_scan", "SELECT doc_id, text, lang FROM documents")
def s03_tab_scan(spark, sf):
    path = _new_path(spark)
    d = table(spark, sf, "documents").select("doc_id", "text", "lang")
    escape = {"quoteAll": "true", "escape": '"'}
    d.write.option("header", True).option("sep", "\t").options(**escape).csv(path)
    schema = "doc_id BIGINT, text STRING, lang STRING"
    return files.scan_delimited(spark, path, schema, sep="\t", multiLine="true", escape='"')


@query(
    "s04_flatten_json",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS "props.k" FROM events""",
)
def s04_flatten_json(spark, sf):
    e = table(spark, sf, "events").select("event_id", "props")
    return files.flatten_json(e, {"props": files.json_schema(e, "props")})


@query("s05_json_lines", "SELECT doc_id, lang, n_chars FROM documents")
def s05_json_lines(spark, sf):
    path = _new_path(spark)
    table(spark, sf, "documents").write.json(path)
    return files.scan_json_lines(spark, path, "doc_id BIGINT, text STRING, lang STRING, n_chars BIGINT", ["doc_id", "lang", "n_chars"])


@query(
    "s06_keyed_sample",
    f"SELECT event_id, user_id, event_type FROM events WHERE {arithmetic_hash_sql('event_id', 7)} < 70000",
)
def s06_keyed_sample(spark, sf):
    """Sampling operator at a rate of 7 %: the key decides, so any partitioning gives the same rows."""
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    return e.filter(arithmetic_hash(F.col("event_id"), 7) < 70_000)


@query("s06b_bernoulli_sample")
def s06b_bernoulli_sample(spark, sf):
    return files.bernoulli_sample(table(spark, sf, "events"), 0.07, 7)


@query(
    "s07_table_bundle",
    " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in files.TABLES),
)
def s07_table_bundle(spark, sf):
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name, df in files.load_tables(spark, sf).items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionAll(c)
    return out


@query("s08_result_sink", f"SELECT o_custkey, {fx('sum(o_totalprice)', 2)} AS total FROM orders GROUP BY 1")
def s08_result_sink(spark, sf):
    path = _new_path(spark)
    totals = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("total"))
    files.write_result(rounded(totals, 2), path)
    return files.scan_delimited(spark, path, "o_custkey BIGINT, total DOUBLE")


@query(
    "s09_split_export",
    f"""SELECT c_custkey, c_mktsegment, CASE WHEN {arithmetic_hash_sql('c_custkey', 3)} < 600000 THEN 'train'
 WHEN {arithmetic_hash_sql('c_custkey', 3)} < 800000 THEN 'valid' ELSE 'test' END AS split FROM customer""",
)
def s09_split_export(spark, sf):
    path = _new_path(spark)
    h = arithmetic_hash(F.col("c_custkey"), 3)
    split = F.when(h < 600_000, "train").when(h < 800_000, "valid").otherwise("test")
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", split.alias("split"))
    files.write_splits(c, path, "split")
    return spark.read.parquet(path)


@query("s10_file_listing")
def s10_file_listing(spark, sf):
    return files.list_files(spark, sf, "*.parquet")


@query(
    "s10b_rows_by_file",
    "SELECT 'lineitem' AS file_id, l_returnflag, count(*) AS n FROM lineitem GROUP BY ALL "
    "UNION ALL SELECT 'orders', o_orderstatus, count(*) FROM orders GROUP BY ALL",
)
def s10b_rows_by_file(spark, sf):
    """Rows carry the id of the file they were read from."""
    def tagged(name, column):
        df = spark.read.parquet(f"{sf}/{name}.parquet").select("*", F.col("_metadata.file_path").alias("path"))
        file_id = F.regexp_extract("path", r"([^/]+)\.parquet", 1).alias("file_id")
        return df.groupBy(file_id, F.col(column).alias("l_returnflag")).agg(F.count(F.lit(1)).alias("n"))

    return tagged("lineitem", "l_returnflag").unionByName(tagged("orders", "o_orderstatus"))
