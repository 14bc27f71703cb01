"""File scans and sinks."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def scan_delimited(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    columns: Sequence[str] | None = None,
    sep: str = ",",
    rows: int | None = None,
    dates: Mapping[str, str] | None = None,
    **options: str,
) -> DataFrame:
    """Delimited text with a declared schema: no inference pass, and ids that look like
    numbers stay text where the schema says so. ``dates`` maps text columns to their
    date pattern; ``rows`` caps the scan as the reader's row limit does."""
    read = spark.read.schema(schema).option("header", True).option("sep", sep)
    for key, value in options.items():
        read = read.option(key, value)
    df = read.csv(path)
    if columns:
        df = df.select(*columns)
    for column, pattern in (dates or {}).items():
        df = df.withColumn(column, F.try_to_date(F.col(column), pattern))
    return df.limit(rows) if rows is not None else df


def scan_json_lines(spark: SparkSession, path: str, schema: str | T.StructType, columns: Sequence[str]) -> DataFrame:
    """Line-delimited JSON, a few fields only; lines that do not parse are left out."""
    kept = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    wide = T.StructType([*kept.fields, T.StructField("_bad", T.StringType())])
    df = spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    return df.filter(F.col("_bad").isNull()).select(*columns)


# a name in backquotes, or the word for a nested document
_OBJECT = re.compile(r"(`(?:[^`]|``)*`)|OBJECT<")


def json_schema(df: DataFrame, column: str) -> T.StructType:
    """Schema of a JSON text column: every field of every row, merged as an aggregate."""
    # a variant holds any document, so its aggregate schema needs no second parser
    merged = df.select(F.schema_of_variant_agg(F.try_parse_json(F.col(column)))).first()[0]
    if not merged or not merged.startswith("OBJECT<"):
        return T.StructType([])
    return T._parse_datatype_string(_OBJECT.sub(lambda m: m[1] or "STRUCT<", merged))


def flatten_json(df: DataFrame, columns: Mapping[str, str | T.StructType]) -> DataFrame:
    """Replace JSON text columns by their fields, named ``parent.child``.

    Each document is parsed once for all its fields, and nested objects are opened too.
    """
    parsed = df.withColumns({c: F.from_json(F.col(c), s) for c, s in columns.items()})

    def leaves(prefix: str, value: Column, dtype: T.DataType) -> list[Column]:
        if isinstance(dtype, T.StructType):
            return [leaf for f in dtype.fields for leaf in leaves(f"{prefix}.{f.name}", value[f.name], f.dataType)]
        return [value.alias(prefix)]

    out = []
    for field in parsed.schema.fields:
        value = F.col(f"`{field.name}`")
        out += leaves(field.name, value, field.dataType) if field.name in columns else [value]
    return parsed.select(*out)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    """Independent row sample taken above the scan."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def load_tables(spark: SparkSession, base: str, names: Sequence[str] = TABLES) -> dict[str, DataFrame]:
    """A named bundle of tables, each registered as a view."""
    out = {}
    for name in names:
        out[name] = spark.read.parquet(f"{base}/{name}.parquet")
        out[name].createOrReplaceTempView(name)
    return out


def write_result(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> None:
    """Distributed sink: one file per task, header per CSV file."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)


def write_splits(df: DataFrame, path: str, split: str, fmt: str = "parquet") -> None:
    """Disjoint splits as one partitioned dataset, written in a single pass."""
    df.write.mode("errorifexists").partitionBy(split).format(fmt).save(path)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below a folder with an id taken from the file name; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    return files.select(F.regexp_replace(name, r"\.[^.]*$", "").alias("file_id"), "path", "length")
