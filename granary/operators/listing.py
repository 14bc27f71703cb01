"""Features of item listings as one long table, and the price model on them."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import LISTING_STOP_WORDS, compose, exploded, ngrams, normalise_units, path_levels, path_pair
from granary.session import durable

#: Listings of a part: each becomes some hundred features, and their table may be one small file.
PER_PART = 10_000


def _named(block: str, values: Column) -> Column:
    return F.transform(values, lambda v: F.concat(F.lit(f"{block}="), v))


def blocks() -> dict[str, Column]:
    """The feature blocks of a listing, each an array of texts.

    Expects the columns name, category, brand, condition and shipping, and the word array
    ``_words`` of the name.
    """
    general, sub, leaf = path_levels(F.col("category"))
    pair = path_pair(F.col("category"))
    condition = F.col("condition").cast("string")
    return {
        "name": F.concat(F.col("_words"), ngrams(F.col("_words"), 2)),
        "category": F.array(general, sub, leaf, pair),
        "brand": F.filter(F.array("brand"), lambda b: b.isNotNull()),
        "general_condition": F.array(F.concat_ws("_", general, condition)),
        "has_brand": F.array(F.col("brand").isNotNull().cast("int").cast("string")),
        "shipping": F.array(F.col("shipping").cast("string")),
        "condition": F.array(condition),
    }


def all_blocks() -> dict[str, Column]:
    """The blocks of :func:`blocks`, both lower category levels with the condition, and the description's n-grams.

    Expects the word array ``_said`` of the description as well.
    """
    _, sub, leaf = path_levels(F.col("category"))
    condition, said = F.col("condition").cast("string"), F.col("_said")
    return blocks() | {
        "sub_condition": F.array(F.concat_ws("_", sub, condition)),
        "leaf_condition": F.array(F.concat_ws("_", leaf, condition)),
        "description": F.concat(said, ngrams(said, 2), ngrams(said, 3)),
    }


def with_features(df: DataFrame, of=blocks) -> DataFrame:
    """Add the array ``features`` of ``block=value`` texts of all blocks side by side."""
    plain = lambda text: F.filter(F.split(text, " "), lambda w: ~w.isin(*LISTING_STOP_WORDS))
    staged = df.withColumn("_words", plain("name"))
    if of is all_blocks:
        staged = staged.withColumn("_said", F.filter(plain("description"), lambda w: w != ""))
    parts = [_named(name, values) for name, values in of().items()]
    return staged.withColumn("features", F.concat(*parts)).drop("_words", "_said")


def dealt_out(df: DataFrame, item: str) -> DataFrame:
    """Listings in parts whose number follows theirs, so that a part's features stay as many."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(parts, math.ceil(df.count() / PER_PART)), item)


def feature_table(df: DataFrame, item: str, min_df: int = 2, of=blocks) -> DataFrame:
    """(item, feature, count) rows of features seen in at least ``min_df`` items."""
    # listings of one item lie together already, so their features are counted where they are
    long = exploded(with_features(dealt_out(df, item), of), [item], F.col("features"), "feature")
    counts = durable(long.groupBy(item, "feature").agg(F.count(F.lit(1)).alias("n")))
    kept = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("_df")).filter(F.col("_df") >= min_df).select("feature")
    return counts.join(kept, "feature", "left_semi")


def fill_brands(df: DataFrame, item: str) -> DataFrame:
    """Missing brands from the name: the first pair of words that is a brand of another listing, else the first word."""
    brand = F.nullif(F.trim("brand"), F.lit(""))
    staged = df.withColumn("_words", F.split(F.trim("name"), r"\s+"))
    known = df.select(brand.alias("_brand")).where("_brand IS NOT NULL").distinct()
    grams = F.concat(ngrams(F.col("_words"), 2), F.col("_words"))
    said = staged.where(brand.isNull()).select(item, F.posexplode(grams).alias("_at", "_brand")).join(known, "_brand")
    found = said.groupBy(item).agg(F.min_by("_brand", "_at").alias("_brand"))
    return df.join(found, item, "left").withColumn("brand", F.coalesce(brand, "_brand")).select(*df.columns)


def prepare_listings(df: DataFrame) -> DataFrame:
    """Drop free items, lower and fill the texts, and normalise units."""
    priced = df.filter(F.col("price").isNull() | (F.col("price") > 0))
    return priced.withColumns(
        {
            "category": F.lower(F.coalesce("category", F.lit("other/other/other"))),
            "name": normalise_units(compose(F.col("name"))),
            "description": normalise_units(compose(F.col("description"))),
        }
    )


def price_model(train: DataFrame, target: str = "log_price", buckets: int = 2**16, penalty: float = 0.4):
    """Hashed features, idf weights, unit length and a ridge regression, all inside the JVM.

    Hashing needs no vocabulary on the driver, so the model size is set by ``buckets``.
    """
    rows = train.count()
    return Pipeline(
        stages=[
            HashingTF(inputCol="features", outputCol="_tf", numFeatures=buckets),
            IDF(inputCol="_tf", outputCol="_idf", minDocFreq=2),
            Normalizer(inputCol="_idf", outputCol="_x"),
            # the loss here is a mean, so the penalty on a sum is divided by the rows
            LinearRegression(
                featuresCol="_x", labelCol=target, regParam=penalty / max(rows, 1), elasticNetParam=0.0,
                solver="l-bfgs", maxIter=60, standardization=False,
            ),
        ]
    ).fit(train)
