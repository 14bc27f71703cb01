"""Vector jobs: decomposition, clustering and topics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.text import top_terms
from granary.session import durable


def _dot(vector: str, weights: Sequence[float]) -> Column:
    products = F.zip_with(F.col(vector), F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)


def product_matrix(df: DataFrame, vector: str) -> np.ndarray:
    """Sum of outer products of all vectors, the size of one vector squared.

    Each task adds up its own rows and sends one matrix; Spark adds the matrices.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for pdf in batches:
            if len(pdf):
                x = np.stack(pdf["v"].to_numpy()).astype(float)
                total = x.T @ x if total is None else total + x.T @ x
        if total is not None:
            yield pd.DataFrame({"i": range(len(total)), "row": list(total)})

    parts = df.select(F.col(vector).cast("array<double>").alias("v")).mapInPandas(partial, "i INT, row ARRAY<DOUBLE>")
    cells = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    rows = cells.collect()
    size = max((r["i"] for r in rows), default=-1) + 1
    out = np.zeros((size, size))
    for r in rows:
        out[r["i"], r["j"]] = r["x"]
    return out


def truncated_svd(df: DataFrame, id_col: str, vector: str, k: int) -> DataFrame:
    """Scores on the first ``k`` right singular vectors; each vector's largest entry is positive."""
    values, vectors = np.linalg.eigh(product_matrix(df, vector))
    staged = df.select(id_col, F.col(vector).cast("array<double>").alias("_v"))
    out = []
    for i in np.argsort(values)[::-1][:k]:
        axis = vectors[:, i]
        axis = axis * np.sign(axis[np.argmax(np.abs(axis))])
        out.append(_dot("_v", axis).alias(f"component_{len(out) + 1}"))
    return staged.select(id_col, *out)


def kmeans(df: DataFrame, id_col: str, vector: str, k: int, seed: int) -> DataFrame:
    """Cluster of each row and its distance to the cluster centre."""
    staged = df.withColumn("_x", array_to_vector(F.col(vector).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_x", predictionCol="cluster").fit(staged)
    assigned = model.transform(staged).withColumn("_v", vector_to_array("_x"))
    centres = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])
    gaps = F.zip_with("_v", F.element_at(centres, F.col("cluster") + 1), lambda a, b: (a - b) * (a - b))
    return assigned.select(id_col, "cluster", F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda s, v: s + v)).alias("distance"))


def group_means(df: DataFrame, group: str, vector: str, size: int) -> dict[int, list[float]]:
    """Mean vector per group; the caller's groups are the centres of a model, so they are few."""
    at = [F.avg(F.col(vector)[i].cast("double")) for i in range(size)]
    rows = df.groupBy(group).agg(F.array(*at).alias("m")).orderBy(group).collect()
    return {r[group]: list(r["m"]) for r in rows}


def nearest_centroid(df: DataFrame, id_col: str, vector: str, centres: dict[int, list[float]]) -> DataFrame:
    """Nearest given centre and its distance, by one expression per row."""
    table = F.array(
        *[F.struct(F.lit(k).alias("c"), F.array(*[F.lit(x) for x in v]).alias("v")) for k, v in centres.items()]
    )
    staged = df.select(id_col, F.col(vector).cast("array<double>").alias("_v"))

    def distance(centre: Column) -> Column:
        gaps = F.zip_with(F.col("_v"), centre["v"], lambda a, b: (a - b) * (a - b))
        return F.aggregate(gaps, F.lit(0.0), lambda s, v: s + v)

    best = F.array_min(F.transform(table, lambda c: F.struct(F.round(distance(c), 9).alias("d"), c["c"].alias("c"))))
    out = staged.select(id_col, best.alias("_b"))
    return out.select(id_col, F.col("_b.c").alias("centroid"), F.sqrt("_b.d").alias("distance"))


def text_clusters(df: DataFrame, id_col: str, words: Column, k: int, seed: int, buckets: int = 1 << 18) -> DataFrame:
    """K-means on hashed, idf-weighted, unit-length word counts."""
    staged = df.select(id_col, words.alias("_w"))
    prepared = Pipeline(
        stages=[
            HashingTF(inputCol="_w", outputCol="_tf", numFeatures=buckets),
            IDF(inputCol="_tf", outputCol="_idf"),
            Normalizer(inputCol="_idf", outputCol="_x"),
        ]
    ).fit(staged).transform(staged)
    # the passes of the clustering read the finished vectors, not the texts
    table = durable(prepared.select(id_col, "_x"))
    model = KMeans(k=k, seed=seed, featuresCol="_x", predictionCol="cluster", maxIter=10).fit(table)
    return model.transform(table).select(id_col, "cluster")


def cluster_terms(weights: DataFrame, clusters: DataFrame, id_col: str, k: int) -> DataFrame:
    """Terms with the largest mean weight in each cluster."""
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"))
    sums = weights.join(clusters, id_col).groupBy("cluster", "term").agg(F.sum("weight").alias("_s"))
    means = sums.join(sizes, "cluster").select("cluster", "term", (F.col("_s") / F.col("_n")).alias("weight"))
    return top_terms(means, ["cluster"], "weight", k)
