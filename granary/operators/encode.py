"""Categorical encodings and binning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators.quantiles import exact_quantiles
from granary.operators.skew import attach, number_rows


def lump_rare(
    df: DataFrame,
    column: str,
    share: float | None = None,
    top: int | None = None,
    other: str = "Other",
    missing: str | None = None,
) -> DataFrame:
    """Fold rare levels into ``other``: below a share of all rows, or outside the ``top`` most frequent.

    Only the kept levels are matched to the rows: fewer than ``1 / share`` or ``top`` rows.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    if share is not None:
        total = df.agg(F.count(F.lit(1))).scalar()
        kept = counts.filter(F.col("_n") / total >= share)
    else:
        kept = counts.orderBy(F.col("_n").desc(), column).limit(top)
    kept = kept.select(F.col(column).alias("_kept"))
    folded = F.when(F.col(column).isNull(), F.lit(missing)).otherwise(F.coalesce("_kept", F.lit(other)))
    marked = df.join(F.broadcast(kept), F.col(column) == F.col("_kept"), "left")
    return marked.withColumn(column, folded).drop("_kept")


def factorize(df: DataFrame, column: str, order: str) -> DataFrame:
    """Levels with codes 0, 1, ... in order of first appearance along a unique ``order``."""
    first = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.min(order).alias("_first"))
    numbered = number_rows(first, ["_first"], "code")
    return numbered.select(column, (F.col("code") - 1).alias("code"))


def factorize_many(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """(column, value, code) of several text columns, coded as by :func:`factorize`, from one pass over the rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    long = df.select(order, pairs.alias("_p")).select(order, "_p.*").filter(F.col("value").isNotNull())
    first = long.groupBy("column", "value").agg(F.min(order).alias("_first"))
    return number_rows(first, ["_first"], "code", ["column"]).select("column", "value", (F.col("code") - 1).alias("code"))


def apply_many_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace the columns by their codes; missing and unseen values get -1."""
    for c in columns:
        own = codes.filter(F.col("column") == c).select(F.col("value").alias(c), "code")
        df = apply_codes(df, own, c, f"_{c}").drop(c).withColumnRenamed(f"_{c}", c)
    return df


def apply_codes(df: DataFrame, codes: DataFrame, column: str, name: str) -> DataFrame:
    """Attach the codes; missing and unseen values get -1."""
    coded = attach(df, codes.select(column, F.col("code").alias("_code")), [column])
    return coded.withColumn(name, F.coalesce("_code", F.lit(-1).cast("long"))).drop("_code")


def label_encode(tables: Sequence[DataFrame], column: str) -> DataFrame:
    """Alphabetical codes over the levels of several tables together."""
    levels = None
    for t in tables:
        part = t.select(column).filter(F.col(column).isNotNull()).distinct()
        levels = part if levels is None else levels.union(part)
    numbered = number_rows(levels.distinct(), [column], "code")
    return numbered.select(column, (F.col("code") - 1).alias("code"))


def one_hot(df: DataFrame, column: str, levels: Sequence, prefix: str, drop_first: bool = False) -> DataFrame:
    """One 0/1 column per listed level; missing values are zero everywhere."""
    chosen = list(levels)[1:] if drop_first else list(levels)
    flags = {f"{prefix}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)) for v in chosen}
    return df.withColumns(flags)


def levels_of(df: DataFrame, column: str) -> list:
    """Sorted distinct levels for a pivot or one-hot, one output column each; long tables need none."""
    return sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().collect())


def target_means(train: DataFrame, column: str, target: Column) -> DataFrame:
    """Mean target per level, fitted on the training rows."""
    return train.filter(F.col(column).isNotNull()).groupBy(column).agg(F.avg(target).alias("encoded"))


def fixed_bins(value: Column, edges: Sequence[float]) -> Column:
    """Right-closed bin number; the lowest edge itself and values outside give NULL."""
    chain = None
    for i, (low, high) in enumerate(zip(edges, edges[1:])):
        inside = (value > F.lit(low)) & (value <= F.lit(high))
        chain = F.when(inside, F.lit(i)) if chain is None else chain.when(inside, F.lit(i))
    return chain


def quantile_bins(df: DataFrame, column: str, bins: int, name: str = "bin") -> DataFrame:
    """Right-closed bins between exact percentiles; the minimum falls outside, as with open low edges."""
    cuts = exact_quantiles(df, [], {column: {f"q{i}": i / bins for i in range(bins + 1)}}).first()
    edges = [cuts[f"q{i}"] for i in range(bins + 1)]
    return df.withColumn(name, fixed_bins(F.col(column), edges))


def model_matrix(df: DataFrame, categorical: str, numeric: Sequence[str], share: float, digits: int = 4) -> DataFrame:
    """Lumped one-hot columns and standardised numeric columns, ready for a linear model."""
    lumped = lump_rare(df, categorical, share=share, missing="(missing)")
    levels = levels_of(lumped, categorical)
    coded = one_hot(lumped, categorical, levels, categorical, drop_first=True).drop(categorical)
    out = coded
    for c in numeric:
        mean, std = df.agg(F.avg(c)).scalar(), df.agg(F.stddev_samp(c)).scalar()
        out = out.withColumn(c, (F.col(c) - mean) / F.nullif(std, F.lit(0.0)))
    return out
