"""Window-style features.

Series of a panel hold at most one row per calendar period, so plain windows over a series
are bounded. Event tables are not: their running values go through ``skew.running_sums``
and their group values through an aggregate joined back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from granary.operators.skew import attach, number_rows, running_sums
from granary.session import durable


def running_index(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """1-based position of a row within its group along a unique order."""
    return number_rows(df, order, name, keys)


def attach_aggregates(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column]) -> DataFrame:
    """Aggregates of a row's group on every row; rows with a missing key get NULL."""
    summary = df.dropna(subset=list(keys)).groupBy(*keys).agg(*[e.alias(n) for n, e in aggregates.items()])
    # written, so that the size of a small one is known before any rows are dealt by its few keys
    return attach(df, durable(summary), keys)


def running_product(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Product of all values so far.

    Kept as a sum of logarithms beside counts of zeros and of negative factors, so pieces
    of a large key combine by addition.
    """
    size = F.abs(value.cast("double"))
    sums = {
        "_log": F.when(size > 0, F.ln(size)).otherwise(F.when(value.isNotNull(), F.lit(0.0))),
        "_zeros": (value == 0).cast("long"),
        "_minus": (value < 0).cast("long"),
    }
    out = running_sums(df, keys, order, sums)
    sign = F.when(F.col("_minus") % 2 == 1, -1.0).otherwise(1.0)
    product = F.when(F.col("_zeros") > 0, 0.0).otherwise(sign * F.exp("_log"))
    return out.withColumn(name, F.when(F.col("_log").isNotNull(), product)).drop(*sums)


def _series(keys: Sequence[str], order: str) -> Window:
    return Window.partitionBy(*keys).orderBy(order)


def trailing_mean(df: DataFrame, keys: Sequence[str], order: str, value: str, n: int, name: str) -> DataFrame:
    """Mean of the last ``n`` rows of a series; NULL until ``n`` values are there."""
    w = _series(keys, order).rowsBetween(-(n - 1), Window.currentRow)
    return df.withColumn(name, F.when(F.count(value).over(w) == n, F.avg(value).over(w)))


def lags(df: DataFrame, keys: Sequence[str], order: str, value: str, n: int, complete: bool = False) -> DataFrame:
    """Columns ``{value}_lag1`` ... ``{value}_lagN``; ``complete`` drops the rows without all of them."""
    w = _series(keys, order)
    out = df.select("*", *[F.lag(value, k).over(w).alias(f"{value}_lag{k}") for k in range(1, n + 1)])
    return out.dropna(subset=[f"{value}_lag{k}" for k in range(1, n + 1)]) if complete else out


def forward_fill(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """Last value seen so far in the series."""
    w = _series(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.last(value, ignorenulls=True).over(w))


def autocorrelations(df: DataFrame, keys: Sequence[str], order: str, value: str, n: int) -> DataFrame:
    """Autocorrelation at lags 1..n per series, around the series mean."""
    centred = df.withColumn("_c", F.col(value) - F.avg(value).over(Window.partitionBy(*keys)))
    w = _series(keys, order)
    staged = centred.select(*keys, "_c", *[F.lag("_c", k).over(w).alias(f"_l{k}") for k in range(1, n + 1)])
    total = F.sum(F.col("_c") * F.col("_c"))
    return staged.groupBy(*keys).agg(
        *[(F.sum(F.col("_c") * F.col(f"_l{k}")) / F.nullif(total, F.lit(0.0))).alias(f"acf_{k}") for k in range(1, n + 1)]
    )


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _partial(acf: pd.Series) -> pd.Series:
    def levels(r):
        if r is None or any(x is None or x != x for x in r):
            return None
        out, phi, r = [], np.zeros(0), np.asarray(r, dtype=float)
        for k in range(len(r)):
            below = 1.0 - float(phi @ r[:k])
            last = (r[k] - float(phi @ r[:k][::-1])) / below if below else 0.0
            phi = np.append(phi - last * phi[::-1], last)
            out.append(float(last))
        return out

    return acf.map(levels)


def partial_autocorrelations(acf: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """Partial autocorrelations of each series from its ``n`` autocorrelations, one short row per series."""
    staged = acf.select(*keys, _partial(F.array(*[F.col(f"acf_{k}") for k in range(1, n + 1)])).alias("_p"))
    return staged.select(*keys, *[F.col("_p")[k - 1].alias(f"pacf_{k}") for k in range(1, n + 1)])


def run_lengths(df: DataFrame, keys: Sequence[str], order: Sequence[str], bit: Column) -> DataFrame:
    """Runs of ones of an ordered 0/1 column: start position and length per run.

    Position minus the ones so far is constant inside a run, also across the pieces of a
    large key, and the runs then aggregate map-side.
    """
    one = F.coalesce(bit.cast("long"), F.lit(0).cast("long"))
    staged = df.select(*keys, *[c for c in order if c not in keys], one.alias("_bit"))
    placed = running_sums(staged, keys, order, {"_pos": F.lit(1).cast("long"), "_ones": F.col("_bit")})
    ones = placed.filter("_bit = 1").withColumn("_run", F.col("_pos") - F.col("_ones"))
    return ones.groupBy(*keys, "_run").agg(F.min("_pos").alias("start"), F.count(F.lit(1)).alias("length")).drop("_run")


def shares_within(df: DataFrame, group: Sequence[str], level: str) -> DataFrame:
    """Count of each level and its share of the group; the group totals come from the counts."""
    counts = df.dropna(subset=[*group, level]).groupBy(*group, level).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(*group).agg(F.sum("n").alias("_all"))
    return attach(counts, totals, group).select(*group, level, "n", (F.col("n") / F.col("_all")).alias("share"))
