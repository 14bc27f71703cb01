"""Samples, hold-outs and folds. A row's side depends on its key alone, never on partitioning."""

from __future__ import annotations

import random
from collections.abc import Sequence
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.numeric import arithmetic_hash
from granary.operators.skew import number_rows
from granary.session import durable

_SCALE = 1_000_000


def sample_rows(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows in hash order: a bounded top-n, no shuffle of the table."""
    h = arithmetic_hash(F.col(key), seed, 2_147_483_647)
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def in_fraction(key: Column, fraction: float, seed: int) -> Column:
    return arithmetic_hash(key, seed) < int(fraction * _SCALE)


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """A share of the rows and its complement."""
    inside = in_fraction(F.col(key), fraction, seed)
    return df.filter(inside), df.filter(~inside)


def vertical_split(df: DataFrame, key: str, fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """Random split of the columns into two tables that share the key."""
    columns = [c for c in df.columns if c != key]
    random.Random(seed).shuffle(columns)
    cut = round(len(columns) * fraction)
    return df.select(key, *columns[:cut]), df.select(key, *columns[cut:])


def time_split(df: DataFrame, ts: str, cut: Column) -> tuple[DataFrame, DataFrame]:
    """Rows up to and including the cut, and rows after it."""
    return df.filter(F.col(ts) <= cut), df.filter(F.col(ts) > cut)


def fold(key: Column, k: int, seed: int) -> Column:
    """Fold number of a key."""
    return F.pmod(arithmetic_hash(key, seed), F.lit(k)).cast("int")


def stratified_folds(df: DataFrame, key: str, stratum: str, k: int, seed: int) -> DataFrame:
    """Folds dealt round-robin within each stratum in hash order, so every fold has its share."""
    hashed = df.withColumn("_h", arithmetic_hash(F.col(key), seed))
    numbered = number_rows(hashed, ["_h", key], "_r", [stratum])
    return numbered.withColumn("fold", F.pmod(F.col("_r"), F.lit(k)).cast("int")).drop("_h", "_r")


def split_seed(seed: int, r: int) -> int:
    """Seed of the r-th split; it changes the factors of the hash, so the splits are unrelated."""
    return (seed + 1) * 7919 + r * 104_729


def repeated_splits(df: DataFrame, key: str, repeats: int, test_fraction: float, seed: int) -> DataFrame:
    """Membership rows (split, key, role) of independent random splits."""
    splits = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(r).alias("split"),
                    F.when(in_fraction(F.col(key), test_fraction, split_seed(seed, r)), "test").otherwise("train").alias("role"),
                )
                for r in range(repeats)
            ]
        )
    )
    return df.select(key, splits.alias("_s")).select("_s.split", key, "_s.role")


def leave_one_out(df: DataFrame, key: str) -> DataFrame:
    """One split per row. Only the left-out row is listed; all others train."""
    return number_rows(df.select(key), [key], "split").select((F.col("split") - 1).alias("split"), F.col(key).alias("test_key"))


def leave_p_out(df: DataFrame, key: str, p: int) -> DataFrame:
    """Every choice of ``p`` left-out keys, numbered from 0 in the order of the sorted keys.

    The choices are not listed anywhere: a split's number is turned into its places in the
    tasks, by counting the choices before it, and the places are joined with the numbered keys.
    """
    numbered = number_rows(df.select(key).where(F.col(key).isNotNull()).distinct(), [key], "_no").select(F.col(key).alias("test_key"), (F.col("_no") - 1).alias("_place"))
    numbered = durable(numbered)
    n = numbered.count()
    total = comb(n, p)
    if total >= 1 << 63:
        raise ValueError(f"{total} choices have no number of 64 bits")
    # choices of q places among those from i on, for every i
    below = [np.array([comb(n - i, q) for i in range(n + 1)], np.int64) for q in range(p + 1)]

    @F.pandas_udf("array<long>")
    def places(numbers: pd.Series) -> pd.Series:
        rest, at, out = numbers.to_numpy(np.int64).copy(), np.zeros(len(numbers), np.int64), []
        for q in range(p, 0, -1):
            # the last place whose earlier alternatives are at most ``rest``
            found = np.searchsorted(-below[q], rest - below[q][at], side="right") - 1
            rest -= below[q][at] - below[q][found]
            out.append(found)
            at = found + 1
        return pd.Series(list(np.stack(out, axis=1)))

    chosen = df.sparkSession.range(total).select(F.col("id").alias("split"), F.explode(places("id")).alias("_place"))
    return chosen.join(numbered, "_place").select("split", "test_key")


def expanding_splits(df: DataFrame, order: str, k: int) -> DataFrame:
    """Time-ordered splits: split i trains on everything before its test block.

    Blocks have ``n // (k + 1)`` rows; the first block takes the remainder.
    """
    numbered = number_rows(df, [order], "_r")
    total = df.agg(F.count(F.lit(1))).scalar()
    size = F.floor(total / F.lit(k + 1)).cast("long")
    first = total - size * k
    block = F.when(F.col("_r") <= first, F.lit(0)).otherwise(F.floor((F.col("_r") - first - 1) / size) + 1).cast("int")
    staged = numbered.select(order, block.alias("_b")).withColumn("split", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    role = F.when(F.col("_b") <= F.col("split"), "train").when(F.col("_b") == F.col("split") + 1, "test")
    return staged.withColumn("role", role).filter(F.col("role").isNotNull()).select("split", order, "role")


def disjoint_parts(key: Column, shares: Sequence[tuple[str, float]], seed: int) -> Column:
    """Name of the part a key belongs to; shares add up to one."""
    h, chain, edge = arithmetic_hash(key, seed), None, 0.0
    for name, share in shares[:-1]:
        edge += share
        hit = h < int(round(edge * _SCALE))
        chain = F.when(hit, name) if chain is None else chain.when(hit, name)
    return chain.otherwise(shares[-1][0])
