"""Ordered and grouped work that stays balanced when one key holds much of the table.

A plain window sends a whole key to one task. Here the rows are dealt out by ranges of (keys,
order), so that a key of any size is cut into consecutive pieces of even size; each piece is
scanned on its own, and the totals of the pieces (a row for each piece and key) are added back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.session import durable


def with_pieces(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "_piece") -> DataFrame:
    """``df`` in range partitions along (keys, order), with the partition's number.

    Written to the shared folder, so that every use sees the same pieces.
    """
    return durable(df.repartitionByRange(*keys, *order).withColumn(name, F.spark_partition_id()))


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Running sums within ``keys`` along the ascending, unique ``order`` columns."""
    placed = with_pieces(df.select("*", *[e.alias(f"_v_{n}") for n, e in sums.items()]), keys, order)
    window = Window.partitionBy(*keys, "_piece").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.select("*", *[F.sum(f"_v_{n}").over(window).alias(f"_l_{n}") for n in sums])
    # a row for each piece and key: what the pieces before it add
    before = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*keys, "_piece").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    offsets = totals.select(*keys, "_piece", *[F.sum(f"_t_{n}").over(before).alias(f"_o_{n}") for n in sums])
    joined = attach(local, offsets, [*keys, "_piece"])
    result = [
        F.when(
            F.col(f"_l_{n}").isNotNull() | F.col(f"_o_{n}").isNotNull(),
            F.coalesce(F.col(f"_l_{n}"), F.lit(0)) + F.coalesce(F.col(f"_o_{n}"), F.lit(0)),
        ).alias(n)
        for n in sums
    ]
    return joined.select(*df.columns, *result)


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_no", keys: Sequence[str] = ()) -> DataFrame:
    """1-based row number within ``keys`` (or over the whole table) along ``order``."""
    return running_sums(df, keys, order, {name: F.lit(1).cast("long")})


def attach(df: DataFrame, summary: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Give every row the values of its group.

    The group table is aggregated map-side first. The join carries no hint: Spark
    broadcasts the summary when its measured size allows and otherwise joins by key,
    where adaptive execution splits a hot key's rows. A NULL key matches its own group.
    """
    renamed = summary.select(
        *[F.col(k).alias(f"_g_{k}") for k in keys], *[c for c in summary.columns if c not in keys]
    )
    condition = None
    for k in keys:
        term = F.col(k).eqNullSafe(F.col(f"_g_{k}"))
        condition = term if condition is None else condition & term
    return df.join(renamed, condition, how).drop(*[f"_g_{k}" for k in keys])
