"""Join shapes, set operations and limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import exploded
from granary.operators.skew import attach


def join_features(entity: DataFrame, features: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join feature tables, each with one row per key.

    The tables are aggregated by the key beforehand, so they already have its partitioning
    and only the entity table is moved.
    """
    return reduce(lambda left, right: left.join(right, key, "left"), features, entity)


def star_join(fact: DataFrame, dimensions: Sequence[tuple[DataFrame, Mapping[str, str], str]]) -> DataFrame:
    """Left-join dimensions given as (table, {fact column: dimension column}, prefix).

    Dimension columns get the prefix, so equal names never collide. Duplicate dimension
    keys repeat the fact row, as several events on one date do.
    """
    out = fact
    for dim, on, prefix in dimensions:
        renamed = dim.select(*[F.col(c).alias(f"{prefix}{c}") for c in dim.columns])
        condition = reduce(lambda a, b: a & b, [F.col(f) == F.col(f"{prefix}{d}") for f, d in on.items()])
        out = out.join(renamed, condition, "left").drop(*[f"{prefix}{d}" for d in on.values()])
    return out


def to_template(template: DataFrame, values: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """One row per required id; ids without a value get the defaults."""
    return values.join(template.select(key).distinct(), key, "right").fillna(dict(defaults))


def overlay(base: DataFrame, patch: DataFrame, key: str, column: str) -> DataFrame:
    """Replace ``column`` where the patch has the key; keep the base value elsewhere."""
    new = patch.select(key, F.col(column).alias("_new"))
    merged = base.join(new, key, "left")
    return merged.withColumn(column, F.coalesce("_new", F.col(column))).drop("_new")


def map_values(df: DataFrame, column: str, dictionary: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Look a column up in a two-column dictionary; unknown codes give NULL."""
    return attach(df, dictionary.select(F.col(key).alias(column), F.col(value).alias(name)), [column])


def calendar_spine(df: DataFrame, day: str) -> DataFrame:
    """Every day from the first to the last one of a table."""
    span = df.agg(F.min(day).alias("_a"), F.max(day).alias("_b"))
    return span.select(F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 DAY"))).alias(day))


def fill_periods(df: DataFrame, keys: Sequence[str], period: str, periods: Sequence, measures: Sequence[str]) -> DataFrame:
    """Add zero rows for the periods a key lacks."""
    wanted = df.select(*keys).distinct().withColumn(period, F.explode(F.array(*[F.lit(p) for p in periods])))
    return wanted.join(df, [*keys, period], "left").fillna(0, subset=list(measures))


def flag_split(entity: DataFrame, flags: DataFrame, key: str, flag: str) -> tuple[DataFrame, DataFrame]:
    """Split by a looked-up flag; entities without a flag row belong to the unflagged side."""
    marked = entity.join(flags.select(key, flag), key, "left")
    hit = F.col(flag).eqNullSafe(F.lit(1))
    return marked.filter(hit), marked.filter(~hit)


def fill_from_dictionary(
    df: DataFrame,
    item: str,
    target: str,
    texts: Sequence[str],
    word: str,
) -> DataFrame:
    """Fill a missing brand from the first known brand found in the texts.

    Two-word brands are looked for at the start of each text, in the order of ``texts``;
    then one-word brands anywhere, again text by text and from left to right. Only rows
    with a missing brand are tokenised. ``word`` is the pattern of one token.
    """
    known = df.select(F.col(target).alias("_brand")).filter("_brand IS NOT NULL AND _brand <> ''").distinct()
    gaps = df.filter(F.col(target).isNull() | (F.col(target) == ""))
    def entry(rank: int, at: Column, text: Column) -> Column:
        return F.struct(F.lit(rank).alias("rank"), at.alias("at"), text.alias("text"))

    def every_word(rank: int, text: Column) -> Column:
        return F.transform(F.regexp_extract_all(text, F.lit(f"({word})"), 1), lambda w, at: entry(rank, at, w))

    sources = [F.coalesce(F.col(t), F.lit("")) for t in texts]
    candidates = [
        F.array(entry(i, F.lit(0), F.regexp_extract(t, f"^{word}\\s{word}", 0))) for i, t in enumerate(sources)
    ]
    candidates += [every_word(len(sources) + i, t) for i, t in enumerate(sources)]
    offered = exploded(gaps, [item], F.concat(*candidates), "c").select(item, "c.*").filter("text <> ''")
    found = (
        offered.join(known, F.col("text") == F.col("_brand"))
        .groupBy(item)
        .agg(F.min_by("text", F.struct("rank", "at")).alias("_found"))
    )
    return df.join(found, item, "left").withColumn(target, F.coalesce(F.nullif(F.col(target), F.lit("")), "_found")).drop("_found")


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found on exactly one side; one shuffle."""
    sides = left.withColumn("_l", F.lit(1)).withColumn("_r", F.lit(0)).unionByName(
        right.withColumn("_l", F.lit(0)).withColumn("_r", F.lit(1))
    )
    per = sides.groupBy(*left.columns).agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    return per.filter(F.col("_l") + F.col("_r") == 1).drop("_l", "_r")


def rows_occurring_once(stacked: DataFrame) -> DataFrame:
    """Rows that occur exactly once in a stacked table."""
    return stacked.groupBy(*stacked.columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n = 1").drop("_n")


def top_with_ties(df: DataFrame, measure: str, k: int) -> DataFrame:
    """The k largest rows and every row equal to the last of them.

    The k-th value is found by a bounded top-k, so no global ranking is needed.
    """
    least = df.orderBy(F.col(measure).desc()).limit(k).agg(F.min(measure)).scalar()
    return df.filter(F.col(measure) >= least)


def drop_last(df: DataFrame, key: str, order: Column, k: int) -> DataFrame:
    """All rows but those of the last ``k`` keys along ``order``."""
    last = df.orderBy(order.desc(), F.col(key).desc()).limit(k).select(F.col(key).alias("_last"))
    return df.join(last, F.col(key) == F.col("_last"), "left_anti")


def most_frequent_levels(df: DataFrame, column: str, k: int) -> DataFrame:
    """Rows whose level is among the ``k`` most frequent."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    kept = counts.orderBy(F.col("_n").desc(), column).limit(k).select(F.col(column).alias("_kept"))
    # k rows by construction
    return df.join(F.broadcast(kept), F.col(column) == F.col("_kept"), "left_semi")
