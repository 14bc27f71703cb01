"""Table profiles: one aggregate pass over all columns, reshaped to one row per column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.numeric import correlation, fixed
from granary.operators.quantiles import exact_quantiles


def _stack(df: DataFrame, entries: Sequence[dict[str, Column]]) -> DataFrame:
    """One row of aggregates to one row per entry."""
    rows = F.array(*[F.struct(*[v.alias(k) for k, v in e.items()]) for e in entries])
    return df.select(F.explode(rows).alias("_r")).select("_r.*")


def missing_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing count and percentage per column, most missing first."""
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_m_{c}") for c in columns])
    out = _stack(
        one,
        [
            {
                "column": F.lit(c),
                "missing": F.col(f"_m_{c}"),
                "percent": F.col(f"_m_{c}") * 100.0 / F.nullif(F.col("_n"), F.lit(0)),
            }
            for c in columns
        ],
    )
    return out.orderBy(F.col("missing").desc(), "column")


def constant_columns(df: DataFrame, columns: Sequence[str], null_is_value: bool = True, keep: Sequence[str] = ()) -> list[str]:
    """Columns that carry a single value, decided by one pass of minima and maxima.

    With ``null_is_value`` a column that is partly missing is not constant; without it,
    missing values are ignored (an all-missing column counts as constant either way).
    """
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"lo_{c}"), F.max(c).alias(f"hi_{c}"), F.count(c).alias(f"n_{c}")]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *aggs).first()
    out = []
    for c in columns:
        single = row[f"lo_{c}"] == row[f"hi_{c}"]
        whole = row[f"n_{c}"] in (0, row["rows"])
        if c not in keep and single and (whole or not null_is_value):
            out.append(c)
    return out


def drop_constant_columns(df: DataFrame, null_is_value: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    return df.drop(*constant_columns(df, df.columns, null_is_value, keep))


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max and missing share of numeric columns."""
    wanted = {c: {f"{c}__q{i}": i / 4 for i in (1, 2, 3)} for c in columns}
    quartiles = exact_quantiles(df, [], wanted).first()
    aggs = []
    for c in columns:
        aggs += [
            F.count(c).alias(f"{c}__n"),
            F.avg(c).alias(f"{c}__mean"),
            F.stddev_samp(c).alias(f"{c}__std"),
            F.min(c).cast("double").alias(f"{c}__min"),
            F.max(c).cast("double").alias(f"{c}__max"),
        ]
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *aggs)

    def entry(c: str) -> dict[str, Column]:
        known = {f"q{i}": F.lit(quartiles[f"{c}__q{i}"]).cast("double") for i in (1, 2, 3)}
        measured = {f: F.col(f"{c}__{f}") for f in ("mean", "std", "min", "max")}
        return {
            "column": F.lit(c),
            "count": F.col(f"{c}__n"),
            **{f: fixed(v, 3) for f, v in {**measured, **known}.items()},
            "missing_share": fixed(1 - F.col(f"{c}__n") / F.nullif(F.col("__rows"), F.lit(0))),
        }

    return _stack(one, [entry(c) for c in columns])


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column.

    The exact form first reduces each column to its distinct values, so no task ever holds
    a whole column.
    """
    if approximate:
        one = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return _stack(one, [{"column": F.lit(c), "distinct": F.col(c)} for c in columns])
    long = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in columns])).alias("_r")
    ).select("_r.*")
    levels = long.filter(F.col("v").isNotNull()).distinct()
    return levels.groupBy("column").agg(F.count(F.lit(1)).alias("distinct"))


def classify_columns(df: DataFrame, columns: Sequence[str], limit: int = 25) -> DataFrame:
    """Categorical below ``limit`` distinct values, else continuous.

    A mergeable sketch rules out the wide columns; only the narrow ones, whose value sets
    are small, are counted exactly.
    """
    rough = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    narrow = [c for c in columns if rough[c] < 2 * limit]
    exact = df.agg(F.count(F.lit(1)).alias("_n"), *[F.size(F.collect_set(c)).alias(c) for c in narrow])
    kind = {c: F.when(F.col(c) < limit, "categorical").otherwise("continuous") for c in narrow}
    return _stack(exact, [{"column": F.lit(c), "kind": kind.get(c, F.lit("continuous"))} for c in columns])


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys on each side and on both, with a single shuffle of the keys."""
    flagged = left.select(F.col(key).alias("k"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(F.col(key).alias("k"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    per = flagged.filter(F.col("k").isNotNull()).groupBy("k").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return per.agg(
        F.sum("l").alias("left_keys"),
        F.sum("r").alias("right_keys"),
        F.sum(F.col("l") * F.col("r")).alias("common_keys"),
    )


def nonzero_share(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Share of rows, and of entities, with a positive measure."""
    per = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(measure) > 0).alias("hit"),
    )
    return per.agg(
        (F.sum("hit") / F.sum("n")).alias("row_share"),
        F.avg((F.col("hit") > 0).cast("double")).alias("entity_share"),
    )


def sigma_outliers(df: DataFrame, column: str, width: float = 3.0) -> DataFrame:
    """Bounds at ``width`` population standard deviations and the rows beyond them."""
    mean = df.agg(F.avg(column)).scalar()
    std = df.agg(F.stddev_pop(column)).scalar()
    low, high = mean - F.lit(width) * std, mean + F.lit(width) * std
    x = F.col(column)
    bounded = df.select(x, low.alias("lower_bound"), high.alias("upper_bound"))
    return bounded.groupBy("lower_bound", "upper_bound").agg(
        F.count_if(x < F.col("lower_bound")).alias("below"),
        F.count_if(x > F.col("upper_bound")).alias("above"),
        F.count(column).alias("total"),
    )


def box_statistics(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Quartiles and the 1.5 inter-quartile fences per group."""
    q = exact_quantiles(df, keys, {value: {"q1": 0.25, "median": 0.5, "q3": 0.75}})
    iqr = F.col("q3") - F.col("q1")
    return q.withColumns({"lower_fence": F.col("q1") - 1.5 * iqr, "upper_fence": F.col("q3") + 1.5 * iqr})


def correlation_pairs(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """Pearson correlation of every pair of columns (pairwise complete), one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = df.agg(*[correlation(F.col(a), F.col(b)).alias(f"{a}~{b}") for a, b in pairs])
    return _stack(
        one,
        [{"left": F.lit(a), "right": F.lit(b), "corr": fixed(F.col(f"`{a}~{b}`"), digits)} for a, b in pairs],
    )


_RANGES = (("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64))


def narrow_types(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest type that holds each numeric column, from one pass of minima and maxima."""
    types = dict(df.dtypes)
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"{c}__lo"), F.max(x).alias(f"{c}__hi")]
    one = df.agg(*aggs)

    def suggestion(c: str) -> Column:
        lo, hi = F.col(f"{c}__lo"), F.col(f"{c}__hi")
        if types[c] in ("double", "float"):
            single = F.lit(3.4028234663852886e38)  # largest single-precision value
            return F.when((lo >= -single) & (hi <= single), "float").otherwise("double")
        chain = None
        for name, bits in _RANGES[:-1]:
            fits = (lo >= float(-(2 ** (bits - 1)))) & (hi <= float(2 ** (bits - 1) - 1))
            chain = F.when(fits, name) if chain is None else chain.when(fits, name)
        return chain.otherwise("bigint")

    return _stack(
        one,
        [
            {
                "column": F.lit(c),
                "min_value": F.col(f"{c}__lo") + F.lit(0.0),
                "max_value": F.col(f"{c}__hi") + F.lit(0.0),
                "suggested_type": suggestion(c),
            }
            for c in columns
        ],
    )


def apply_types(df: DataFrame, suggestions: DataFrame) -> DataFrame:
    """Cast the columns to the suggested types (one row per column, so a small action)."""
    chosen = {r["column"]: r["suggested_type"] for r in suggestions.select("column", "suggested_type").collect()}
    return df.withColumns({c: F.col(c).cast(t) for c, t in chosen.items()})
