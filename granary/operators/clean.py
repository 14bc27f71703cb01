"""Cleaning: missing values, types, constants, clipping and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.numeric import clip
from granary.operators.quantiles import exact_quantiles
from granary.operators.skew import attach
from granary.session import durable


def prefix_columns(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Prefix every column but the keys."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in keep})


def anonymise_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rename the non-key columns to ``x0``, ``x1``, ..."""
    rest = [c for c in df.columns if c not in keep]
    return df.withColumnsRenamed({c: f"x{i}" for i, c in enumerate(rest)})


def columns_missing_in(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns of ``left`` that ``right`` lacks."""
    return [c for c in left.columns if c not in set(right.columns)]


def columns_of_type(df: DataFrame, *types: str) -> list[str]:
    return [c for c, t in df.dtypes if t in types]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Not-a-number becomes NULL, which aggregates and group keys then skip."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def sentinels_to_null(df: DataFrame, sentinels: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Placeholder texts become NULL in all (or the listed) text columns."""
    chosen = columns or columns_of_type(df, "string")
    return df.withColumns({c: F.when(~F.col(c).isin(*sentinels), F.col(c)) for c in chosen})


def impute(df: DataFrame, defaults: Mapping[str, object], indicator: str | None = None) -> DataFrame:
    """Fill missing values with constants; ``indicator`` adds ``{indicator}{column}`` flags first."""
    if indicator is not None:
        df = df.withColumns({f"{indicator}{c}": F.col(c).isNotNull().cast("int") for c in defaults})
    return df.fillna(dict(defaults))


def complete_cases(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def drop_single_classes(df: DataFrame, column: str, at_least: int = 2) -> DataFrame:
    """Drop the rows of classes with fewer than ``at_least`` rows."""
    kept = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= at_least)
    return df.join(kept.select(F.col(column).alias("_kept")), F.col(column) == F.col("_kept"), "left_semi")


def stretch(df: DataFrame, group: Sequence[str], value: str, name: str, low: float = 0.05, high: float = 0.95) -> DataFrame:
    """Rescale each group's low..high percentiles to 0..1 and clamp."""
    bounds = durable(exact_quantiles(df, group, {value: {"_lo": low, "_hi": high}}))
    scaled = (F.col(value) - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))
    return attach(df, bounds, group).withColumn(name, clip(scaled, 0.0, 1.0)).drop("_lo", "_hi")


def min_max_scale(fit: DataFrame, df: DataFrame, columns: Sequence[str], low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Scale to [low, high] by the range found in ``fit``."""
    out = {}
    for c in columns:
        a, b = fit.agg(F.min(c)).scalar(), fit.agg(F.max(c)).scalar()
        out[c] = F.lit(low) + (F.col(c) - a) / F.nullif(b - a, F.lit(0.0)) * F.lit(high - low)
    return df.withColumns(out)


def min_max_unscale(fit: DataFrame, df: DataFrame, columns: Sequence[str], low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Inverse of :func:`min_max_scale`."""
    out = {}
    for c in columns:
        a, b = fit.agg(F.min(c)).scalar(), fit.agg(F.max(c)).scalar()
        out[c] = a + (F.col(c) - F.lit(low)) / F.lit(high - low) * (b - a)
    return df.withColumns(out)


def standardise(fit: DataFrame, df: DataFrame, columns: Sequence[str], sample: bool = False) -> DataFrame:
    """Centre and scale by the mean and the population (or sample) deviation of ``fit``."""
    deviation = F.stddev_samp if sample else F.stddev_pop
    out = {}
    for c in columns:
        mean, std = fit.agg(F.avg(c)).scalar(), fit.agg(deviation(c)).scalar()
        out[c] = (F.col(c) - mean) / F.nullif(std, F.lit(0.0))
    return df.withColumns(out)


def robust_scale(fit: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Centre on the median and scale by the inter-quartile range, both exact."""
    names = {c: {f"{c}__a": 0.25, f"{c}__m": 0.5, f"{c}__b": 0.75} for c in columns}
    q = exact_quantiles(fit, [], names).first()
    scaled: dict[str, Column] = {}
    for c in columns:
        spread = q[f"{c}__b"] - q[f"{c}__a"]
        scaled[c] = (F.col(c) - F.lit(q[f"{c}__m"])) / F.lit(spread or 1.0)
    return df.withColumns(scaled)
