"""Numeric scalar expressions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column, digits: int = 4) -> Column:
    """Round so that exact decimal ties and negative zero come out the same on every engine."""
    return F.round(value + F.lit(1e-9), digits) + F.lit(0.0)


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Limit to [low, high]; NULL stays NULL (``least``/``greatest`` alone would skip it)."""
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def wrap_degrees(angle: Column) -> Column:
    """Circular wrap into [0, 360)."""
    return F.pmod(angle, F.lit(360))


def correlation(left: Column, right: Column) -> Column:
    """Pearson correlation of the complete pairs as an aggregate; NULL when a side is constant."""
    a = F.when(right.isNotNull(), left.cast("double"))
    b = F.when(left.isNotNull(), right.cast("double"))
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def flag_map(value: Column, mapping: dict[str, int]) -> Column:
    """Map listed codes to numbers, everything else to NULL."""
    chain = None
    for code, number in mapping.items():
        hit = value == F.lit(code)
        chain = F.when(hit, F.lit(number)) if chain is None else chain.when(hit, F.lit(number))
    return chain


def last_match(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    """Ordered override rules where a later matching rule beats an earlier one."""
    chain = None
    for condition, result in reversed(rules):
        chain = F.when(condition, F.lit(result)) if chain is None else chain.when(condition, F.lit(result))
    return chain.otherwise(F.lit(default))


def row_stats(columns: Sequence[Column]) -> dict[str, Column]:
    """Mean, sample standard deviation, minimum and maximum across the columns of one row."""
    n = len(columns)
    mean = reduce(lambda a, b: a + b, columns) / F.lit(n)
    squares = reduce(lambda a, b: a + b, [(c - mean) * (c - mean) for c in columns])
    return {
        "mean": mean,
        "std": F.sqrt(squares / F.lit(n - 1)),
        "min": F.least(*columns),
        "max": F.greatest(*columns),
    }


_PRIME, _HALF = 2_147_483_647, 46_341


def _factors(seed: int) -> tuple[int, int]:
    return (seed * 48_271 + 69_621) % _PRIME or 1, (seed * 69_621 + 1_566_083_941) % _PRIME or 1


def arithmetic_hash(key: Column, seed: int, buckets: int = 1_000_000) -> Column:
    """Engine-independent hash of an integer key in [0, buckets).

    Two rounds whose factors depend on the seed; between them the halves of the number change
    places, so that no seed's hash is another's at a moved key. Factors and operands are below
    2^31, so nothing overflows under ANSI mode.
    """
    first, second = _factors(seed)
    mixed = F.pmod(F.pmod(key, F.lit(_PRIME)) * F.lit(first) + F.lit(second), F.lit(_PRIME)).cast("long")
    mixed = F.pmod(mixed, F.lit(_HALF)) * F.lit(_HALF) + F.floor(mixed / F.lit(_HALF))
    mixed = F.pmod(F.pmod(mixed, F.lit(_PRIME)) * F.lit(second) + F.lit(first), F.lit(_PRIME))
    return F.pmod(mixed, F.lit(buckets)).cast("long")


def arithmetic_hash_sql(key: str, seed: int, buckets: int = 1_000_000) -> str:
    """The same hash as SQL text."""
    first, second = _factors(seed)
    mixed = f"((CAST(({key}) % {_PRIME} AS BIGINT) * {first} + {second}) % {_PRIME})"
    mixed = f"({mixed} % {_HALF} * {_HALF} + {mixed} // {_HALF})"
    return f"CAST(({mixed} % {_PRIME} * {second} + {first}) % {_PRIME} % {buckets} AS BIGINT)"
