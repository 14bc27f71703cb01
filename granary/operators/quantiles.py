"""Exact quantiles per group, for groups of any size."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.operators.skew import attach
from granary.session import durable

_EDGE = 0.0005  # a cut point this far to either side of every quantile
_ACCURACY = 10_000


def exact_quantiles(df: DataFrame, keys: Sequence[str], wanted: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Linear-interpolation quantiles: ``wanted`` maps a column to ``{output name: probability}``.

    One row for every group of ``df``, NULL where a column has no value in it; without keys
    always one row. Cut points a little to each side of every quantile come from a mergeable
    sketch. Exact counts per band tell which band holds which rank, so a poor sketch costs
    time, never accuracy. Only the rows of those bands are grouped by value and ordered.
    """
    keys = list(keys)
    entries = [F.struct(F.lit(c).alias("_c"), F.col(c).cast("double").alias("_x")) for c in wanted]
    values = df.select(*keys, F.explode(F.array(*entries)).alias("_s")).select(*keys, "_s.*").filter("_x IS NOT NULL")
    by = [*keys, "_c"]
    edges = {min(1.0, max(0.0, p + d)) for named in wanted.values() for p in named.values() for d in (-_EDGE, _EDGE)}
    # written once: both uses below must see the same cut points
    cuts = durable(
        values.groupBy(*by).agg(
            F.count(F.lit(1)).alias("_n"),
            F.percentile_approx("_x", [float(p) for p in sorted(edges)], _ACCURACY).alias("_cuts"),
        )
    )
    banded = attach(values, cuts, by, "inner").withColumn("_band", F.size(F.filter("_cuts", lambda c: c < F.col("_x"))))
    # written, so that its size is known and no rows are dealt by the few bands
    bands = durable(_wanted_bands(banded, by, wanted))
    found = attach(banded.drop("_n", "_cuts"), bands, [*by, "_band"], "inner")
    counted = found.groupBy(*by, "_band", "_x").agg(
        F.count(F.lit(1)).alias("_c_x"), F.first("_before").alias("_before"), F.first("_ranks").alias("_ranks")
    )
    upto = Window.partitionBy(*by, "_band").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    ended = counted.withColumn("_end", F.col("_before") + F.sum("_c_x").over(upto))
    inside = F.filter("_ranks", lambda r: (r < F.col("_end")) & (r >= F.col("_end") - F.col("_c_x")))
    hits = ended.select(*by, "_x", F.explode(inside).alias("_rank"))
    # a row per wanted rank, so the map has at most two entries for each quantile
    at = hits.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_x"))).alias("_at"))
    at = attach(cuts.select(*by, "_n"), at, by)
    out = at.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_c") == c, _at(p))).alias(name) for c, named in wanted.items() for name, p in named.items()]
    )
    return attach(df.select(*keys).distinct(), out, keys) if keys else out


def _target(p: float):
    return F.lit(float(p)) * (F.col("_n") - 1)


def _at(p: float):
    target = _target(p)
    low, high = F.element_at("_at", F.floor(target).cast("long")), F.element_at("_at", F.ceil(target).cast("long"))
    return low + (high - low) * (target - F.floor(target))


def _wanted_bands(banded: DataFrame, by: Sequence[str], wanted: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """Bands that hold a wanted rank, the rows before them, and those ranks."""
    below = Window.partitionBy(*by).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    bands = banded.groupBy(*by, "_band", "_n").agg(F.count(F.lit(1)).alias("_in_band"))
    bands = bands.withColumn("_before", F.coalesce(F.sum("_in_band").over(below), F.lit(0)))
    ranks = None
    for c, named in wanted.items():
        mine = F.array(*[f(_target(p)).cast("long") for p in named.values() for f in (F.floor, F.ceil)])
        ranks = F.when(F.col("_c") == c, mine) if ranks is None else ranks.when(F.col("_c") == c, mine)
    inside = F.filter(F.array_distinct(ranks), lambda r: (r >= F.col("_before")) & (r < F.col("_before") + F.col("_in_band")))
    return bands.withColumn("_ranks", inside).filter(F.size("_ranks") > 0).select(*by, "_band", "_before", "_ranks")
