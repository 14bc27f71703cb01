"""Roll-ups of facts to entities, category summaries and reshaping of aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.aggspec import aggregate_columns, rollup
from granary.functions.dates import epoch_seconds, months_elapsed, whole_days_between
from granary.operators.quantiles import exact_quantiles
from granary.operators.skew import attach
from granary.session import durable


def session_rollup(
    df: DataFrame,
    visitor: str,
    ts: str,
    revenue: str,
    spec: Mapping[str, Sequence[str]],
    sum_of_logs: bool = False,
) -> DataFrame:
    """Visits to one row per visitor, with the day span and the log of total revenue.

    ``sum_of_logs`` takes the log of every revenue before summing instead of after.
    """
    if sum_of_logs:
        df = df.withColumn(revenue, F.log1p(revenue))
    full = {ts: ["min", "max"], revenue: ["sum", "size"], **spec}
    users = rollup(df, [visitor], full)
    total = F.coalesce(F.col(f"{revenue}_sum"), F.lit(0.0))
    return users.withColumn("date_diff", whole_days_between(F.col(f"{ts}_max"), F.col(f"{ts}_min"))).withColumn(
        f"{revenue}_sum", total if sum_of_logs else F.log1p(total)
    )


# Feature specifications of the card roll-ups; fixed values, under the column names of the fixtures.
LEVELS = {"category_2": (1, 2, 3, 4, 5), "category_3": ("A", "N", "R")}
CARD_SPEC = {
    "category_1": ["sum", "mean"],
    **{f"{c}_{level}": ["mean"] for c, levels in LEVELS.items() for level in levels},
    "merchant": ["nunique"],
    "merchant_category": ["nunique_bounded"],
    "state": ["nunique_bounded"],
    "city": ["nunique_bounded"],
    "subsector": ["nunique_bounded"],
    "amount": ["sum", "mean", "max", "min", "std"],
    "installments": ["sum", "mean", "max", "min", "std"],
    "purchase_month": ["mean", "max", "min", "std"],
    "purchase_epoch": ["ptp", "min", "max"],
    "month_lag": ["mean", "max", "min", "std"],
    "month_diff": ["mean"],
}


def prepare_transactions(df: DataFrame, as_of: str) -> DataFrame:
    """Date features of each purchase; ``as_of`` replaces the reading of the clock."""
    flags = {
        f"{c}_{level}": F.coalesce((F.col(c) == F.lit(level)).cast("int"), F.lit(0)) for c, levels in LEVELS.items() for level in levels
    }
    return df.withColumns(
        {
            **flags,
            "purchase_month": F.month("purchase_ts"),
            "purchase_epoch": epoch_seconds(F.col("purchase_ts")),
            "month_diff": months_elapsed(as_of, F.col("purchase_ts"), F.col("month_lag")),
        }
    )


def _together(history: DataFrame, card: str) -> DataFrame:
    """Rows of a card in one part; a missing card is left out.

    A card has few purchases in a part of the table, and a state of the specification, with its sets, is many
    times as wide as a purchase, so it is the purchases that travel, once; distinct merchants need no further trip.
    """
    return history.dropna(subset=[card]).repartition(card)


def aggregate_transactions(history: DataFrame, card: str = "card", prefix: str = "") -> DataFrame:
    """One row per card: the count of its transactions and the card specification."""
    spec = aggregate_columns(CARD_SPEC, prefix)
    return (
        _together(history, card)
        .groupBy(card)
        .agg(F.count(F.lit(1)).alias(f"{prefix}transactions_count"), *spec)
    )


def aggregate_split(history: DataFrame, side: Column, names: Sequence[str], card: str = "card") -> DataFrame:
    """The card roll-up of several populations in a single pass over the transactions.

    ``side`` names the population of a row. Groups by (card, side) and turns the sides into
    prefixed columns, so the facts are shuffled once rather than once per side.
    """
    sided = _together(history, card).withColumn("_side", side)
    per_side = sided.groupBy(card, "_side").agg(
        F.count(F.lit(1)).alias("transactions_count"), *aggregate_columns(CARD_SPEC)
    )
    measures = [c for c in per_side.columns if c not in (card, "_side")]
    wide = [
        F.first(F.when(F.col("_side") == n, F.col(m)), ignorenulls=True).alias(f"{n}_{m}") for n in names for m in measures
    ]
    return per_side.groupBy(card).agg(*wide)


# columns and aggregates of the card profile (fixed values)
PROFILE_SPEC = {
    "month": ["nunique_small"],
    "hour": ["nunique_small"],
    "week": ["nunique_small"],
    "dow": ["nunique_small"],
    "year": ["nunique_bounded"],
    "subsector": ["nunique_bounded"],
    "merchant": ["nunique"],
    "merchant_category": ["nunique_bounded"],
    "amount": ["sum", "max", "min", "mean", "var"],
    "installments": ["sum", "max", "min", "mean", "var"],
    "purchase_ts": ["max", "min"],
    "month_lag": ["max", "min", "mean", "var"],
    "month_diff": ["mean"],
    "authorized": ["sum", "mean"],
    "weekend": ["sum", "mean"],
    "category_1": ["sum", "mean"],
    "card": ["size"],
    "category_2_mean": ["mean"],
    "category_3_mean": ["mean"],
}


def card_profile(df: DataFrame, as_of: str, prefix: str = "hist_") -> DataFrame:
    """Card features with date parts, category means and recency against ``as_of``.

    ``df`` is read three times, so it should be a written table.
    """
    ts = F.col("purchase_ts")
    facts = df
    for c in ("category_2", "category_3"):  # a row without the category has no mean
        means = durable(df.dropna(subset=[c]).groupBy(c).agg(F.avg("amount").alias(f"{c}_mean")))
        facts = attach(facts, means, [c])
    facts = facts.withColumns(
        {
            "year": F.year(ts),
            "week": F.weekofyear(ts),
            "month": F.month(ts),
            "dow": F.weekday(ts),
            "weekend": (F.weekday(ts) >= 5).cast("int"),
            "hour": F.hour(ts),
            "month_diff": months_elapsed(as_of, ts, F.col("month_lag")),
        }
    )
    out = rollup(_together(facts, "card"), ["card"], PROFILE_SPEC, prefix)
    last, first = F.col(f"{prefix}purchase_ts_max"), F.col(f"{prefix}purchase_ts_min")
    diff = whole_days_between(last, first)
    return out.withColumns(
        {
            f"{prefix}purchase_date_diff": diff,
            f"{prefix}purchase_date_average": diff / F.col(f"{prefix}card_size"),
            f"{prefix}purchase_date_uptonow": whole_days_between(F.lit(as_of).cast("timestamp"), last),
        }
    )


def aggregate_per_period(
    df: DataFrame, key: str, period: str, spec: Mapping[str, Sequence[str]], second: Sequence[str] = ("mean", "std")
) -> DataFrame:
    """Aggregate per (key, period), then over the periods of each key, the period included."""
    first = rollup(df, [key, period], spec)
    measures = [c for c in first.columns if c != key]
    return rollup(first, [key], {m: list(second) for m in measures})


def successive_aggregates(df: DataFrame, key: str, field1: str, field2: str) -> DataFrame:
    """Mean of ``field2`` per (key, field1), then mean, min, max and std of those means per key."""
    first = rollup(df, [key, field1], {field2: ["mean"]})
    named = first.withColumnRenamed(f"{field2}_mean", f"{field1}_{field2}")
    return rollup(named, [key], {f"{field1}_{field2}": ["mean", "min", "max", "std"]})


def category_summary(df: DataFrame, category: str, measure: str) -> DataFrame:
    """Rows, non-missing measures and their mean per category, largest first."""
    return (
        df.dropna(subset=[category])
        .groupBy(category)
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.count(measure).alias("non_null"),
            F.avg(measure).alias("mean"),
        )
        .orderBy(F.col("size").desc(), category)
    )


def entity_target(df: DataFrame, key: str, log_prediction: Column) -> DataFrame:
    """Log of the summed back-transformed predictions; negative predictions count as zero."""
    amount = F.expm1(F.greatest(log_prediction, F.lit(0.0)))
    return df.dropna(subset=[key]).groupBy(key).agg(F.log1p(F.sum(amount)).alias("target"))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Frequency and share of every value; ``top`` keeps the most frequent ones."""
    counts = df.dropna(subset=[column]).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.filter(F.col(column).isNotNull()).agg(F.count(F.lit(1)).alias("n")).scalar()
    out = counts.select(column, "n", (F.col("n") / total).alias("share"))
    return out.orderBy(F.col("n").desc(), column).limit(top) if top else out


def crosstab(df: DataFrame, rows: str, columns: str, values: Sequence, measure: Column | None = None) -> DataFrame:
    """Counts (or sums of ``measure``) of ``rows`` against the listed ``columns`` values."""
    value = F.count(F.lit(1)) if measure is None else F.sum(measure)
    out = df.dropna(subset=[rows]).groupBy(rows).pivot(columns, list(values)).agg(value)
    return out.fillna(0, subset=[str(v) for v in values])


def normalised(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each row's cells as a share of the row total."""
    total = reduce(lambda a, b: a + b, [F.col(c) for c in columns])
    return df.withColumns({c: F.col(c) / F.nullif(total, F.lit(0)) for c in columns})


def melt_summary(df: DataFrame, group: str, measure: str) -> DataFrame:
    """Visits, mean and total of a measure per group, one row per (group, metric)."""
    wide = (
        df.dropna(subset=[group])
        .groupBy(group)
        .agg(
            F.count(F.lit(1)).cast("double").alias("visits"),
            F.avg(measure).alias("mean"),
            F.sum(measure).alias("total"),
        )
    )
    return wide.unpivot([group], ["visits", "mean", "total"], "metric", "value")


def hierarchy_totals(df: DataFrame, levels: Sequence[str], measure: str) -> DataFrame:
    """Totals at every depth of a level path, the grand total included."""
    return df.rollup(*levels).agg(
        F.count(F.lit(1)).alias("n"), F.sum(measure).alias("total"), F.grouping_id().cast("int").alias("depth_code")
    )


def first_valid(df: DataFrame, key: str, order: Column, columns: Sequence[str]) -> DataFrame:
    """Per key and per column, the first value that is not missing along ``order``."""
    return (
        df.dropna(subset=[key])
        .groupBy(key)
        .agg(*[F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns])
    )


def majority_vote(votes: Sequence[Column]) -> Column:
    """Most frequent vote of a row; the smallest one among equals."""
    given = F.filter(F.array(*votes), lambda v: v.isNotNull())
    ranked = F.transform(
        F.array_distinct(given),
        lambda v: F.struct((-F.size(F.filter(given, lambda w: w == v))).alias("c"), v.alias("v")),
    )
    return F.array_min(ranked)["v"]


def log_mean(values: Sequence[Column]) -> Column:
    """Mean of back-transformed log values, transformed again."""
    return F.log1p(reduce(lambda a, b: a + b, [F.expm1(v) for v in values]) / F.lit(len(values)))


def shared_histogram(df: DataFrame, population: str, value: str, bins: int) -> DataFrame:
    """Equal-width histogram with common edges for all populations; the last bin is closed."""
    present = df.filter(F.col(value).isNotNull())
    low = present.agg(F.min(value)).scalar()
    high = present.agg(F.max(value)).scalar()
    width = F.nullif((high - low) / F.lit(bins), F.lit(0.0))
    # all values equal: a single bin
    position = F.coalesce(F.floor((F.col(value) - low) / width), F.lit(0))
    counted = (
        present.withColumn("bin", F.least(position, F.lit(bins - 1)).cast("int"))
        .groupBy(population, "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counted.groupBy(population).agg(F.sum("n").alias("_all"))
    return attach(counted, totals, [population]).select(
        population,
        "bin",
        "n",
        (low + F.col("bin") * F.coalesce(width, F.lit(0.0))).alias("left_edge"),
        (F.col("n") / F.col("_all") / width).alias("density"),
    )


def intraclass_correlation(df: DataFrame, group: str, value: str) -> DataFrame:
    """Share of variance between groups, by the one-way analysis-of-variance estimator."""
    per = (
        df.filter(F.col(group).isNotNull() & F.col(value).isNotNull())
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v"))
    )
    stats = per.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).alias("n2"),
        F.sum(F.col("n") * F.col("v")).alias("ssw"),
        (F.sum(F.col("n") * F.col("m") * F.col("m")) - F.try_divide(F.pow(F.sum(F.col("n") * F.col("m")), F.lit(2)), F.sum("n"))).alias("ssb"),
    )
    msb = F.try_divide(F.col("ssb"), F.col("k") - 1)
    msw = F.try_divide(F.col("ssw"), F.col("n") - F.col("k"))
    n0 = F.try_divide(F.col("n") - F.try_divide(F.col("n2"), F.col("n")), F.col("k") - 1)
    between = F.try_divide(msb - msw, n0)
    return stats.select(
        "k",
        "n",
        msb.alias("ms_between"),
        msw.alias("ms_within"),
        F.try_divide(between, between + msw).alias("icc"),
    )


def group_medians(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Exact median per group, safe for groups of any size."""
    return exact_quantiles(df.dropna(subset=list(keys)), keys, {value: {"median": 0.5}})
