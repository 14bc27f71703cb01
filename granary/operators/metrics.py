"""Evaluation of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def error_columns(truth: Column, predicted: Column) -> list[Column]:
    """Root mean squared, mean absolute and root mean squared log error (negative values as zero)."""
    gap = truth - predicted
    logs = F.log1p(F.greatest(truth, F.lit(0.0))) - F.log1p(F.greatest(predicted, F.lit(0.0)))
    scored = truth.isNotNull() & predicted.isNotNull()
    return [
        F.count_if(scored).alias("n"),
        F.sqrt(F.avg(gap * gap)).alias("rmse"),
        F.avg(F.abs(gap)).alias("mae"),
        F.sqrt(F.avg(F.when(scored, logs * logs))).alias("rmsle"),
    ]


def error_metrics(df: DataFrame, truth: str, predicted: str, groups: Sequence[str] = ()) -> DataFrame:
    cols = error_columns(F.col(truth), F.col(predicted))
    return df.groupBy(*groups).agg(*cols) if groups else df.agg(*cols)


def confusion(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))


def class_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts."""
    cells = confusion(df, truth, predicted)
    sides = F.explode(
        F.array(
            F.struct(F.col(truth).alias("label"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("given")),
            F.struct(F.col(predicted).alias("label"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("given")),
        )
    )
    hit = F.when(F.col(truth) == F.col(predicted), F.col("n")).otherwise(0)
    long = cells.select(sides.alias("s"), hit.alias("hit")).select("s.*", "hit")
    # a correct cell appears on both sides, so its hits are halved
    per = long.groupBy("label").agg(
        F.sum("actual").alias("support"), F.sum("given").alias("given"), (F.sum("hit") / 2).alias("hit")
    )
    zero = F.lit(0)
    precision = F.coalesce(F.col("hit") / F.nullif(F.col("given"), zero), F.lit(0.0))
    recall = F.coalesce(F.col("hit") / F.nullif(F.col("support"), zero), F.lit(0.0))
    out = per.select("label", "support", precision.alias("precision"), recall.alias("recall"))
    both = F.col("precision") + F.col("recall")
    f1 = F.coalesce(2 * F.col("precision") * F.col("recall") / F.nullif(both, F.lit(0.0)), F.lit(0.0))
    return out.withColumn("f1", f1)


def probability_scores(df: DataFrame, truth: str, probability: str, cut: float = 0.5) -> DataFrame:
    """Accuracy at a cut and log loss of clipped probabilities."""
    p = F.least(F.greatest(F.col(probability), F.lit(1e-15)), F.lit(1 - 1e-15))
    loss = -(F.col(truth) * F.ln(p) + (1 - F.col(truth)) * F.ln(1 - p))
    right = ((F.col(probability) >= cut).cast("int") == F.col(truth)).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.avg(right).alias("accuracy"), F.avg(loss).alias("log_loss"))


def threshold_sweep(df: DataFrame, truth: str, score: str, steps: int) -> DataFrame:
    """True and false positives, misses and Jaccard index at evenly spaced thresholds in [0, 1].

    A row is counted once, in the histogram of thresholds its score exceeds; the sweep is a
    running sum over the ``steps`` histogram cells.
    """
    last = steps - 1
    above = F.ceil(F.round(F.col(score) * last, 9)).cast("int")  # thresholds 0..above-1 lie below the score
    cells = df.groupBy(F.least(F.greatest(above, F.lit(0)), F.lit(steps)).alias("cell")).agg(
        F.sum(F.col(truth).cast("long")).alias("pos"), F.sum(1 - F.col(truth).cast("long")).alias("neg")
    )
    spread = cells.agg(
        F.map_from_entries(F.collect_list(F.struct("cell", F.struct("pos", "neg")))).alias("m")
    )  # at most steps + 1 entries
    grid = spread.select(F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("cell"), "m").select(
        "cell",
        F.coalesce(F.col("m")[F.col("cell")]["pos"], F.lit(0)).alias("pos"),
        F.coalesce(F.col("m")[F.col("cell")]["neg"], F.lit(0)).alias("neg"),
    )
    after = Window.partitionBy(F.lit(0)).orderBy("cell").rowsBetween(1, Window.unboundedFollowing)
    upto = Window.partitionBy(F.lit(0)).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    counted = grid.select(
        "cell",
        F.coalesce(F.sum("pos").over(after), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("neg").over(after), F.lit(0)).alias("fp"),
        F.sum("pos").over(upto).alias("fn"),
    ).filter(F.col("cell") < steps)
    union = F.col("tp") + F.col("fp") + F.col("fn")
    return counted.select(
        F.col("cell").alias("step"),
        (F.col("cell") / F.lit(last)).alias("threshold"),
        "tp",
        "fp",
        "fn",
        F.coalesce(F.col("tp") / F.nullif(union, F.lit(0)), F.lit(0.0)).alias("jaccard"),
    )


def best_threshold(sweep: DataFrame, low: int = 0, high: int | None = None) -> DataFrame:
    """The sweep row with the highest Jaccard index between two steps; the lowest threshold among equals."""
    kept = sweep.filter(F.col("step") >= low)
    if high is not None:
        kept = kept.filter(F.col("step") < high)
    order = F.struct(F.round("jaccard", 9), -F.col("step"))
    return kept.agg(F.max_by(F.struct(*sweep.columns), order).alias("b")).select("b.*")


def mean_precision_over_iou(df: DataFrame, group: str, truth: str, predicted: str) -> DataFrame:
    """Per group the overlap of predicted and true rows, and the share of cut-offs 0.50..0.95 it passes."""
    both, either = (F.col(truth) == 1) & (F.col(predicted) == 1), (F.col(truth) == 1) | (F.col(predicted) == 1)
    per = df.groupBy(group).agg(F.count_if(both).alias("i"), F.count_if(either).alias("u"))
    iou = F.when(F.col("u") == 0, F.lit(1.0)).otherwise(F.col("i") / F.col("u"))
    cuts = [round(0.5 + 0.05 * i, 2) for i in range(10)]
    passed = sum(((F.col("iou") > c).cast("int") for c in cuts), F.lit(0))
    return per.select(group, iou.alias("iou")).withColumn("precision", passed / F.lit(len(cuts)))


def hamming_loss(df: DataFrame, truth: Sequence[Column], predicted: Sequence[Column]) -> DataFrame:
    """Share of label cells that differ."""
    wrong = sum(((t != p).cast("int") for t, p in zip(truth, predicted)), F.lit(0))
    return df.agg(F.try_divide(F.sum(wrong), F.count(F.lit(1)) * len(truth)).alias("hamming_loss"))
