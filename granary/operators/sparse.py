"""Ridge regression on (row, term, weight) cells, with the coefficients as a table.

Conjugate gradients on the normal equations: a step multiplies by the matrix and back with two
joins and two sums, and only its two step lengths pass through the driver. Terms are texts, so
blocks of features lie side by side under names of their own, and no hashing, list of terms or
vector of all cells exists.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import durable


def ridge(cells: DataFrame, targets: DataFrame, id_col: str, penalty: float, steps: int = 60, tolerance: float = 1e-7) -> tuple[DataFrame, float | None]:
    """(coefficients (term, value), offset): least squares of ``y`` minus its mean, the offset, plus ``penalty`` times squares.

    ``targets`` has (id, y). Rows of missing ``y`` take no part; a term of no row with a target has no
    coefficient; without targets the offset is None. Ends when the gradient is ``tolerance`` of its first length.
    """
    known = targets.where(F.col("y").isNotNull()).select(id_col, F.col("y").cast("double").alias("y"))
    offset = known.agg(F.avg("y")).first()[0]
    mine = durable(cells.join(known, id_col).select(id_col, "term", F.col("weight").cast("double").alias("weight"), (F.col("y") - F.lit(offset)).alias("gap")))
    start = mine.groupBy("term").agg(F.sum(F.col("weight") * F.col("gap")).alias("r"))
    state = durable(start.select("term", F.lit(0.0).alias("b"), "r", F.col("r").alias("p")))
    square = first = state.agg(F.sum(F.col("r") * F.col("r"))).first()[0] or 0.0
    for _ in range(steps):
        if square <= tolerance * tolerance * first:
            break
        ahead = mine.join(state.select("term", "p"), "term").groupBy(id_col).agg(F.sum(F.col("weight") * F.col("p")).alias("q"))
        back = mine.join(ahead, id_col).groupBy("term").agg(F.sum(F.col("weight") * F.col("q")).alias("q"))
        step = durable(state.join(back, "term").select("term", "b", "r", "p", (F.col("q") + penalty * F.col("p")).alias("q")))
        curve = step.agg(F.sum(F.col("p") * F.col("q"))).first()[0]
        if not curve:
            break
        length = square / curve
        rest = F.col("r") - length * F.col("q")
        after = step.agg(F.sum(rest * rest)).first()[0]
        state = step.select(
            "term", (F.col("b") + length * F.col("p")).alias("b"), rest.alias("r"), (rest + (after / square) * F.col("p")).alias("p")
        )
        square = after
    return state.select("term", F.col("b").alias("value")), offset


def predict(cells: DataFrame, rows: DataFrame, coefficients: DataFrame, offset: float | None, id_col: str) -> DataFrame:
    """``rows`` with ``prediction``; a row without known terms has the offset."""
    sums = cells.join(coefficients, "term").groupBy(id_col).agg(F.sum(F.col("weight") * F.col("value")).alias("_s"))
    said = F.coalesce("_s", F.lit(0.0)) + F.lit(offset)
    return rows.join(sums, id_col, "left").withColumn("prediction", said.cast("double")).drop("_s")
