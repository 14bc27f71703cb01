"""Model training on feature tables with Spark's own learners."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.relational import overlay
from granary.operators.skew import number_rows
from granary.operators.splits import fold as fold_of
from granary.functions.numeric import arithmetic_hash
from granary.session import durable


def assemble(df: DataFrame, features: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=name, handleInvalid="keep").transform(df)


def boosted_trees(train: DataFrame, features: Sequence[str], target: str, validation: str, seed: int, rounds: int = 20):
    """Gradient-boosted regression that stops when the rows flagged by ``validation`` stop improving."""
    staged = assemble(train, features)
    return GBTRegressor(
        labelCol=target, featuresCol="features", maxIter=rounds, maxDepth=4, stepSize=0.1, seed=seed,
        validationIndicatorCol=validation, subsamplingRate=0.8,
    ).fit(staged)


def boosted_classifier(train: DataFrame, features: Sequence[str], target: str, validation: str, seed: int, rounds: int = 20):
    staged = assemble(train, features)
    return GBTClassifier(
        labelCol=target, featuresCol="features", maxIter=rounds, maxDepth=4, seed=seed, validationIndicatorCol=validation
    ).fit(staged)


CLASSIFIERS = ("random_forest", "logistic", "decision_tree", "linear_svm", "naive_bayes")


def classifiers(target: str, seed: int) -> dict[str, Estimator]:
    """The set of classifiers, each with its score column and settings."""
    common = {"labelCol": target, "featuresCol": "features"}
    return {
        "random_forest": RandomForestClassifier(numTrees=20, maxDepth=5, seed=seed, **common),
        "logistic": LogisticRegression(maxIter=30, regParam=0.01, **common),
        "decision_tree": DecisionTreeClassifier(maxDepth=5, seed=seed, **common),
        "linear_svm": LinearSVC(maxIter=20, regParam=0.01, **common),
        "naive_bayes": NaiveBayes(modelType="gaussian", **common),
    }


def compare_classifiers(df: DataFrame, features: Sequence[str], target: str, test: str, seed: int) -> DataFrame:
    """Train every classifier on the rows without the ``test`` flag and count its hits on the others."""
    staged = assemble(df, features, "_raw")
    scaler = MinMaxScaler(inputCol="_raw", outputCol="features").fit(staged.filter(~F.col(test)))
    scaled = durable(scaler.transform(staged).select(target, test, "features"))
    train, held = scaled.filter(~F.col(test)), scaled.filter(F.col(test))

    def score(item):
        name, estimator = item
        predicted = estimator.fit(train).transform(held)
        return predicted.agg(
            F.count(F.lit(1)).alias("n"), F.avg((F.col("prediction") == F.col(target)).cast("double")).alias("accuracy")
        ).select(F.lit(name).alias("model"), "n", "accuracy")

    with ThreadPool(3) as pool:
        return reduce(DataFrame.unionAll, pool.map(score, classifiers(target, seed).items()))


def out_of_fold(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    target: str,
    estimator: Callable[[], Estimator],
    k: int,
    seed: int,
    test: DataFrame | None = None,
    output: str = "prediction",
) -> tuple[DataFrame, DataFrame | None]:
    """Predictions for every row from the model that did not see it, and the mean test prediction.

    The fold table is written once; the folds only read it, and run side by side.
    """
    staged = df.select(key, target, *features).withColumn("fold", fold_of(F.col(key), k, seed))
    table = durable(assemble(staged, features).select(key, target, "features", "fold"))
    prepared = assemble(test, features).select(key, "features") if test is not None else None

    def run(i: int):
        model = estimator().fit(table.filter(F.col("fold") != i))
        own = model.transform(table.filter(F.col("fold") == i)).select(key, target, "fold", _score(model, output))
        other = model.transform(prepared).select(key, _score(model, output)) if prepared is not None else None
        return own, other

    with ThreadPool(3) as pool:
        parts = pool.map(run, range(k))
    own = reduce(DataFrame.unionAll, [p[0] for p in parts])
    if prepared is None:
        return own, None
    stacked = reduce(DataFrame.unionAll, [p[1] for p in parts])
    return own, stacked.groupBy(key).agg(F.avg(output).alias(output))


def _score(model, name: str):
    """Probability of class 1 where the model gives one, else its prediction."""
    if hasattr(model, "getProbabilityCol"):
        return vector_to_array(F.col(model.getProbabilityCol()))[1].alias(name)
    return F.col(model.getPredictionCol()).alias(name)


def stack(
    df: DataFrame, key: str, features: Sequence[str], target: str, base: Mapping[str, Callable[[], Estimator]], k: int, seed: int
) -> DataFrame:
    """Super learner: a logistic regression on the out-of-fold scores of the base models."""
    scores = None
    for name, estimator in base.items():
        own, _ = out_of_fold(df, key, features, target, estimator, k, seed, output=name)
        own = own.select(key, target, name) if scores is None else own.select(key, name)
        scores = own if scores is None else scores.join(own, key)
    table = durable(assemble(scores, list(base), "features"))
    meta = LogisticRegression(labelCol=target, featuresCol="features", regParam=0.01).fit(table)
    return meta.transform(table).select(key, target, *base, _score(meta, "stacked"))


def two_model_combination(
    df: DataFrame, key: str, features: Sequence[str], target: str, outlier: str, extreme: int, seed: int
) -> DataFrame:
    """A regression without outliers, overlaid by the full regression for the likeliest outliers.

    The ``extreme`` ids with the highest outlier probability take the prediction of the
    model that saw the outliers.
    """
    staged = df.withColumn("_v", arithmetic_hash(F.col(key), seed) < 200_000)
    table = durable(staged)
    calm = boosted_trees(table.filter(F.col(outlier) == 0), features, target, "_v", seed, 10)
    full = boosted_trees(table, features, target, "_v", seed, 10)
    detector = boosted_classifier(table, features, outlier, "_v", seed, 10)
    rows = assemble(table, features).select(key, "features")
    base = calm.transform(rows).select(key, "prediction")
    likely = detector.transform(rows).select(key, vector_to_array("probability")[1].alias("p"))
    chosen = likely.orderBy(F.col("p").desc(), key).limit(extreme).select(key)
    patch = full.transform(rows.join(F.broadcast(chosen), key, "left_semi")).select(key, "prediction")
    return overlay(base, patch, key, "prediction")


def fold_importances(df: DataFrame, key: str, features: Sequence[str], target: str, estimator: Callable[[], Estimator], k: int, seed: int) -> DataFrame:
    """Feature importance per fold and its mean over the folds."""
    table = durable(assemble(df.withColumn("fold", fold_of(F.col(key), k, seed)), features).select(target, "features", "fold"))
    with ThreadPool(3) as pool:
        models = pool.map(lambda i: estimator().fit(table.filter(F.col("fold") != i)), range(k))
    rows = [(i, f, float(m.featureImportances[j])) for i, m in enumerate(models) for j, f in enumerate(features)]
    per_fold = df.sparkSession.createDataFrame(rows, "fold INT, feature STRING, importance DOUBLE")
    return per_fold.groupBy("feature").agg(F.avg("importance").alias("importance"), F.stddev_samp("importance").alias("spread"))


def permuted(df: DataFrame, key: str, column: str, seed: int) -> DataFrame:
    """The table with one column dealt out in another order; both orders are numbered in pieces."""
    numbered = number_rows(df, [key], "_at")
    values = df.select(arithmetic_hash(F.col(key), seed, 2_147_483_647).alias("_h"), F.col(key).alias("_k"), F.col(column).alias("_new"))
    dealt = number_rows(values, ["_h", "_k"], "_at").select("_at", "_new")
    return numbered.join(dealt, "_at").withColumn(column, F.col("_new")).drop("_at", "_new")


def permutation_importances(model, df: DataFrame, key: str, features: Sequence[str], target: str, seed: int, cut: float = 0.0) -> DataFrame:
    """Loss of accuracy when a feature is shuffled; features above ``cut`` are marked as kept."""
    hit = F.avg((F.col("prediction") == F.col(target)).cast("double"))
    df = durable(df.select(key, target, *features))
    base = model.transform(assemble(df, features)).agg(hit.alias("a")).first()[0]

    def drop(f: str) -> DataFrame:
        shuffled = permuted(df, key, f, seed)
        after = model.transform(assemble(shuffled, features)).agg(hit.alias("a"))
        return after.select(F.lit(f).alias("feature"), (F.lit(base) - F.col("a")).alias("importance"))

    return reduce(DataFrame.unionAll, [drop(f) for f in features]).withColumn("kept", F.col("importance") > cut)
