"""Evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.numeric import fixed
from granary.operators import linear, metrics, windowing
from granary.plans.aggregates import rounded
from granary.plans.registry import fx, query
from granary.plans.tables import PANEL_SQL, panel, table

_ERRORS = (
    f"count(p) AS n, {fx('sqrt(avg((y - p) ** 2))', 3)} AS rmse, {fx('avg(abs(y - p))', 3)} AS mae, "
    f"{fx('sqrt(avg((ln(1 + y) - ln(1 + p)) ** 2))')} AS rmsle"
)
_LAG_SQL = f"{PANEL_SQL}, l AS (SELECT nation, segment, y, lag(y) OVER (PARTITION BY nation, segment ORDER BY d) AS p FROM panel)"


def _lagged(spark, sf):
    return windowing.lags(panel(spark, sf), ["nation", "segment"], "d", "y", 1)


def _shown(df):
    return df.select(*[c for c in df.columns if c not in ("rmse", "mae", "rmsle")],
                     fixed(F.col("rmse"), 3).alias("rmse"), fixed(F.col("mae"), 3).alias("mae"), fixed(F.col("rmsle")).alias("rmsle"))


@query("a26_error_metrics", f"WITH {_LAG_SQL} SELECT {_ERRORS} FROM l")
def a26_error_metrics(spark, sf):
    return _shown(metrics.error_metrics(_lagged(spark, sf), "y", "y_lag1"))


@query("a26b_error_metrics_by_group", f"WITH {_LAG_SQL} SELECT nation, segment, {_ERRORS} FROM l GROUP BY 1, 2")
def a26b_error_metrics_by_group(spark, sf):
    return _shown(metrics.error_metrics(_lagged(spark, sf), "y", "y_lag1", ["nation", "segment"]))


_SCORED_SQL = "s AS (SELECT doc_id, source, quality AS truth, 1 / (1 + exp(-(n_chars - 1500) / 800.0)) AS score FROM labels JOIN documents USING (doc_id))"


def _scored(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    j = d.join(table(spark, sf, "labels").select("doc_id", F.col("quality").alias("truth")), "doc_id")
    return j.select("doc_id", "source", "truth", (1 / (1 + F.exp(-(F.col("n_chars") - 1500) / 800.0))).alias("score"))


@query("l14_confusion", f"WITH {_SCORED_SQL} SELECT truth, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted, count(*) AS n FROM s GROUP BY 1, 2")
def l14_confusion(spark, sf):
    s = _scored(spark, sf).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    return metrics.confusion(s, "truth", "predicted")


@query(
    "l14b_class_report",
    f"""WITH {_SCORED_SQL}, p AS (SELECT truth, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted FROM s), k AS (SELECT 0 AS label UNION ALL SELECT 1),
r AS (SELECT label, count(*) FILTER (truth = label) AS support, count(*) FILTER (truth = label AND predicted = label) AS hit,
 count(*) FILTER (predicted = label) AS given FROM p, k GROUP BY 1)
SELECT label, support, {fx("hit / given")} AS precision, {fx("hit / support")} AS recall,
 {fx("2 * (hit / given) * (hit / support) / (hit / given + hit / support)")} AS f1 FROM r""",
)
def l14b_class_report(spark, sf):
    s = _scored(spark, sf).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
    return rounded(metrics.class_report(s, "truth", "predicted"))


@query(
    "l14c_probability_scores",
    f"""WITH {_SCORED_SQL}, c AS (SELECT truth, score, least(greatest(score, 1e-15), 1 - 1e-15) AS p FROM s)
SELECT count(*) AS n, {fx("avg(CASE WHEN (score >= 0.5) = (truth = 1) THEN 1.0 ELSE 0.0 END)")} AS accuracy,
 {fx("avg(-(truth * ln(p) + (1 - truth) * ln(1 - p)))")} AS log_loss FROM c""",
)
def l14c_probability_scores(spark, sf):
    return rounded(metrics.probability_scores(_scored(spark, sf), "truth", "score"))


_SWEEP_SQL = f"""{_SCORED_SQL}, t AS (SELECT CAST(unnest(range(0, 50)) AS INT) AS step),
w AS (SELECT step, count(*) FILTER (truth = 1 AND round(score * 49, 9) > step) AS tp, count(*) FILTER (truth = 0 AND round(score * 49, 9) > step) AS fp,
 count(*) FILTER (truth = 1 AND round(score * 49, 9) <= step) AS fn FROM s, t GROUP BY 1),
v AS (SELECT step, step / 49 AS threshold, tp, fp, fn, tp / (tp + fp + fn) AS jaccard FROM w)"""


@query("l15_threshold_sweep", f"WITH {_SWEEP_SQL} SELECT step, {fx('threshold')} AS threshold, tp, fp, fn, {fx('jaccard')} AS jaccard FROM v")
def l15_threshold_sweep(spark, sf):
    return rounded(metrics.threshold_sweep(_scored(spark, sf), "truth", "score", 50))


@query(
    "l15b_best_threshold",
    f"""WITH {_SWEEP_SQL} SELECT step, {fx('threshold')} AS threshold, tp, fp, fn, {fx('jaccard')} AS jaccard FROM v
WHERE step >= 9 AND step < 40 ORDER BY round(v.jaccard, 9) DESC, step LIMIT 1""",
)
def l15b_best_threshold(spark, sf):
    return rounded(metrics.best_threshold(metrics.threshold_sweep(_scored(spark, sf), "truth", "score", 50), 9, 40))


@query(
    "l15c_precision_over_iou",
    f"""WITH {_SCORED_SQL}, g AS (SELECT source, count(*) FILTER (truth = 1 AND score > 0.3) AS i, count(*) FILTER (truth = 1 OR score > 0.3) AS u FROM s GROUP BY 1),
o AS (SELECT source, CASE WHEN u = 0 THEN 1.0 ELSE i / u END AS iou FROM g)
SELECT source, {fx("iou")} AS iou, {fx("(" + " + ".join(f"CAST(iou > {0.5 + 0.05 * i:.2f}::DOUBLE AS INT)" for i in range(10)) + ") / 10")} AS precision FROM o""",
)
def l15c_precision_over_iou(spark, sf):
    s = _scored(spark, sf).withColumn("predicted", (F.col("score") > 0.3).cast("int"))
    return rounded(metrics.mean_precision_over_iou(s, "source", "truth", "predicted"))


@query(
    "l16_simple_diagnostics",
    f"""WITH m AS (SELECT count(*) AS n, regr_slope(y, x) AS b, regr_syy(y, x) AS tss, regr_sxy(y, x) ** 2 / regr_sxx(y, x) AS ssr, regr_sxx(y, x) AS sxx
 FROM (SELECT l_extendedprice / 1000 AS y, l_quantity AS x FROM lineitem))
SELECT 'l_quantity' AS feature, {fx("b", 5)} AS coefficient, {fx("b / sqrt((tss - ssr) / (n - 2) / sxx)", 3)} AS t_value, {fx("1.0::DOUBLE")} AS vif, false AS collinear,
 {fx("tss / n", 3)} AS tss, {fx("ssr / n", 3)} AS ssr, {fx("(tss - ssr) / n", 3)} AS sse, {fx("ssr / ((tss - ssr) / (n - 2))", 2)} AS f_value, {fx("ssr / tss")} AS r2,
 {fx("1 - (1 - ssr / tss) * (n - 1) / (n - 2)")} AS adjusted_r2 FROM m""",
)
def l16_simple_diagnostics(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", (F.col("l_extendedprice") / 1000).alias("price"))
    out = linear.regression_diagnostics(li, ["l_quantity"], "price")
    n = li.agg(F.count(F.lit(1))).scalar()
    digits = {"coefficient": 5, "t_value": 3, "tss": 3, "ssr": 3, "sse": 3, "f_value": 2}
    # sums of squares are shown per row
    scaled = out.withColumns({c: F.col(c) / n for c in ("tss", "ssr", "sse")})
    return scaled.select(
        "feature", "collinear", *[fixed(F.col(c), digits.get(c, 4)).alias(c) for c in scaled.columns if c not in ("feature", "collinear")]
    )


@query("l16b_diagnostics")
def l16b_diagnostics(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("twice", F.col("l_quantity") * 2 + F.col("l_tax"))
    return linear.regression_diagnostics(li, ["l_quantity", "l_discount", "l_tax", "twice"], "l_extendedprice")


@query(
    "v02_hamming_loss",
    f"""SELECT lang, {fx("(sum(CAST(quality <> (n_chars > 1500)::INT AS INT)) + sum(CAST(toxic <> (source = 'src3')::INT AS INT))) / (2.0 * count(*))", 5)} AS hamming_loss
FROM labels JOIN documents USING (doc_id) GROUP BY lang""",
)
def v02_hamming_loss(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    j = d.join(table(spark, sf, "labels"), "doc_id")
    truth = [F.col("quality"), F.col("toxic")]
    guess = [(F.col("n_chars") > 1500).cast("int"), (F.col("source") == "src3").cast("int")]
    return rounded(metrics.hamming_loss(j.groupBy("lang"), truth, guess), 5)
