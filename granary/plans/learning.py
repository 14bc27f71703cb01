"""Splits, models and forecasts."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from granary.functions import dates
from granary.functions.numeric import arithmetic_hash_sql, fixed
from granary.functions.text import blank_token_count, word_count
from granary.operators import linear, listing, metrics, models, sparse, splits, windowing
from granary.operators import text as textops
from granary.plans.aggregates import rounded
from granary.plans.registry import fx, query
from granary.plans.tables import PANEL_SQL, items, panel, table
from granary.plans.texts import docs
from granary.session import durable


@query(
    "l01_sample_rows",
    f"SELECT doc_id, lang FROM documents ORDER BY {arithmetic_hash_sql('doc_id', 13, 2147483647)}, doc_id LIMIT 100",
)
def l01_sample_rows(spark, sf):
    return splits.sample_rows(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 100, 13)


@query(
    "l01b_sample_and_complement",
    f"SELECT doc_id, CASE WHEN {arithmetic_hash_sql('doc_id', 17)} < 150000 THEN 'sample' ELSE 'rest' END AS side FROM documents",
)
def l01b_sample_and_complement(spark, sf):
    inside, rest = splits.sample_fraction(table(spark, sf, "documents").select("doc_id"), "doc_id", 0.15, 17)
    return inside.withColumn("side", F.lit("sample")).unionAll(rest.withColumn("side", F.lit("rest")))


@query(
    "l02_vertical_split",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def l02_vertical_split(spark, sf):
    """Two column parts that share the key, joined back: nothing is lost or doubled."""
    a, b = splits.vertical_split(table(spark, sf, "customer"), "c_custkey", 0.6, 3)
    return a.join(b, "c_custkey").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query(
    "l02b_horizontal_parts",
    f"SELECT c_custkey, CASE WHEN {arithmetic_hash_sql('c_custkey', 19)} < 600000 THEN 'A' ELSE 'B' END AS part FROM customer",
)
def l02b_horizontal_parts(spark, sf):
    part = splits.disjoint_parts(F.col("c_custkey"), [("A", 0.6), ("B", 0.4)], 19)
    return table(spark, sf, "customer").select("c_custkey", part.alias("part"))


@query(
    "l03_time_split",
    """SELECT CASE WHEN o_orderdate <= TIMESTAMP '2000-05-31 00:00:00' THEN 'train' ELSE 'valid' END AS side, count(*) AS n,
 min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts FROM orders GROUP BY 1""",
)
def l03_time_split(spark, sf):
    cut = F.to_timestamp_ntz(F.lit("2000-05-31 00:00:00"))
    before, after = splits.time_split(table(spark, sf, "orders").select("o_orderdate"), "o_orderdate", cut)
    both = before.withColumn("side", F.lit("train")).unionAll(after.withColumn("side", F.lit("valid")))
    return both.groupBy("side").agg(
        F.count(F.lit(1)).alias("n"), F.min("o_orderdate").alias("first_ts"), F.max("o_orderdate").alias("last_ts")
    )


@query("l04_folds", f"SELECT doc_id, CAST({arithmetic_hash_sql('doc_id', 23)} % 5 AS INT) AS fold FROM labels")
def l04_folds(spark, sf):
    return table(spark, sf, "labels").select("doc_id", splits.fold(F.col("doc_id"), 5, 23).alias("fold"))


@query(
    "l04b_stratified_folds",
    f"""SELECT doc_id, quality, CAST(row_number() OVER (PARTITION BY quality ORDER BY {arithmetic_hash_sql('doc_id', 29)}, doc_id) % 5 AS INT) AS fold FROM labels""",
)
def l04b_stratified_folds(spark, sf):
    return splits.stratified_folds(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "quality", 5, 29)


@query(
    "l05_repeated_splits",
    " UNION ALL ".join(
        f"SELECT {r} AS split, o_orderkey, CASE WHEN {arithmetic_hash_sql('o_orderkey', splits.split_seed(31, r))} < 250000 THEN 'test' ELSE 'train' END AS role FROM orders"
        for r in range(3)
    ),
)
def l05_repeated_splits(spark, sf):
    return splits.repeated_splits(table(spark, sf, "orders"), "o_orderkey", 3, 0.25, 31)


def _months(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")).distinct()


_MONTHS_SQL = "m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)"


@query(
    "l05b_leave_one_out",
    f"WITH {_MONTHS_SQL} SELECT row_number() OVER (ORDER BY month) - 1 AS split, month AS test_key FROM m",
)
def l05b_leave_one_out(spark, sf):
    return splits.leave_one_out(_months(spark, sf), "month")


@query(
    "l05c_leave_two_out",
    """WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y FROM orders),
p AS (SELECT row_number() OVER (ORDER BY a.y, b.y) - 1 AS split, a.y AS a, b.y AS b FROM y a JOIN y b ON a.y < b.y)
SELECT CAST(split AS INT) AS split, a AS test_key FROM p UNION ALL SELECT CAST(split AS INT), b FROM p""",
)
def l05c_leave_two_out(spark, sf):
    years = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    return splits.leave_p_out(years, "year", 2).select(F.col("split").cast("int").alias("split"), "test_key")


@query(
    "l05d_expanding_splits",
    f"""WITH {_MONTHS_SQL}, r AS (SELECT month, row_number() OVER (ORDER BY month) AS r, (SELECT count(*) FROM m) AS n FROM m),
b AS (SELECT month, CASE WHEN r <= n - (n // 6) * 5 THEN 0 ELSE (r - (n - (n // 6) * 5) - 1) // (n // 6) + 1 END AS b FROM r),
s AS (SELECT CAST(unnest(range(0, 5)) AS INT) AS split, month, b FROM b)
SELECT split, month, CASE WHEN b <= split THEN 'train' ELSE 'test' END AS role FROM s WHERE b <= split + 1""",
)
def l05d_expanding_splits(spark, sf):
    return splits.expanding_splits(_months(spark, sf), "month", 5)


@query(
    "l06_ridge",
    f"""WITH m AS (SELECT count(*) AS n, var_pop(l_quantity) * count(*) + 0.75 AS a, covar_pop(l_quantity, l_discount) * count(*) AS b,
  var_pop(l_discount) * count(*) + 0.75 AS c, covar_pop(l_quantity, l_extendedprice / 1000) * count(*) AS p,
  covar_pop(l_discount, l_extendedprice / 1000) * count(*) AS q, avg(l_quantity) AS mx, avg(l_discount) AS mz, avg(l_extendedprice / 1000) AS my FROM lineitem),
w AS (SELECT *, (c * p - b * q) / (a * c - b * b) AS wx, (a * q - b * p) / (a * c - b * b) AS wz FROM m)
SELECT 'intercept' AS term, {fx("my - wx * mx - wz * mz", 5)} AS coefficient FROM w UNION ALL SELECT 'l_quantity', {fx("wx", 5)} FROM w
UNION ALL SELECT 'l_discount', {fx("wz", 5)} FROM w""",
)
def l06_ridge(spark, sf):
    li = table(spark, sf, "lineitem").select("l_quantity", "l_discount", (F.col("l_extendedprice") / 1000).alias("price"))
    fitted = linear.ridge(li, ["l_quantity", "l_discount"], "price", 0.75)
    return rounded(spark.createDataFrame(list(fitted.items()), "term STRING, coefficient DOUBLE"), 5)


@query(
    "l06b_simple_regression",
    f"""SELECT l_returnflag, {fx("regr_slope(l_extendedprice, l_quantity)", 3)} AS slope, {fx("regr_intercept(l_extendedprice, l_quantity)", 3)} AS intercept,
 {fx("regr_r2(l_extendedprice, l_quantity)")} AS r2 FROM lineitem GROUP BY 1""",
)
def l06b_simple_regression(spark, sf):
    y, x = F.col("l_extendedprice"), F.col("l_quantity")
    return rounded(
        table(spark, sf, "lineitem")
        .groupBy("l_returnflag")
        .agg(
            fixed(F.regr_slope(y, x), 3).alias("slope"),
            fixed(F.regr_intercept(y, x), 3).alias("intercept"),
            F.regr_r2(y, x).alias("r2"),
        )
    )


@query("l06c_ridge_cross_validation")
def l06c_ridge_cross_validation(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("fold", splits.fold(F.col("l_orderkey"), 5, 37))
    scores, _ = linear.ridge_by_cross_validation(
        li, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", "fold", [0.1, 1.0, 10.0, 100.0, 1000.0]
    )
    return scores


@query("l06d_listing_price_model")
def l06d_listing_price_model(spark, sf):
    """Texts and categories of the listings to a price: hashed features, idf, ridge, back-transformed and clipped."""
    prepared = listing.prepare_listings(items(spark, sf)).withColumn("log_price", F.log1p("price"))
    featured = durable(listing.with_features(listing.dealt_out(prepared, "item_id")))
    train, test = splits.sample_fraction(featured, "item_id", 0.8, 41)
    predicted = listing.price_model(train).transform(test)
    price = F.greatest(F.expm1("prediction"), F.lit(0.0))
    return predicted.select("item_id", "price", price.alias("predicted_price"))


@query(
    "l06e_one_hot_ridge",
    f"""WITH m AS (SELECT avg(p_retailprice) AS mean FROM part)
SELECT p_brand AS term, {fx("sum(p_retailprice - mean) / (count(*) + 10)", 4)} AS value FROM part, m GROUP BY 1""",
)
def l06e_one_hot_ridge(spark, sf):
    """Ridge by conjugate gradients; with one cell a row its answer can be stated."""
    part = table(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("term"), F.lit(1.0).alias("weight"), F.col("p_retailprice").alias("y"))
    coefficients, _ = sparse.ridge(part.select("p_partkey", "term", "weight"), part.select("p_partkey", "y"), "p_partkey", 10.0)
    return rounded(coefficients, 4)


@query("l06f_listing_blocks_price")
def l06f_listing_blocks_price(spark, sf):
    """All ten blocks of the listings, brands filled from the names, to a price: idf over all listings, sparse ridge on a part of them."""
    filled = listing.fill_brands(items(spark, sf), "item_id")
    prepared = durable(listing.prepare_listings(filled).withColumn("y", F.log1p("price")))
    counts = durable(listing.feature_table(prepared, "item_id", 2, listing.all_blocks).select("item_id", F.col("feature").alias("term"), F.col("n").alias("tf")))
    cells = durable(textops.tf_idf(counts, "item_id", prepared.agg(F.count(F.lit(1))).scalar()).select("item_id", "term", "weight"))
    train, test = splits.sample_fraction(prepared.select("item_id", "price", "y"), "item_id", 0.8, 41)
    coefficients, offset = sparse.ridge(cells, train.select("item_id", "y"), "item_id", 0.4)
    predicted = sparse.predict(cells, test, durable(coefficients), offset, "item_id")
    return predicted.select("item_id", "price", F.greatest(F.expm1("prediction"), F.lit(0.0)).alias("predicted_price"))


_TREND_SQL = f"{PANEL_SQL}, t AS (SELECT nation, segment, y / 1000 AS y, (d - DATE '1995-01-01') / 365.25 AS t FROM panel)"


def _trend(spark, sf):
    years = F.date_diff(F.col("d"), F.lit("1995-01-01").cast("date")) / 365.25
    return panel(spark, sf).select("d", "nation", "segment", (F.col("y") / 1000).alias("y"), years.alias("t"))


@query(
    "l07_series_regressions",
    f"""WITH {_TREND_SQL} SELECT nation, segment, count(*) AS n, {fx("regr_intercept(y, t)", 3)} AS intercept, {fx("regr_slope(y, t)", 3)} AS b_t,
 {fx("regr_syy(y, t) - regr_sxy(y, t) ** 2 / regr_sxx(y, t)", 2)} AS rss FROM t GROUP BY 1, 2""",
)
def l07_series_regressions(spark, sf):
    fitted = linear.series_models(_trend(spark, sf), ["nation", "segment"], ["t"], "y")
    return rounded(fitted.withColumn("rss", fixed(F.col("rss"), 2)), 3)


@query("l07b_series_ridge")
def l07b_series_ridge(spark, sf):
    """Trend, weekly terms and the last value, one ridge model per series."""
    terms = dates.weekly_fourier(F.col("d"), 4)
    staged = windowing.lags(_trend(spark, sf), ["nation", "segment"], "d", "y", 1, complete=True).withColumns(terms)
    return rounded(linear.series_models(staged, ["nation", "segment"], ["t", "y_lag1", *terms], "y", alpha=0.75))


@query("l07c_exception_series")
def l07c_exception_series(spark, sf):
    """One segment has a trend of its own and gets trees; all other series get linear models."""
    terms = dates.weekly_fourier(F.col("d"), 4)
    keys = ["nation", "segment"]
    staged = windowing.lags(_trend(spark, sf), keys, "d", "y", 1, complete=True).withColumns(terms)
    features = ["t", "y_lag1", *terms]
    usual = staged.filter("segment <> 'FURNITURE'")
    coefficients = linear.series_models(usual, keys, features, "y", alpha=0.75)
    line = F.col("intercept")
    for f in features:
        line = line + F.col(f) * F.col(f"b_{f}")
    fitted = usual.join(coefficients, keys).select("d", *keys, "y", line.alias("prediction"), F.lit("ridge").alias("model"))
    special = models.assemble(staged.filter("segment = 'FURNITURE'"), [*features, "nation"])
    trees = RandomForestRegressor(labelCol="y", featuresCol="features", numTrees=10, maxDepth=5, seed=5).fit(special)
    other = trees.transform(special).select("d", *keys, "y", "prediction", F.lit("trees").alias("model"))
    return metrics.error_metrics(fitted.unionByName(other), "y", "prediction", ["segment", "model"])


CUSTOMER_FEATURES = ["orders", "total", "mean_price", "largest", "urgent", "nation"]


def customer_features(spark, sf):
    """One row per customer: order totals, the balance as target and an outlier flag."""
    o = table(spark, sf, "orders")
    sums = o.groupBy(F.col("o_custkey").alias("id")).agg(
        F.count(F.lit(1)).cast("double").alias("orders"),
        F.sum("o_totalprice").alias("total"),
        F.avg("o_totalprice").alias("mean_price"),
        F.max("o_totalprice").alias("largest"),
        F.avg((F.col("o_orderpriority") == "1-URGENT").cast("double")).alias("urgent"),
    )
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("double").alias("nation"), F.col("c_acctbal").alias("target")
    )
    joined = c.join(sums, "id", "left").fillna(0.0, subset=["orders", "total", "mean_price", "largest", "urgent"])
    return durable(joined.withColumn("outlier", (F.col("target") < -500).cast("double")))


DOCUMENT_FEATURES = ["chars", "words", "blank_tokens", "english", "digits"]


def document_features(spark, sf):
    """Labelled documents with simple text measures; the label itself is not among the features."""
    d = docs(spark, sf).select(
        "doc_id",
        F.col("n_chars").cast("double").alias("chars"),
        word_count(F.col("text")).cast("double").alias("words"),
        blank_token_count(F.col("text")).cast("double").alias("blank_tokens"),
        (F.col("lang") == "en").cast("double").alias("english"),
        F.regexp_count("text", F.lit(r"\d")).cast("double").alias("digits"),
    )
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("quality"))
    # training passes over the few measures many times, so the texts are read only once
    return durable(d.join(labels, "doc_id"))


@query("l08_boosted_regression")
def l08_boosted_regression(spark, sf):
    c = customer_features(spark, sf).withColumn("valid", splits.in_fraction(F.col("id"), 0.2, 43))
    model = models.boosted_trees(c, CUSTOMER_FEATURES, "target", "valid", 43)
    predicted = model.transform(models.assemble(c, CUSTOMER_FEATURES))
    return metrics.error_metrics(predicted, "target", "prediction", ["valid"])


@query("l08b_boosted_classification")
def l08b_boosted_classification(spark, sf):
    d = document_features(spark, sf).withColumn("valid", splits.in_fraction(F.col("doc_id"), 0.25, 47))
    model = models.boosted_classifier(d, DOCUMENT_FEATURES, "quality", "valid", 47)
    predicted = model.transform(models.assemble(d, DOCUMENT_FEATURES))
    return metrics.confusion(predicted.withColumn("predicted", F.col("prediction")), "quality", "predicted")


@query("l08c_better_than_the_mean", "SELECT true AS better, count(*) AS n FROM customer")
def l08c_better_than_the_mean(spark, sf):
    """On the rows it is fitted on, the model errs less than their mean does."""
    c = customer_features(spark, sf).withColumn("valid", splits.in_fraction(F.col("id"), 0.2, 43))
    predicted = models.boosted_trees(c, CUSTOMER_FEATURES, "target", "valid", 43).transform(models.assemble(c, CUSTOMER_FEATURES))
    gap = F.when(~F.col("valid"), F.pow(F.col("target") - F.col("prediction"), 2))
    return predicted.agg(
        (F.sqrt(F.avg(gap)) < F.stddev_pop(F.when(~F.col("valid"), F.col("target")))).alias("better"), F.count(F.lit(1)).alias("n")
    )


@query(
    "l09b_every_classifier_scores_all",
    f"""WITH n AS (SELECT count(*) AS n FROM labels JOIN documents USING (doc_id) WHERE {arithmetic_hash_sql("doc_id", 53)} < 300000)
SELECT unnest({list(models.CLASSIFIERS)}) AS model, n, true AS a_share FROM n""",
)
def l09b_every_classifier_scores_all(spark, sf):
    d = document_features(spark, sf).withColumn("held_out", splits.in_fraction(F.col("doc_id"), 0.3, 53))
    out = models.compare_classifiers(d, DOCUMENT_FEATURES, "quality", "held_out", 53)
    return out.select("model", "n", F.col("accuracy").between(0.0, 1.0).alias("a_share"))


@query("l09_classifiers")
def l09_classifiers(spark, sf):
    d = document_features(spark, sf).withColumn("held_out", splits.in_fraction(F.col("doc_id"), 0.3, 53))
    return models.compare_classifiers(d, DOCUMENT_FEATURES, "quality", "held_out", 53)


@query("l10_out_of_fold")
def l10_out_of_fold(spark, sf):
    c = customer_features(spark, sf)
    train, test = splits.sample_fraction(c, "id", 0.8, 59)
    forest = lambda: RandomForestRegressor(labelCol="target", featuresCol="features", numTrees=8, maxDepth=4, seed=59)
    own, averaged = models.out_of_fold(train, "id", CUSTOMER_FEATURES, "target", forest, 3, 59, test=test)
    own = own.select("id", "fold", F.col("target"), "prediction")
    scored = averaged.join(test.select("id", "target"), "id").select("id", F.lit(-1).alias("fold"), "target", "prediction")
    return metrics.error_metrics(own.unionByName(scored), "target", "prediction", ["fold"])


@query(
    "l10b_one_score_per_fold",
    f"""SELECT c_custkey AS id, CAST({arithmetic_hash_sql("c_custkey", 59)} % 3 AS INT) AS fold, true AS within FROM customer
WHERE {arithmetic_hash_sql("c_custkey", 59)} < 800000""",
)
def l10b_one_score_per_fold(spark, sf):
    """Every training id has one out-of-fold score, inside the range of the targets, as a forest's is."""
    train, _ = splits.sample_fraction(customer_features(spark, sf), "id", 0.8, 59)
    forest = lambda: RandomForestRegressor(labelCol="target", featuresCol="features", numTrees=8, maxDepth=4, seed=59)
    own, _ = models.out_of_fold(train, "id", CUSTOMER_FEATURES, "target", forest, 3, 59)
    low, high = train.agg(F.min("target")).scalar(), train.agg(F.max("target")).scalar()
    return own.select("id", "fold", F.col("prediction").between(low, high).alias("within"))


@query("l11b_one_stacked_score", "SELECT doc_id, true AS shares FROM labels JOIN documents USING (doc_id)")
def l11b_one_stacked_score(spark, sf):
    inside = [F.col(c).between(0.0, 1.0) for c in ("forest", "logistic", "stacked")]
    return l11_stacking(spark, sf).select("doc_id", (inside[0] & inside[1] & inside[2]).alias("shares"))


@query("l12b_one_combined_prediction", "SELECT c_custkey AS id, true AS finite FROM customer")
def l12b_one_combined_prediction(spark, sf):
    p = F.col("prediction")
    return l12_two_models(spark, sf).select("id", (p.isNotNull() & ~F.isnan(p)).alias("finite"))


@query("l13c_importances_add_up", f"SELECT unnest({DOCUMENT_FEATURES}) AS feature, 1.0::DOUBLE AS total")
def l13c_importances_add_up(spark, sf):
    found = l13_fold_importances(spark, sf)
    return rounded(found.select("feature", found.agg(F.sum("importance")).scalar().alias("total")))


@query("l11_stacking")
def l11_stacking(spark, sf):
    base = {
        "forest": lambda: RandomForestClassifier(labelCol="quality", featuresCol="features", numTrees=8, maxDepth=4, seed=61),
        "logistic": lambda: LogisticRegression(labelCol="quality", featuresCol="features", regParam=0.01),
    }
    return models.stack(document_features(spark, sf), "doc_id", DOCUMENT_FEATURES, "quality", base, 3, 61)


@query("l12_two_models")
def l12_two_models(spark, sf):
    return models.two_model_combination(
        customer_features(spark, sf), "id", CUSTOMER_FEATURES, "target", "outlier", 25, 67
    )


@query("l13_fold_importances")
def l13_fold_importances(spark, sf):
    forest = lambda: RandomForestClassifier(labelCol="quality", featuresCol="features", numTrees=8, maxDepth=4, seed=71)
    return models.fold_importances(document_features(spark, sf), "doc_id", DOCUMENT_FEATURES, "quality", forest, 3, 71)


@query("l13b_permutation_importances")
def l13b_permutation_importances(spark, sf):
    d = document_features(spark, sf)
    forest = RandomForestClassifier(labelCol="quality", featuresCol="features", numTrees=8, maxDepth=4, seed=73)
    model = forest.fit(models.assemble(d, DOCUMENT_FEATURES))
    return models.permutation_importances(model, d, "doc_id", DOCUMENT_FEATURES, "quality", 73)


@query(
    "l17_exogenous_forecast",
    f"""WITH s AS (SELECT CAST(o_orderdate AS DATE) AS d, c_nationkey AS nation, avg(o_totalprice) / 1000 AS y, CAST(count(*) AS DOUBLE) AS orders
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
l AS (SELECT *, lag(y) OVER (PARTITION BY nation ORDER BY d) AS y_lag1 FROM s), k AS (SELECT * FROM l WHERE y_lag1 IS NOT NULL),
m AS (SELECT nation, count(*) AS n, var_pop(y_lag1) AS a, covar_pop(y_lag1, orders) AS b, var_pop(orders) AS c, covar_pop(y_lag1, y) AS p,
 covar_pop(orders, y) AS q, avg(y_lag1) AS mx, avg(orders) AS mz, avg(y) AS my FROM k GROUP BY 1),
w AS (SELECT *, CASE WHEN c < 1e-9 THEN p / a ELSE (c * p - b * q) / (a * c - b * b) END AS wx,
 CASE WHEN c < 1e-9 THEN 0 ELSE (a * q - b * p) / (a * c - b * b) END AS wz FROM m)
SELECT nation, n, {fx("my - wx * mx - wz * mz", 3)} AS intercept, {fx("wx")} AS b_y_lag1, {fx("wz")} AS b_orders FROM w""",
)
def l17_exogenous_forecast(spark, sf):
    """Daily mean per nation explained by its last value and the day's number of orders."""
    o = table(spark, sf, "orders").select("o_custkey", "o_totalprice", F.to_date("o_orderdate").alias("d"))
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    s = o.join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("d", "nation").agg(
        (F.avg("o_totalprice") / 1000).alias("y"), F.count(F.lit(1)).cast("double").alias("orders")
    )
    lagged = windowing.lags(s, ["nation"], "d", "y", 1, complete=True)
    fitted = linear.series_models(lagged, ["nation"], ["y_lag1", "orders"], "y").drop("rss")
    return rounded(fitted.withColumn("intercept", fixed(F.col("intercept"), 3)))
