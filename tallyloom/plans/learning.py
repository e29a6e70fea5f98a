"""Queries that train models; checked for rows, as trees differ between engines."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tallyloom.functions.columns import rounded
from tallyloom.operators import evaluate as ev
from tallyloom.operators import models as ml
from tallyloom.operators.sampling import train_test
from tallyloom.plans.common import r6
from tallyloom.plans.registry import query

COLUMNS = ["past", "recency", "amount", "balance", "nation_id"]


def rows(t):
    """Customers with order history before 1999 and what they did in 1999."""
    day = F.col("created")
    before = day < "1999-01-01"
    block = t.orders.where("status = 'paid'").groupBy(F.col("buyer_id").alias("customer_id")).agg(
        F.count(F.when(before, 1)).cast("double").alias("past"), F.coalesce(F.min(F.when(before, F.datediff(F.lit("1999-01-01").cast("date"), day))), F.lit(2000)).cast("double").alias("recency"),
        F.coalesce(F.sum(F.when(before, F.col("amount"))).cast("double"), F.lit(0.0)).alias("amount"),
        F.count(F.when(day.between("1999-01-01", "1999-12-31"), 1)).alias("future"))
    out = t.customers.select("customer_id", F.col("balance").cast("double").alias("balance"), F.col("nation_id").cast("double").alias("nation_id"), "segment")
    return out.join(block, "customer_id").withColumns({
        "label": (F.col("future") > 1).cast("int"), "w": (F.col("customer_id") % 2).cast("int"), "y": F.col("future").cast("double"),
        "bucket": F.least(F.col("future"), F.lit(2)).cast("int")})


def split(t):
    parts = train_test(rows(t), "customer_id", 0.3, strata=["label"])
    return parts.where("split = 'train'"), parts.where("split = 'test'")


@query("ml_segment_regressors")
def _(t):
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return r6(ml.segment_regressors(rows(t), "segment", "customer_id", "y", COLUMNS, segments, iterations=3)[1])


@query("ml_random_search")
def _(t):
    space = {"maxDepth": [2, 3, 4], "numTrees": [5, 10], "minInstancesPerNode": [1, 5]}
    evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="__raw")
    return ml.random_search(rows(t), ml.forest_classifier("label"), COLUMNS, evaluator, space, 3, "customer_id")[1]


@query("ml_classifier")
def _(t):
    train, test = split(t)
    model = ml.fit(train, ml.gbt_classifier("label", 5), COLUMNS)
    return r6(ev.auc_ks_accuracy(ml.probability(model, test), "score", "label"))


@query("ml_multiclass")
def _(t):
    model = ml.multiclass(rows(t), "bucket", COLUMNS, trees=10)
    scored = ml.predict(model, rows(t))
    return r6(ev.class_report(scored.withColumn("prediction", F.col("prediction").cast("int")), "bucket", "prediction"))


@query("ml_perceptron")
def _(t):
    model = ml.perceptron(rows(t), "bucket", COLUMNS, [8], 3, iterations=20)
    scored = ml.predict(model, rows(t)).withColumn("prediction", F.col("prediction").cast("int"))
    return r6(ev.weighted_f1(scored, "bucket", "prediction"))


@query("ml_forest")
def _(t):
    train, test = split(t)
    model = ml.fit(train, ml.forest_regressor("y", 10), COLUMNS)
    return r6(ev.regression_metrics(ml.predict(model, test), "y", "prediction"))


@query("ml_importance_probe")
def _(t):
    return r6(ml.importances(rows(t), ml.forest_classifier("label", 10), COLUMNS, "customer_id"))


_SEND = "d AS (SELECT site, day, count(*) FILTER (event_type = 'error')::DOUBLE AS sent, COALESCE(sum(value) FILTER (event_type = 'purchase'), 0)::DOUBLE AS amount FROM r_events GROUP BY 1, 2)"


@query("ml_linear_huber", f"WITH {_SEND} SELECT 'intercept' AS term, round(regr_intercept(sent, amount), 4) AS coefficient FROM d UNION ALL SELECT 'amount', round(regr_slope(sent, amount), 4) FROM d")
def _(t):
    daily = t.events.groupBy("site", "day").agg(
        F.count(F.when(F.col("event_type") == "error", 1)).cast("double").alias("sent"), F.coalesce(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).cast("double"), F.lit(0.0)).alias("amount"))
    return ml.linear_huber(daily, "sent", ["amount"], huber=False).withColumn("coefficient", rounded("coefficient", 4))


@query("ml_huber")
def _(t):
    daily = t.events.groupBy("site", "day").agg(
        F.count(F.when(F.col("event_type") == "error", 1)).cast("double").alias("sent"), F.coalesce(F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).cast("double"), F.lit(0.0)).alias("amount"))
    return ml.linear_huber(daily, "sent", ["amount"], huber=True)


@query("ml_score_table")
def _(t):
    train, test = split(t)
    return ml.score_table(ml.fit(train, ml.forest_classifier("label", 10), COLUMNS), test, "customer_id", 0.5)


@query("up_solo")
def _(t):
    return ml.uplift_solo(rows(t), "label", "w", COLUMNS, 3).select("customer_id", "w", "label", "uplift")


@query("up_two_models")
def _(t):
    out = ml.uplift_two_models(rows(t), "label", "w", COLUMNS, None, 3)
    chained = ml.uplift_two_models(rows(t), "label", "w", COLUMNS, "control", 3).select("customer_id", F.col("uplift").alias("uplift_chained"))
    return out.select("customer_id", "w", "label", "uplift").join(chained, "customer_id")


@query("up_meta_s_t_x")
def _(t):
    return ml.uplift_meta(rows(t), "label", "w", COLUMNS, 3).select("customer_id", "w", "label", "uplift_s", "uplift_t", "uplift_x")


@query("up_class_model")
def _(t):
    return ml.uplift_class_transform(rows(t), "label", "w", COLUMNS, 3).select("customer_id", "w", "label", "uplift")
