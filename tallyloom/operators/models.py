"""Models as Spark jobs: per-segment regressors, classifiers, uplift models, searches, importances."""

from __future__ import annotations

import itertools
import random
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.evaluate import regression_metrics
from tallyloom.operators.prepare import class_weights
from tallyloom.operators.sampling import fixed_n, train_test, unit_hash

_HELPERS = ["__x", "__raw", "__p", "__prediction"]


def assembler(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="__x", handleInvalid="error")


def fit(df: DataFrame, estimator: Estimator, columns: Sequence[str]) -> PipelineModel:
    return Pipeline(stages=[assembler(columns), estimator]).fit(df)


def gbt_classifier(label: str, iterations: int = 20, depth: int = 4, seed: int = 1) -> GBTClassifier:
    model = GBTClassifier(labelCol=label, featuresCol="__x", maxIter=iterations, maxDepth=depth, seed=seed, predictionCol="__prediction")
    return model.setRawPredictionCol("__raw").setProbabilityCol("__p")


def forest_classifier(label: str, trees: int = 20, depth: int = 6, weight: str | None = None, seed: int = 1) -> RandomForestClassifier:
    model = RandomForestClassifier(
        labelCol=label, featuresCol="__x", numTrees=trees, maxDepth=depth, seed=seed, rawPredictionCol="__raw",
        probabilityCol="__p", predictionCol="__prediction",
    )
    return model if weight is None else model.setWeightCol(weight)


def gbt_regressor(label: str, iterations: int = 20, depth: int = 4, seed: int = 1) -> GBTRegressor:
    """Boosted trees with absolute loss."""
    return GBTRegressor(labelCol=label, featuresCol="__x", maxIter=iterations, maxDepth=depth, seed=seed, lossType="absolute", predictionCol="__prediction")


def forest_regressor(label: str, trees: int = 20, depth: int = 6, seed: int = 1) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, featuresCol="__x", numTrees=trees, maxDepth=depth, seed=seed, predictionCol="__prediction")


def probability(model: PipelineModel, df: DataFrame, out: str = "score", of: int = 1) -> DataFrame:
    """Probability of one class as a column."""
    return model.transform(df).withColumn(out, vector_to_array("__p")[of]).drop(*_HELPERS)


def predict(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    return model.transform(df).withColumn(out, F.col("__prediction")).drop(*_HELPERS)


def score_table(model: PipelineModel, df: DataFrame, key: str, threshold: float, out: str = "score") -> DataFrame:
    """Key, score and a flag for scores that reach the threshold."""
    return probability(model, df, out).select(key, out, (F.col(out) >= threshold).cast("int").alias("flag"))


def segment_regressors(
    df: DataFrame, segment: str, key: str, label: str, columns: Sequence[str], segments: Sequence, share: float | None = None,
    iterations: int = 10, parallel: int = 4,
) -> tuple[dict, DataFrame]:
    """One regressor per segment, fitted in parallel threads, and its errors on held-out rows.

    All training rows are used. With `share`, every segment trains on the keys whose hash falls into that share of [0, 1).
    """
    rows = train_test(df, key, 0.2, "segments", [segment]).persist()

    def one(value) -> tuple:
        part = rows.where(F.col(segment) == value)
        train = part.where(F.col("split") == "train")
        if share is not None:
            train = train.where(unit_hash(key, "share") < share)
        model = fit(train, gbt_regressor(label, iterations), columns)
        errors = regression_metrics(predict(model, part.where(F.col("split") == "test")), label, "prediction").first()
        return value, model, errors

    with ThreadPoolExecutor(parallel) as pool:
        done = list(pool.map(one, segments))
    rows.unpersist()
    table = [(v, *[float(e[m]) if e[m] is not None else None for m in ("mae", "mse", "rmse", "r2")]) for v, _, e in done]
    kind = df.schema[segment].dataType.simpleString()
    return {v: m for v, m, _ in done}, df.sparkSession.createDataFrame(table, f"{segment} {kind}, mae double, mse double, rmse double, r2 double")


def sampled_grid(space: Mapping[str, Sequence], n: int, seed: int = 1) -> list[dict]:
    """n different combinations of a parameter space, in random order."""
    names = sorted(space)
    every = [dict(zip(names, values, strict=True)) for values in itertools.product(*[space[k] for k in names])]
    return random.Random(seed).sample(every, min(n, len(every)))


def random_search(
    df: DataFrame, estimator: Estimator, columns: Sequence[str], evaluator: Evaluator, space: Mapping[str, Sequence], n: int, key: str, folds: int = 3,
    parallel: int = 4, seed: int = 1,
) -> tuple[PipelineModel, DataFrame]:
    """Cross-validated search over a sampled grid; returns the best model and the table of results.

    The fold of a row comes from a hash of its key, so a partition that is computed again keeps its folds.
    """
    grid = sampled_grid(space, n, seed)
    maps = [{estimator.getParam(k): v for k, v in point.items()} for point in grid]
    search = CrossValidator(
        estimator=Pipeline(stages=[assembler(columns), estimator]), estimatorParamMaps=maps, evaluator=evaluator, numFolds=folds, parallelism=parallel, seed=seed, foldCol="__fold"
    ).fit(df.withColumn("__fold", F.floor(unit_hash(key, f"fold{seed}") * folds).cast("int")))
    rows = [(i, str(point), float(metric)) for i, (point, metric) in enumerate(zip(grid, search.avgMetrics, strict=True))]
    return search.bestModel, df.sparkSession.createDataFrame(rows, "trial int, params string, metric double")


def multiclass(df: DataFrame, label: str, columns: Sequence[str], trees: int = 20) -> PipelineModel:
    """Forest on classes weighted to balance; labels are 0, 1, 2, ..."""
    weighted = df.join(class_weights(df, label), label)
    return fit(weighted, forest_classifier(label, trees, weight="weight"), columns)


def perceptron(df: DataFrame, label: str, columns: Sequence[str], hidden: Sequence[int], classes: int, iterations: int = 50, seed: int = 1) -> PipelineModel:
    steps = [
        assembler(columns), StandardScaler(inputCol="__x", outputCol="__raw_x", withMean=True),
        MultilayerPerceptronClassifier(
            layers=[len(columns), *hidden, classes], labelCol=label, featuresCol="__raw_x", maxIter=iterations, seed=seed, rawPredictionCol="__raw",
            probabilityCol="__p", predictionCol="__prediction",
        ),
    ]
    return Pipeline(stages=steps).fit(df)


def importances(df: DataFrame, estimator: Estimator, columns: Sequence[str], key: str, probe: str = "rand", seed: str = "probe") -> DataFrame:
    """Importance table of a tree model refitted with a random probe column."""
    names = [*columns, probe]
    model = fit(df.withColumn(probe, unit_hash(key, seed)), estimator, names)
    values = model.stages[-1].featureImportances.toArray()
    return df.sparkSession.createDataFrame([(n, float(v)) for n, v in zip(names, values, strict=True)], "feature string, value double")


def linear_huber(df: DataFrame, label: str, columns: Sequence[str], huber: bool) -> DataFrame:
    """Linear or Huber regression: one row per term."""
    model = fit(df, LinearRegression(labelCol=label, featuresCol="__x", loss="huber" if huber else "squaredError", predictionCol="__prediction", maxIter=200, tol=1e-9), columns).stages[-1]
    rows = [("intercept", float(model.intercept)), *[(c, float(b)) for c, b in zip(columns, model.coefficients, strict=True)]]
    return df.sparkSession.createDataFrame(rows, "term string, coefficient double")


# ------------------------------------------------------------ uplift models


def uplift_solo(df: DataFrame, outcome: str, treated: str, columns: Sequence[str], iterations: int = 10) -> DataFrame:
    """One model with the treatment as a feature; uplift is the difference of its two predictions."""
    model = fit(df, gbt_classifier(outcome, iterations), [*columns, treated])
    real = df.withColumn("__w", F.col(treated))
    with_ = probability(model, real.withColumn(treated, F.lit(1)), "__p1")
    both = probability(model, with_.withColumn(treated, F.lit(0)), "__p0")
    return both.withColumn(treated, F.col("__w")).withColumn("uplift", F.col("__p1") - F.col("__p0")).drop("__w", "__p1", "__p0")


def uplift_two_models(df: DataFrame, outcome: str, treated: str, columns: Sequence[str], chain: str | None = None, iterations: int = 10) -> DataFrame:
    """One model per arm; `chain` = "control" or "treated" feeds that arm's prediction to the other model."""
    t, c = df.where(F.col(treated) == 1), df.where(F.col(treated) == 0)
    if chain is None:
        m1, m0 = fit(t, gbt_classifier(outcome, iterations), columns), fit(c, gbt_classifier(outcome, iterations), columns)
        rows = probability(m0, probability(m1, df, "__p1"), "__p0")
    elif chain == "control":
        m0 = fit(c, gbt_classifier(outcome, iterations), columns)
        m1 = fit(probability(m0, t, "__p0"), gbt_classifier(outcome, iterations), [*columns, "__p0"])
        rows = probability(m1, probability(m0, df, "__p0"), "__p1")
    else:
        m1 = fit(t, gbt_classifier(outcome, iterations), columns)
        m0 = fit(probability(m1, c, "__p1"), gbt_classifier(outcome, iterations), [*columns, "__p1"])
        rows = probability(m0, probability(m1, df, "__p1"), "__p0")
    return rows.withColumn("uplift", F.col("__p1") - F.col("__p0")).drop("__p1", "__p0")


def uplift_class_transform(df: DataFrame, outcome: str, treated: str, columns: Sequence[str], iterations: int = 10) -> DataFrame:
    """Model of outcome = treatment; uplift is 2 p - 1."""
    rows = df.withColumn("__z", (F.col(outcome) == F.col(treated)).cast("int"))
    model = fit(rows, gbt_classifier("__z", iterations), columns)
    return probability(model, rows, "__pz").withColumn("uplift", 2 * F.col("__pz") - 1).drop("__z", "__pz")


def uplift_x(df: DataFrame, outcome: str, treated: str, columns: Sequence[str], iterations: int = 10) -> DataFrame:
    """Imputed effects per arm, one regressor each, blended by a propensity model."""
    t, c = df.where(F.col(treated) == 1), df.where(F.col(treated) == 0)
    m1, m0 = fit(t, gbt_classifier(outcome, iterations), columns), fit(c, gbt_classifier(outcome, iterations), columns)
    d1 = probability(m0, t, "__other").withColumn("__d", F.col(outcome) - F.col("__other")).drop("__other")
    d0 = probability(m1, c, "__other").withColumn("__d", F.col("__other") - F.col(outcome)).drop("__other")
    tau1, tau0 = fit(d1, gbt_regressor("__d", iterations), columns), fit(d0, gbt_regressor("__d", iterations), columns)
    e = fit(df, forest_classifier(treated, 10, 4), columns)
    rows = predict(tau0, predict(tau1, probability(e, df, "__e"), "__t1"), "__t0")
    return rows.withColumn("uplift", F.col("__e") * F.col("__t0") + (1 - F.col("__e")) * F.col("__t1")).drop("__e", "__t1", "__t0")


def uplift_meta(df: DataFrame, outcome: str, treated: str, columns: Sequence[str], iterations: int = 10) -> DataFrame:
    """The S, T and X learners side by side, all with boosted trees: `uplift_s`, `uplift_t`, `uplift_x`."""
    rows = df
    for letter, learner in (("s", uplift_solo), ("t", uplift_two_models), ("x", uplift_x)):
        rows = learner(rows, outcome, treated, columns, iterations=iterations).withColumnRenamed("uplift", f"uplift_{letter}")
    return rows
