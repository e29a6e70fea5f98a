"""Model evaluation from ordered sums, without sorting all rows in one task.

Curves are built over distinct scores: rows with equal scores are added up before the
ranking, so a hot score is one row, and each row knows the sums before and up to it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import as_column, count_when, ratio
from tallyloom.operators.ranking import ntile, running_totals


#: Rows of a group of packed arrays that one task may hold.
PACKED_ROWS = 4_000_000


class NoThreshold(ValueError):
    pass


def score_curve(df: DataFrame, score: str, target: str) -> DataFrame:
    """One row per distinct score, best first: rows and positives at or above it, and totals."""
    counts = df.groupBy(F.col(score).alias("score")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(as_column(target).cast("long")).alias("pos")
    )
    return running_totals(
        counts, "score", F.lit(0), {"n_above": F.col("n"), "pos_above": F.col("pos")}, descending=True, rank="place",
        group_totals={"n_total": "n_above", "pos_total": "pos_above"},
    )


def pr_curve(df: DataFrame, score: str, target: str) -> DataFrame:
    """Precision, recall and reach (share of rows) at each score used as threshold."""
    return score_curve(df, score, target).select(
        F.col("score").alias("threshold"), ratio("pos_above", "n_above").alias("precision"),
        ratio("pos_above", "pos_total").alias("recall"), ratio("n_above", "n_total").alias("reach"),
    )


def mean_average_precision(
    df: DataFrame, score: str | Column, target: str, tie: str, descending: bool = True, group: Sequence[str] = ()
) -> DataFrame:
    """Mean over the positives of (positives so far / rank).

    Rows may come packed, with arrays without nulls as score, target and tie: arrays of a group meet in one task while a group
    has at most `PACKED_ROWS` rows, and are taken apart for the ranking of any number of rows above that.
    """
    if isinstance(score, str) and dict(df.dtypes)[score].startswith("array"):
        sizes = df.groupBy(*group).agg(F.sum(F.size(score)).alias("n")).agg(F.max("n").alias("n"))
        if (sizes.first()["n"] or 0) <= PACKED_ROWS:
            return _packed_average_precision(df, score, target, tie, descending, group)
        df = df.select(*group, F.inline(F.arrays_zip(score, target, tie)))
    hit = F.when(F.col(target) == 1, 1).otherwise(0)
    ranked = running_totals(df, score, tie, {"__hits": hit}, group=group, descending=descending, rank="__rank")
    return ranked.where(F.col(target) == 1).groupBy(*group).agg(F.avg(ratio("__hits", "__rank")).alias("map"))


def _packed_average_precision(df: DataFrame, score: str, target: str, tie: str, descending: bool, group: Sequence[str]) -> DataFrame:
    """The mean average precision of groups whose arrays are put together and ordered in one task each."""

    def one(part: pd.DataFrame) -> pd.DataFrame:
        values, hits, ties = (np.concatenate(part[c].to_list()) for c in (score, target, tie))
        hits = hits[np.lexsort((ties, -values if descending else values))] == 1
        found = (np.cumsum(hits) / np.arange(1, len(hits) + 1))[hits]
        return pd.DataFrame({**{c: part[c].iloc[:1] for c in group}, "map": [found.mean()]}) if len(found) else pd.DataFrame({c: [] for c in (*group, "map")})

    kinds = dict(df.dtypes)
    return df.groupBy(*group).applyInPandas(one, ", ".join([*[f"`{c}` {kinds[c]}" for c in group], "map double"]))


def threshold_sweep(df: DataFrame, score: str, target: str, start: float = 0.001, step: float = 0.01, n: int = 99) -> DataFrame:
    """Precision, recall and reach on a grid: one histogram of the scores, then sums over the grid."""
    grid = [start + step * i for i in range(n)]
    binned = Bucketizer(
        splits=[-float("inf"), *grid, float("inf")], inputCol="__score", outputCol="__bin", handleInvalid="skip"
    ).transform(df.withColumn("__score", F.col(score).cast("double")))
    counts = binned.groupBy(F.col("__bin").cast("int").alias("__bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(as_column(target).cast("long")).alias("pos")
    )
    thresholds = df.sparkSession.createDataFrame([(i + 1, t) for i, t in enumerate(grid)], "__bin int, threshold double")
    # At most n + 1 rows from here on.
    rows = counts.join(thresholds, "__bin", "full").na.fill(0, ["n", "pos"])
    down = Window.orderBy(F.desc("__bin"))
    whole = Window.partitionBy()
    return rows.select(
        "threshold", F.sum("n").over(down).alias("n_above"), F.sum("pos").over(down).alias("pos_above"),
        F.sum("n").over(whole).alias("n_total"), F.sum("pos").over(whole).alias("pos_total"),
    ).where(F.col("threshold").isNotNull()).select(
        "threshold", ratio("pos_above", "n_above").alias("precision"), ratio("pos_above", "pos_total").alias("recall"),
        ratio("n_above", "n_total").alias("reach"),
    )


def lowest_threshold(sweep: DataFrame, precision: float = 0.6) -> DataFrame:
    """Lowest threshold whose precision reaches a floor, with its precision, recall and reach."""
    row = F.struct("threshold", "precision", "recall", "reach")
    return sweep.where(F.col("precision") >= precision).agg(F.min_by(row, "threshold").alias("r")).select("r.*")


def most_precise_threshold(sweep: DataFrame, base_rate: float | Column, floor: float = 0.6, check: bool = True) -> DataFrame:
    """Most precise threshold that reaches at least half the base rate; the lower one wins ties.

    With `check`, fail when no such threshold is more precise than the floor.
    """
    base = F.lit(base_rate) if isinstance(base_rate, float) else base_rate
    row = F.struct("threshold", "precision", "recall", "reach")
    best = sweep.where((F.col("reach") >= base / 2) & F.col("precision").isNotNull()).agg(
        F.max_by(row, F.struct("precision", -F.col("threshold"))).alias("r")
    ).select("r.*")
    if check and best.where(F.col("precision") > floor).isEmpty():
        raise NoThreshold(f"no threshold is more precise than {floor}")
    return best


def lift_threshold(df: DataFrame, score: str, target: str, tie: str, buckets: int = 50) -> DataFrame:
    """Lowest score of the first of the equal-count buckets whose rate exceeds the mean."""
    cut = ntile(df, buckets, score, tie, out="__bucket")
    rates = cut.groupBy("__bucket").agg(
        F.sum(as_column(target).cast("long")).alias("pos"), F.count(F.lit(1)).alias("n"), F.min(score).alias("lowest")
    )
    whole = Window.partitionBy()  # one row per bucket
    better = rates.withColumn("mean", ratio(F.sum("pos").over(whole), F.sum("n").over(whole))).where(
        ratio("pos", "n") > F.col("mean")
    )
    return better.agg(F.min("__bucket").alias("bucket"), F.min_by("lowest", "__bucket").alias("threshold"))


def partial_recall(df: DataFrame, score: str, target: str, low: float = 0.65, high: float = 0.7) -> DataFrame:
    """Mean recall of the thresholds whose precision lies in (low, high]."""
    curve = pr_curve(df, score, target).where((F.col("precision") > low) & (F.col("precision") <= high))
    return curve.agg(F.avg("recall").alias("partial_recall"))


def regression_metrics(df: DataFrame, actual: str, predicted: str, group: Sequence[str] = ()) -> DataFrame:
    """MAE, MSE, RMSE and R squared, from one aggregate."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    sums = df.groupBy(*group).agg(
        F.avg(F.abs(y - p)).alias("mae"), F.avg((y - p) * (y - p)).alias("mse"), F.var_pop(y).alias("__var")
    )
    return sums.select(*group, "mae", "mse", F.sqrt("mse").alias("rmse"), (1 - ratio("mse", "__var")).alias("r2"))


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support of each class."""
    a = df.groupBy(F.col(actual).alias("label")).agg(F.count(F.lit(1)).alias("support"), count_when(F.col(actual) == F.col(predicted)).alias("hits"))
    p = df.groupBy(F.col(predicted).alias("label")).agg(F.count(F.lit(1)).alias("predicted"))
    rows = a.join(p, "label", "full").na.fill(0, ["support", "hits", "predicted"])
    precision, recall = ratio("hits", "predicted"), ratio("hits", "support")
    f1 = F.coalesce(ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")), F.lit(0.0))
    return rows.select("label", "support", F.coalesce(precision, F.lit(0.0)).alias("precision"), F.coalesce(recall, F.lit(0.0)).alias("recall"), f1.alias("f1"))


def weighted_f1(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    report = class_report(df, actual, predicted)
    return report.agg(ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"))


def roc_points(df: DataFrame, score: str, target: str) -> DataFrame:
    curve = score_curve(df, score, target)
    neg_above, neg_total = F.col("n_above") - F.col("pos_above"), F.col("n_total") - F.col("pos_total")
    return curve.select(
        F.col("score").alias("threshold"), ratio("pos_above", "pos_total").alias("tpr"), ratio(neg_above, neg_total).alias("fpr")
    )


def auc_ks_accuracy(df: DataFrame, score: str, target: str, cut: float = 0.5) -> DataFrame:
    """Area under the ROC curve (ties count half), KS distance, accuracy at a cut."""
    curve = score_curve(df, score, target)
    neg, pos = F.col("n") - F.col("pos"), F.col("pos")
    neg_above = F.col("n_above") - F.col("pos_above")
    neg_total = F.col("n_total") - F.col("pos_total")
    area = F.sum(neg.cast("double") * (F.col("pos_above") - pos / 2))
    right = F.sum(F.when(F.col("score") >= cut, pos).otherwise(neg))
    return curve.agg(
        ratio(area, F.max(F.col("pos_total").cast("double") * neg_total)).alias("auc"),
        F.max(ratio("pos_above", "pos_total") - ratio(neg_above, neg_total)).alias("ks"),
        ratio(right, F.max("n_total")).alias("accuracy"),
    )


def brier(df: DataFrame, probability: str, target: str) -> DataFrame:
    error = F.col(probability).cast("double") - F.col(target)
    return df.agg(F.avg(error * error).alias("brier"))


def coverage(lists: DataFrame, items: str, catalogue_size: int | Column) -> DataFrame:
    """Share of the catalogue that occurs in any list."""
    seen = lists.select(F.explode(items).alias("item")).distinct().agg(F.count(F.lit(1)).alias("n"))
    size = F.lit(catalogue_size) if isinstance(catalogue_size, int) else catalogue_size
    return seen.select(ratio("n", size).alias("coverage"))


def topk_accuracy(lists: DataFrame, items: str, target: str, ks: Sequence[int]) -> DataFrame:
    """Share of rows whose target is among the first k items."""
    place = F.array_position(items, F.col(target))
    return lists.agg(*[F.avg(F.when((place > 0) & (place <= k), 1.0).otherwise(0.0)).alias(f"top_{k}") for k in ks])


def select_features(importances: DataFrame, feature: str, value: str, probe: str = "rand") -> DataFrame:
    """Features above the random probe, at least a thousandth of the second highest, and above 0.

    One row per feature of a model, so the table is small.
    """
    top = importances.select(value).orderBy(F.desc(value)).limit(2).agg(F.min(value)).scalar()
    limit = importances.where(F.col(feature) == probe).agg(F.max(value)).scalar()
    return importances.where((F.col(value) > limit) & (F.col(value) >= top / 1000) & (F.col(value) > 0)).select(feature)
