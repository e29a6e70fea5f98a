"""Uplift: class transformation, bucket summaries, gain and Qini curves, uplift split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import add_all, as_column, count_when, ratio, sum_when
from tallyloom.operators.ranking import ntile, running_totals
from tallyloom.session import cut_lineage


def class_transform(outcome: Column | str, treated: Column | str) -> Column:
    """1 when outcome equals treatment."""
    return (as_column(outcome) == as_column(treated)).cast("int")


def uplift_from_probability(p: Column | str) -> Column:
    """Uplift of a class-transformation model; needs arms of equal size."""
    return 2 * as_column(p) - 1


def check_arms(df: DataFrame, treated: str, tolerance: float = 0.0) -> DataFrame:
    """Sizes of the arms and whether they are equal."""
    sizes = df.agg(sum_when(F.col(treated) == 1).alias("n_treated"), sum_when(F.col(treated) == 0).alias("n_control"))
    gap = F.abs(F.col("n_treated") - F.col("n_control")) / F.greatest("n_treated", "n_control")
    return sizes.withColumn("equal", gap <= tolerance)


def bucket_summary(df: DataFrame, outcome: str, treated: str, score: str, tie: str, model: Sequence[str] = ()) -> DataFrame:
    """Ten equal-count buckets, best score first (10, 20, ..., 100); rate, positives, n, mean score per arm."""
    cut = ntile(df, 10, score, tie, group=model, descending=True, out="__bucket")
    return cut.groupBy(*model, (F.col("__bucket") * 10).alias("bucket"), F.col(treated).alias("treated")).agg(
        F.avg(F.col(outcome)).alias("conversion"), F.sum(outcome).alias("elements"), F.count(F.lit(1)).alias("n"),
        F.avg(F.col(score).cast("double")).alias("score_avg"),
    )


def _wide(summary: DataFrame, model: Sequence[str]) -> DataFrame:
    """One row per bucket, running sums per arm; ten rows per model from here on."""
    t, c = F.col("treated") == 1, F.col("treated") == 0
    rows = summary.groupBy(*model, "bucket").agg(
        sum_when(t, "elements").alias("y1"), sum_when(c, "elements").alias("y0"), sum_when(t, "n").alias("n1"), sum_when(c, "n").alias("n0")
    )
    upto = Window.partitionBy(*model).orderBy("bucket")
    return rows.withColumns({f"c_{v}": F.sum(v).over(upto) for v in ("y1", "y0", "n1", "n0")})


def _trapezoid(model: Sequence[str], value: Column) -> Column:
    """Area of one bucket step (width 10) under a running value that starts at 0."""
    previous = F.lag(value, 1, 0.0).over(Window.partitionBy(*model).orderBy("bucket"))
    return 10 * (value + previous) / 2


def lift_top(summary: DataFrame, model: Sequence[str] = ()) -> DataFrame:
    """Lift of the best 10% of the treated; sum of rate differences of the first two and three buckets."""
    rows = _wide(summary, model)
    delta = ratio("y1", "n1") - ratio("y0", "n0")
    base = ratio(F.sum(F.col("y1") + F.col("y0")), F.sum(F.col("n1") + F.col("n0")))
    return rows.groupBy(*model).agg(
        ratio(F.sum(F.when(F.col("bucket") == 10, ratio("y1", "n1"))), base).alias("lift_top10"),
        F.sum(F.when(F.col("bucket") <= 20, delta)).alias("uplift_two_buckets"),
        F.sum(F.when(F.col("bucket") <= 30, delta)).alias("uplift_top30"),
    )


def gain(summary: DataFrame, model: Sequence[str] = ()) -> DataFrame:
    """Gini coefficient of the cumulative gain curve and the share of positives in the best 30%."""
    y = (F.col("c_y1") + F.col("c_y0")).cast("double")
    rows = _wide(summary, model).withColumns({"y": y, "step": _trapezoid(model, y)})
    sums = rows.groupBy(*model).agg(
        F.sum("step").alias("actual"), F.max("y").alias("top"),
        ratio(F.sum(F.col("y1") + F.col("y0")), F.sum(F.col("n1") + F.col("n0"))).alias("rate"),
        F.max(F.when(F.col("bucket") <= 30, F.col("y"))).alias("y30"),
    )
    random = 50 * F.col("top")
    optimal = F.col("top") * (100 - 50 * F.col("rate"))
    return sums.select(
        *model, ratio(F.col("actual") - random, optimal - random).alias("gini"), ratio(F.col("y30") * 100, "top").alias("gain_top30")
    )


def qini_curve(summary: DataFrame, model: Sequence[str] = ()) -> DataFrame:
    """Cumulative incremental outcome per bucket: positives of the treated minus what the control rate predicts."""
    rows = _wide(summary, model)
    inc = F.col("c_y1") - F.coalesce(ratio("c_y0", "c_n0"), F.lit(0.0)) * F.col("c_n1")
    return rows.withColumn("incremental", inc)


def qini(summary: DataFrame, model: Sequence[str] = (), negative_effect: bool = False) -> DataFrame:
    """Qini coefficient: area over the random line, as a share of the optimal curve's."""
    rows = qini_curve(summary, model).withColumn("step", _trapezoid(model, F.col("incremental")))
    last = F.max_by("incremental", "bucket")
    positives, units = F.sum(F.col("y1") + F.col("y0")), F.sum(F.col("n1") + F.col("n0"))
    sums = rows.groupBy(*model).agg(
        F.sum("step").alias("actual"), last.alias("last"), (100 * ratio(positives, units)).alias("x"), positives.cast("double").alias("pos")
    )
    top = F.col("pos") if negative_effect else F.col("last")
    random, optimal = 50 * F.col("last"), F.col("x") * top / 2 + (100 - F.col("x")) * top
    return sums.select(*model, ratio(F.col("actual") - random, optimal - random).alias("qini"))


def evaluate(df: DataFrame, outcome: str, treated: str, score: str, tie: str, model: Sequence[str] = ()) -> DataFrame:
    """The five metrics of a model (or of several, one row each), all from one table of ten buckets."""
    summary = cut_lineage(bucket_summary(df, outcome, treated, score, tie, model))
    if not model:
        one_row = [gain(summary).select(F.struct("*")).scalar(), qini(summary).select("qini").scalar()]
        return lift_top(summary).withColumns({"__gain": one_row[0], "qini": one_row[1]}).select(
            "lift_top10", "uplift_two_buckets", "uplift_top30", "__gain.*", "qini"
        )
    return lift_top(summary, model).join(gain(summary, model), list(model)).join(qini(summary, model), list(model))


def compare_models(metrics: DataFrame, model: str, columns: Sequence[str]) -> DataFrame:
    """Metrics of several models, each scaled to [0, 1] across the models; one row per model."""
    whole = Window.partitionBy()
    out = []
    for c in columns:
        low, high = F.min(c).over(whole), F.max(c).over(whole)
        out += [F.col(c), F.coalesce(ratio(F.col(c) - low, high - low), F.lit(0.0)).alias(f"{c}_scaled")]
    return metrics.select(model, *out)


def _row_area(df: DataFrame, outcome: str, treated: str, score: Column | str) -> DataFrame:
    """Area under the row-level Qini curve over distinct scores, with its last value and size."""
    t, y = F.col(treated), F.col(outcome)
    sums = df.groupBy(as_column(score).alias("score")).agg(
        F.sum(t).alias("n1"), F.sum(1 - t).alias("n0"), F.sum(y * t).alias("y1"), F.sum(y * (1 - t)).alias("y0")
    )
    names = ["n1", "n0", "y1", "y0"]
    rows = running_totals(sums, "score", F.lit(0), {f"c_{n}": F.col(n) for n in names}, descending=True, rank="place")

    def value(before: bool) -> Column:
        n1, n0, y1, y0 = ((F.col(f"c_{n}") - F.col(n) if before else F.col(f"c_{n}")).cast("double") for n in names)
        return y1 - F.coalesce(F.try_divide(y0 * n1, n0), F.lit(0.0))

    width = F.col("n1") + F.col("n0")
    return rows.select(
        (width * (value(True) + value(False)) / 2).alias("step"), value(False).alias("value"), "place", width.alias("width")
    ).agg(F.sum("step").alias("area"), F.max_by("value", "place").alias("last"), F.sum("width").cast("double").alias("size"))


def qini_auc(df: DataFrame, outcome: str, treated: str, score: str) -> DataFrame:
    """Row-level Qini AUC: area over the diagonal, as a share of the perfect ordering's."""
    perfect_score = F.col(outcome) * (2 * F.col(treated) - 1)
    over_diagonal = F.col("area") - F.col("last") * F.col("size") / 2
    perfect = _row_area(df, outcome, treated, perfect_score).select(over_diagonal.alias("p"))
    return _row_area(df, outcome, treated, score).select(ratio(over_diagonal, perfect.scalar()).alias("qini_auc"))


def split_gains(df: DataFrame, features: Sequence[str], outcome: str, treated: str, bins: int = 32) -> DataFrame:
    """Divergence gain of every cut of every feature: one level of an uplift tree, as aggregates.

    Features are cut at approximate quantiles; each row adds to one bin per feature. The
    gain is the squared difference between treated and control rates in the two children,
    weighted by size, less the same in the parent.
    """
    shares = [i / bins for i in range(1, bins)]
    cuts = df.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, 10000).alias(f) for f in features]).first()
    edges = {f: F.array(*[F.lit(c) for c in sorted(set(cuts[f]))]) for f in features}

    def cell(f: str) -> Column:
        place = F.size(F.filter(edges[f], lambda c: F.col(f).cast("double") >= c))
        return F.struct(F.lit(f).alias("feature"), place.alias("bin"))

    long = df.select(F.col(outcome).cast("double").alias("y"), F.col(treated).alias("w"), F.inline(F.array(*[cell(f) for f in features])))
    t, c = F.col("w") == 1, F.col("w") == 0
    counts = long.groupBy("feature", "bin").agg(count_when(t).alias("n1"), count_when(c).alias("n0"), sum_when(t, "y").alias("y1"), sum_when(c, "y").alias("y0"))
    # One row per feature and bin from here on.
    names = ["n1", "n0", "y1", "y0"]
    below = Window.partitionBy("feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("feature")
    rows = counts.withColumns({f"l_{n}": F.coalesce(F.sum(n).over(below), F.lit(0)) for n in names}).withColumns({f"a_{n}": F.sum(n).over(whole) for n in names})

    def divergence(n1: Column, n0: Column, y1: Column, y0: Column) -> Column:
        gap = ratio(y1, n1) - ratio(y0, n0)
        return gap * gap

    left = [F.col(f"l_{n}") for n in names]
    right = [F.col(f"a_{n}") - F.col(f"l_{n}") for n in names]
    every = [F.col(f"a_{n}") for n in names]
    size = add_all(every[:2])
    gain_ = ratio(add_all(left[:2]), size) * divergence(*left) + ratio(add_all(right[:2]), size) * divergence(*right) - divergence(*every)
    named = F.create_map(*[x for f in features for x in (F.lit(f), edges[f])])
    return rows.where((F.col("bin") > 0) & gain_.isNotNull()).select(
        "feature", F.element_at(F.element_at(named, F.col("feature")), F.col("bin")).alias("cut"), gain_.alias("gain")
    )


def best_split(df: DataFrame, features: Sequence[str], outcome: str, treated: str, bins: int = 32) -> DataFrame:
    """Cut with the highest gain over all features."""
    gains = split_gains(df, features, outcome, treated, bins)
    return gains.orderBy(F.desc("gain"), "feature", "cut").limit(1)
