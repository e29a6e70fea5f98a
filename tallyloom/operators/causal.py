"""Effects of a treatment: experiments, adjustment, matching, weighting, learners, refutations."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import as_column, count_when, ratio, sum_when
from tallyloom.functions.stats import normal_two_sided
from tallyloom.operators.moments import collect_moments, linear_expression, ols
from tallyloom.operators.ranking import bucket_count, ntile
from tallyloom.operators.sampling import key_hash, normal_hash, unit_hash



# ------------------------------------------------------------ experiments


def ab_effects(users: DataFrame, group: str, control: str, outcome: str, shown: str) -> DataFrame:
    """Per treated group against the control: effect, incremental buyers, pooled z, effect on those shown."""
    arms = users.groupBy(F.col(group).alias("grp")).agg(
        F.count(F.lit(1)).alias("sent"), F.sum(outcome).alias("converted"), F.sum(shown).alias("shown")
    )
    base = arms.where(F.col("grp") == control).agg(F.struct(F.max("sent").alias("n"), F.max("converted").alias("y"))).scalar()
    rows = arms.where(F.col("grp") != control).withColumn("__c", base)
    n0, y0 = F.col("__c").getField("n"), F.col("__c").getField("y")
    ate = ratio("converted", "sent") - ratio(y0, n0)
    pooled = ratio(F.col("converted") + y0, F.col("sent") + n0)
    se = F.sqrt(pooled * (1 - pooled) * (1 / F.col("sent") + 1 / n0))
    return rows.select(
        "grp", "sent", "converted", ate.alias("ate"), (ate * F.col("sent")).alias("incremental"),
        F.try_divide(ate, ratio("shown", "sent")).alias("cace"), F.try_divide(ate, se).alias("z"),
    )


def with_p_values(effects: DataFrame) -> list[dict]:
    """One dictionary per group with the two-sided p-value of its z."""
    return [{**r.asDict(), "p_value": normal_two_sided(r["z"])} for r in effects.collect()]


def collapse_groups(group: Column | str, names: Sequence[str]) -> Column:
    """Sub-groups (1D_COMP, 1D_NON_COMP) back to the randomised group (1D)."""
    out = as_column(group)
    for name in names:
        out = F.regexp_replace(out, f"{name}.*", name)
    return out


def beta_posterior(users: DataFrame, group: str, control: str, outcome: str) -> DataFrame:
    """Mean and variance of the rate difference under flat priors (Beta posteriors)."""
    arms = users.groupBy(F.col(group).alias("grp")).agg((F.sum(outcome) + 1).alias("a"), (F.count(F.lit(1)) - F.sum(outcome) + 1).alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    rows = arms.select("grp", "a", "b", (a / (a + b)).alias("m"), (a * b / ((a + b) * (a + b) * (a + b + 1))).alias("v"))
    base = rows.where(F.col("grp") == control).agg(F.struct(F.max("m").alias("m"), F.max("v").alias("v"))).scalar()
    c = rows.where(F.col("grp") != control).withColumn("__c", base)
    return c.select("grp", "a", "b", (F.col("m") - F.col("__c").getField("m")).alias("mean"), (F.col("v") + F.col("__c").getField("v")).alias("variance"))


def beta_draws(spark, a: float, b: float, n: int, seed: str) -> DataFrame:
    """Draws of a Beta variable from two gamma draws (cube-root normal approximation, for a, b above about 10)."""

    def gamma(shape: float, name: str) -> Column:
        root = 1 - 1 / (9 * shape) + normal_hash("id", name) / (3 * math.sqrt(shape))
        return shape * root * root * root

    x, y = gamma(a, seed + "a"), gamma(b, seed + "b")
    return spark.range(n).select("id", (x / (x + y)).alias("draw"))


def exponential_rate_posterior(samples: DataFrame, group: str, value: str, shape: float = 1.0, rate: float = 7.1) -> DataFrame:
    """Gamma posterior of an exponential rate per sample, from count and sum."""
    sums = samples.groupBy(group).agg(F.count(value).alias("n"), F.sum(value).cast("double").alias("s"))
    a, b = F.col("n") + F.lit(shape), F.col("s") + F.lit(rate)
    return sums.select(group, "n", (a / b).alias("mean"), (a / (b * b)).alias("variance"))


def cumulative_increment(daily: DataFrame, day: str, control: str, groups: Sequence[str]) -> DataFrame:
    """Running difference of each group's daily series to the control's; one row per day."""
    upto = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select(day, *[F.sum(F.col(g) - F.col(control)).over(upto).alias(f"increment_{g}") for g in groups])


def two_stage(users: DataFrame, outcome: str, compliance: str, assignment: str) -> DataFrame:
    """Two-stage least squares with one instrument, closed form from one aggregate of moments."""
    y, x, z = (as_column(c).cast("double") for c in (outcome, compliance, assignment))
    m = users.agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.covar_pop(z, y).alias("zy"), F.covar_pop(z, x).alias("zx"), F.var_pop(z).alias("zz"),
        F.var_pop(y).alias("yy"), F.var_pop(x).alias("xx"), F.covar_pop(x, y).alias("xy"),
    )
    b = F.try_divide(F.col("zy"), F.col("zx"))
    noise = F.col("yy") - 2 * b * F.col("xy") + b * b * F.col("xx")
    se = F.sqrt(noise * F.col("zz") / (F.col("zx") * F.col("zx")) / F.col("n"))
    return m.select(b.alias("estimate"), se.alias("std_error"), F.try_divide(b, se).alias("z"))


def naive_difference(users: DataFrame, outcome: str, treated: str) -> DataFrame:
    """Plain difference of means: biased when the groups were not randomised."""
    t = F.col(treated) == 1
    return users.agg((F.avg(F.when(t, F.col(outcome))) - F.avg(F.when(~t, F.col(outcome)))).alias("ate"))


# ------------------------------------------------------------ adjustment


def ols_effect(users: DataFrame, outcome: str, treated: str, covariates: Sequence[str]) -> dict[str, float]:
    """Coefficient of the treatment in a linear model with covariates (back-door, S-learner with OLS)."""
    moments = collect_moments(users, [treated, *covariates], outcome)[()]
    return ols(moments, [treated, *covariates])[treated]


def propensity(users: DataFrame, treated: str, covariates: Sequence[str], out: str = "propensity") -> DataFrame:
    """Logistic model of the treatment, as a probability column."""
    steps = [
        VectorAssembler(inputCols=list(covariates), outputCol="__x", handleInvalid="error"),
        StandardScaler(inputCol="__x", outputCol="__z", withMean=True, withStd=True),
        LogisticRegression(featuresCol="__z", labelCol="__label", probabilityCol="__p", predictionCol="__c", rawPredictionCol="__r", regParam=1e-6),
    ]
    rows = users.withColumn("__label", F.col(treated).cast("double"))
    model = Pipeline(stages=steps).fit(rows)
    return model.transform(rows).withColumn(out, vector_to_array("__p")[1]).drop("__x", "__z", "__label", "__p", "__c", "__r")


def match_nearest(users: DataFrame, outcome: str, treated: str, score: str) -> DataFrame:
    """Effect on the treated: each treated row against the control with the nearest score.

    Controls with the same score count as their mean; of two equally near scores the lower
    one is taken. Scores are reduced to distinct values, cut into buckets by quantiles, and
    the nearest controls across bucket borders are carried over, so no task sees all rows.
    """
    t, y = F.col(treated) == 1, F.col(outcome).cast("double")
    scores = users.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.avg(F.when(~t, y)).alias("c"), count_when(t).alias("nt"), sum_when(t, y).alias("yt")
    )
    n = bucket_count(scores)
    cuts = sorted(set(scores.agg(F.percentile_approx("s", [i / n for i in range(1, n)], 10000)).first()[0]))
    rows = Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="s", outputCol="__b").transform(scores)
    control = F.when(F.col("c").isNotNull(), F.struct("s", "c"))
    place = Window.partitionBy("__b").orderBy("s")
    upto = place.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    onward = place.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    local = rows.withColumns({"__lo": F.last(control, True).over(upto), "__hi": F.first(control, True).over(onward)})
    ends = rows.groupBy("__b").agg(F.max(control).alias("last"), F.min(control).alias("first"))
    # One row per bucket.
    order = Window.orderBy("__b")
    carried = ends.select(
        "__b", F.last("last", True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("__below"),
        F.first("first", True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("__above"),
    )
    near = local.join(carried, "__b").select("s", "nt", "yt", F.coalesce("__lo", "__below").alias("lo"), F.coalesce("__hi", "__above").alias("hi"))
    down, up = F.col("s") - F.col("lo.s"), F.col("hi.s") - F.col("s")
    match = F.when(F.col("lo").isNull(), F.col("hi.c")).when(F.col("hi").isNull() | (down <= up), F.col("lo.c")).otherwise(F.col("hi.c"))
    return near.where(F.col("nt") > 0).agg(ratio(F.sum(F.col("yt") - F.col("nt") * match), F.sum("nt")).alias("att"))


def stratify(users: DataFrame, outcome: str, treated: str, score: str, tie: str, strata: int = 50) -> DataFrame:
    """Effect inside score strata of equal size, weighted by their treated rows."""
    cut = ntile(users, strata, score, tie, out="__stratum")
    t, y = F.col(treated) == 1, F.col(outcome).cast("double")
    parts = cut.groupBy("__stratum").agg(
        count_when(t).alias("n1"), (F.avg(F.when(t, y)) - F.avg(F.when(~t, y))).alias("effect")
    ).where(F.col("effect").isNotNull())
    return parts.agg(ratio(F.sum(F.col("effect") * F.col("n1")), F.sum("n1")).alias("att"))


def weight_inverse(users: DataFrame, outcome: str, treated: str, score: str, clip: float = 1e-6) -> DataFrame:
    """Inverse propensity weighting with weights normalised per arm."""
    e = F.greatest(F.lit(clip), F.least(F.lit(1 - clip), F.col(score).cast("double")))
    t, y = F.col(treated).cast("double"), F.col(outcome).cast("double")
    up, down = t / e, (1 - t) / (1 - e)
    return users.agg((ratio(F.sum(up * y), F.sum(up)) - ratio(F.sum(down * y), F.sum(down))).alias("ate"))


# ------------------------------------------------------------ learners with a linear base


def s_learner(users: DataFrame, outcome: str, treated: str, covariates: Sequence[str]) -> float:
    return ols_effect(users, outcome, treated, covariates)["estimate"]


def t_learner(users: DataFrame, outcome: str, treated: str, covariates: Sequence[str]) -> float:
    """One linear model per arm, from one aggregate; mean difference over all rows."""
    arms = collect_moments(users, covariates, outcome, group=[treated])
    gap = arms[(1,)].solve() - arms[(0,)].solve()
    return float(gap @ (arms[(1,)] + arms[(0,)]).mean_x())


def x_learner(users: DataFrame, outcome: str, treated: str, covariates: Sequence[str], score: str) -> float:
    """Imputed effects per arm, each with its own linear model, blended by the propensity."""
    arms = collect_moments(users, covariates, outcome, group=[treated])
    b0, b1 = arms[(0,)].solve(), arms[(1,)].solve()
    y = F.col(outcome).cast("double")
    imputed = F.when(F.col(treated) == 1, y - linear_expression(b0, covariates)).otherwise(linear_expression(b1, covariates) - y)
    effects = collect_moments(users, covariates, imputed, group=[treated])
    tau0 = linear_expression(effects[(0,)].solve(), covariates)
    tau1 = linear_expression(effects[(1,)].solve(), covariates)
    e = F.col(score)
    return float(users.agg(F.avg(e * tau0 + (1 - e) * tau1)).first()[0])


def r_learner(users: DataFrame, outcome: str, treated: str, covariates: Sequence[str], score: str, key: str, folds: int = 5, seed: str = "r") -> float:
    """Residual-on-residual regression with cross-fitting on hash folds.

    The moments of a fold's complement are all moments less the fold's, so cross-fitting
    takes one aggregate for all folds and no shuffle per fold.
    """
    rows = users.withColumn("__fold", (key_hash(key, seed) % folds).cast("int"))
    parts = collect_moments(rows, covariates, outcome, group=["__fold"])
    whole = None
    for m in parts.values():
        whole = m if whole is None else whole + m
    fitted = F.lit(0.0)
    for (fold,), m in parts.items():
        fitted = F.when(F.col("__fold") == fold, linear_expression((whole - m).solve(), covariates)).otherwise(fitted)
    ry = F.col(outcome).cast("double") - fitted
    rw = F.col(treated).cast("double") - F.col(score)
    effect = collect_moments(rows, covariates, F.try_divide(ry, rw), weight=rw * rw)[()]
    return float(effect.solve() @ whole.mean_x())


def compare(users: DataFrame, outcome: str, treated: str, covariates: Sequence[str], score: str, key: str) -> DataFrame:
    """One table: method and effect. `score` is a given propensity."""
    linear = ols_effect(users, outcome, treated, covariates)["estimate"]
    numbers = {
        "linear": linear, "s_learner": linear, "t_learner": t_learner(users, outcome, treated, covariates),
        "x_learner": x_learner(users, outcome, treated, covariates, score), "r_learner": r_learner(users, outcome, treated, covariates, score, key),
    }
    fixed = users.sparkSession.createDataFrame(list(numbers.items()), "method string, effect double")
    parts = [
        ("matching", match_nearest(users, outcome, treated, score)), ("stratification", stratify(users, outcome, treated, score, key)),
        ("ipw", weight_inverse(users, outcome, treated, score)), ("biased", naive_difference(users, outcome, treated)),
    ]
    for name, df in parts:
        fixed = fixed.unionByName(df.toDF("effect").select(F.lit(name).alias("method"), "effect"))
    return fixed


# ------------------------------------------------------------ refutation


def placebo(users: DataFrame, key: str, treated: str, estimate: Callable[[DataFrame, str], float], seed: str = "placebo") -> float:
    """Effect of a random treatment; should be near 0."""
    name = f"{treated}_placebo"
    return estimate(users.withColumn(name, (unit_hash(key, seed) < 0.5).cast("int")), name)


def random_cause(users: DataFrame, key: str, covariates: Sequence[str], estimate: Callable[[DataFrame, Sequence[str]], float], seed: str = "cause") -> float:
    """Effect with a random covariate added; should stay the same."""
    return estimate(users.withColumn("__random", unit_hash(key, seed)), ["__random", *covariates])


def dummy_outcome(users: DataFrame, key: str, outcome: str, estimate: Callable[[DataFrame, str], float], seed: str = "outcome") -> float:
    """Effect on a random exponential outcome with the mean of the real one; should be near 0."""
    draw = -F.log(1 - unit_hash(key, seed)) * users.agg(F.avg(outcome)).scalar()
    name = f"{outcome}_dummy"
    return estimate(users.withColumn(name, draw), name)


def sample_means(users: DataFrame, group: str, value: str, key: str, samples: int = 200, share: float = 0.1, seed: str = "m") -> DataFrame:
    """Means of repeated random samples per group, to see selection bias.

    Each row is listed under the samples that draw it and added up in the same task. One
    hash of the key is scattered over the samples by odd multipliers.
    """
    size = 2**31
    base = F.pmod(key_hash(key, seed), F.lit(size))

    def drawn(i: Column) -> Column:
        factor = F.pmod(F.lit(1103515245) * (2 * i + 1), F.lit(size))
        return F.pmod(base * factor, F.lit(size)) < F.lit(int(share * size))

    draws = F.filter(F.sequence(F.lit(1).cast("long"), F.lit(samples).cast("long")), drawn)
    return users.select(group, F.col(value).alias("v"), F.explode(draws).alias("sample")).groupBy(group, "sample").agg(
        F.avg("v").alias("mean"), F.count(F.lit(1)).alias("n")
    )


def series_impact(series: DataFrame, name: str, day: str, y: str, control: str, pre_end: Column, post_start: Column) -> DataFrame:
    """Effect after a date: a linear fit of y on a control series before it, and the running gap after it."""
    pre = series.where(F.col(day) <= pre_end)
    fit = pre.groupBy(name).agg(F.regr_slope(y, control).alias("__b"), F.regr_intercept(y, control).alias("__a"))
    post = series.where(F.col(day) >= post_start).join(fit, name)
    expected = F.col("__a") + F.col("__b") * F.col(control)
    upto = Window.partitionBy(name).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return post.select(name, day, y, expected.alias("expected"), (F.col(y) - expected).alias("effect")).withColumn(
        "cumulative", F.sum("effect").over(upto)
    )


def series_impact_many(series: DataFrame, day: str, y: str, controls: Sequence[str], pre_end: Column, post_start: Column) -> DataFrame:
    """The same for one series with several control series; one row per day."""
    beta = collect_moments(series.where(F.col(day) <= pre_end), controls, y)[()].solve()
    post = series.where(F.col(day) >= post_start)
    expected = linear_expression(beta, controls)
    upto = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return post.select(day, y, expected.alias("expected"), (F.col(y) - expected).alias("effect")).withColumn("cumulative", F.sum("effect").over(upto))


def incremental_value(effects: DataFrame, take_rates: dict[str, float]) -> DataFrame:
    """Incremental amount, purchases and revenue per site.

    `effects`: site, treated, amount_effect, purchase_effect, spend, rate.
    """
    share = F.lit(None).cast("double")
    for site, value in take_rates.items():
        share = F.when(F.col("site") == site, value).otherwise(share)
    amount = F.col("amount_effect") * F.col("treated")
    return effects.select(
        "site", amount.alias("inc_amount"), (amount * share - ratio("spend", "rate")).alias("inc_revenue"),
        (F.col("purchase_effect") * F.col("treated")).alias("inc_purchases"),
    )


def add_interim(rows: DataFrame, predicted: str, realised: str, out: str) -> DataFrame:
    """Long-term forecast plus what was realised in the first days; missing parts count 0."""
    return rows.withColumn(out, F.coalesce(F.col(predicted).cast("double"), F.lit(0.0)) + F.coalesce(F.col(realised).cast("double"), F.lit(0.0)))
