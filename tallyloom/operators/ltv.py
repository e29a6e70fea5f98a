"""Lifetime value: weekly summary, purchase model, value model, output table.

Purchase model: rates are Gamma(r, alpha); after each purchase, and once at the start, a
customer leaves with a probability that is Beta(a, b). Value model: Gamma-Gamma.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import dates
from tallyloom.functions.columns import ratio, rounded
from tallyloom.operators.optimize import Curve, curve, maximise, stencil
from tallyloom.operators.segments import SHARES_5, quantile_segments
from tallyloom.session import cut_lineage


def weekly_summary(days: DataFrame, end: Column) -> DataFrame:
    """Per customer, in weeks: frequency (purchase weeks - 1), recency, age, mean value without the first week.

    `days`: customer_id, day, sales; later days than `end` are left out.
    """
    weeks = days.where(F.col("day") <= end).groupBy("customer_id", dates.week_start_monday("day").alias("week")).agg(
        F.sum("sales").alias("sales"), F.max("day").alias("last_day")
    )
    first = F.min("week")
    rows = weeks.groupBy("customer_id").agg(
        (F.count(F.lit(1)) - 1).alias("frequency"), (F.datediff(F.max("week"), first) / 7).cast("long").alias("recency"),
        (F.datediff(dates.week_start_monday(end), first) / 7).cast("long").alias("age"), F.sum("sales").alias("__all"),
        F.min_by("sales", "week").alias("__first"), F.floor(F.datediff(end, F.max("last_day")) / 7).alias("weeks_since"),
    )
    value = F.coalesce(ratio(F.col("__all") - F.col("__first"), "frequency"), F.lit(0.0))
    return rows.select("customer_id", "frequency", "recency", "age", value.alias("value"), "weeks_since")


# ------------------------------------------------------------ numerics used inside tasks


def log_gamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function for positive x: shift above 8, then Stirling's series."""
    x = np.asarray(x, dtype=float)
    shift = np.zeros_like(x)
    big = x.copy()
    for _ in range(8):
        small = big < 8
        shift = np.where(small, shift - np.log(np.where(small, big, 1.0)), shift)
        big = np.where(small, big + 1, big)
    z = 1 / (big * big)
    series = (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / big
    return shift + (big - 0.5) * np.log(big) - big + 0.5 * math.log(2 * math.pi) + series


def hyp2f1(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Gauss series for 0 <= z < 1, after the transform that keeps the terms decreasing."""
    # F(a, b; c; z) = (1 - z)^(c - a - b) F(c - a, c - b; c; z)
    power = (1 - z) ** (c - a - b)
    a2, b2 = c - a, c - b
    term = np.ones_like(z, dtype=float)
    total = np.ones_like(z, dtype=float)
    for n in range(20000):
        term = term * (a2 + n) * (b2 + n) / ((c + n) * (n + 1)) * z
        total = total + term
        if np.all(np.abs(term) <= 1e-13 * np.abs(total)):
            break
    return power * total


# ------------------------------------------------------------ likelihoods


def _batched(df: DataFrame, columns: Sequence[str], likelihood: Callable) -> Callable[[list[np.ndarray]], list[float]]:
    """Mean of a vectorised log-likelihood over all partitions, for several points in one job."""

    def objective(points: list[np.ndarray]) -> list[float]:
        local = [np.asarray(p, dtype=float) for p in points]

        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = np.zeros(len(local))
            weight = 0.0
            for batch in batches:
                arrays = [batch[c].to_numpy(dtype=float) for c in columns]
                n = batch["__n"].to_numpy(dtype=float)
                weight += n.sum()
                for i, p in enumerate(local):
                    with np.errstate(all="ignore"):
                        sums[i] += float(np.sum(n * likelihood(p, *arrays)))
            # NaN would arrive as NULL, and a sum skips those
            yield pd.DataFrame({"i": np.arange(len(local)), "s": np.where(np.isnan(sums), -np.inf, sums), "w": weight})

        rows = df.mapInPandas(part, "i long, s double, w double").groupBy("i").agg(
            F.sum("s").alias("s"), F.sum("w").alias("w")
        ).collect()
        out = [-math.inf] * len(local)
        for r in rows:
            out[r["i"]] = r["s"] / r["w"] if r["w"] and r["s"] is not None and math.isfinite(r["s"]) else -math.inf
        return out

    return objective


@dataclass(frozen=True)
class Fit:
    """Parameters, their standard errors, the mean log-likelihood, and the jobs it took."""

    parameters: list[float]
    errors: list[float]
    loglik: float
    customers: int
    jobs: int


def fit_likelihood(df: DataFrame, columns: Sequence[str], likelihood: Callable, start: Sequence[float], iterations: int = 40, penalty: float = 0.0) -> Fit:
    """Positive parameters by Newton steps on their logarithms; gradient and Hessian come from the same aggregate as the value.

    Standard errors are those of the observed information, carried over from the logarithms. A direction in which
    the likelihood is flat has an infinite error.
    """
    means = _batched(df, columns, likelihood)
    customers = int(df.agg(F.sum("__n")).first()[0] or 0)

    def objective(points: list[np.ndarray]) -> tuple[Curve, list[float]]:
        around = stencil(points[0])
        every = [*around, *points[1:]]
        values = [v - penalty * float(np.sum(np.exp(p) ** 2)) for v, p in zip(means(every), every, strict=True)]
        with np.errstate(all="ignore"):
            return curve(values[: len(around)], len(points[0])), values[len(around) :]

    found, at, jobs = maximise(objective, np.log(start), iterations)
    parameters = np.exp(found)
    errors = np.full(len(found), math.inf)
    information = -at.hessian * customers
    if np.all(np.isfinite(information)) and np.all(np.linalg.eigvalsh(information) > 0):
        errors = parameters * np.sqrt(np.diag(np.linalg.inv(information)))
    return Fit([float(x) for x in parameters], [float(x) for x in errors], at.value, customers, jobs)


def purchase_loglik(p: np.ndarray, x: np.ndarray, s: np.ndarray, age: np.ndarray) -> np.ndarray:
    r, alpha, a, b = np.exp(p)
    head = log_gamma(r + x) - log_gamma(np.array(r)) + r * np.log(alpha)
    leave = log_gamma(np.array(a + b)) + log_gamma(b + x + 1) - log_gamma(np.array(b)) - log_gamma(a + b + x + 1)
    stay = -(r + x) * np.log(alpha + age)
    gone = np.log(a) - np.log(b + x) - (r + x) * np.log(alpha + s)
    return head + leave + np.logaddexp(stay, gone)


def value_loglik(p: np.ndarray, x: np.ndarray, m: np.ndarray) -> np.ndarray:
    shape, q, v = np.exp(p)
    return (
        log_gamma(shape * x + q) - log_gamma(shape * x) - log_gamma(np.array(q)) + q * np.log(v) + shape * x * np.log(x)
        + (shape * x - 1) * np.log(m) - (shape * x + q) * np.log(v + m * x)
    )


@dataclass(frozen=True)
class PurchaseModel:
    r: float
    alpha: float
    a: float
    b: float
    fit: Fit | None = None


@dataclass(frozen=True)
class ValueModel:
    p: float
    q: float
    v: float
    fit: Fit | None = None


def fit_purchases(summary: DataFrame, penalty: float = 0.0, retry: float = 0.1, iterations: int = 40) -> PurchaseModel:
    """Fit on the distinct (frequency, recency, age) triples; try again with a penalty when it fails.

    The triples are bounded by the weeks of history, and much fewer than customers.
    """
    columns = ["frequency", "recency", "age"]
    triples = summary.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n")).persist()
    try:
        scale = float(triples.agg(F.avg("age")).first()[0] or 1.0)
        start = [1.0, max(scale / 4, 1.0), 1.0, 2.0]
        found = fit_likelihood(triples, columns, purchase_loglik, start, iterations, penalty)
        if not np.all(np.isfinite(found.parameters)) or np.any(np.abs(np.log(found.parameters)) > 12):
            found = fit_likelihood(triples, columns, purchase_loglik, start, iterations, retry)
    finally:
        triples.unpersist()
    return PurchaseModel(*found.parameters, fit=found)


def positive_values(summary: DataFrame) -> DataFrame:
    """Zero values become the smallest positive one, so that every customer has a value."""
    low = summary.where(F.col("value") > 0).agg(F.min("value")).scalar()
    return summary.withColumn("value", F.when(F.col("value") > 0, F.col("value")).otherwise(low))


def fit_values(summary: DataFrame, frequency: str = "frequency", shift: int = 1, iterations: int = 40) -> ValueModel:
    """Fit the value model on (frequency + shift, value)."""
    rows = positive_values(summary).select((F.col(frequency) + shift).alias("x"), "value", F.lit(1).alias("__n")).persist()
    try:
        mean = float(rows.agg(F.avg("value")).first()[0])
        found = fit_likelihood(rows, ["x", "value"], value_loglik, [2.0, 3.0, mean], iterations)
    finally:
        rows.unpersist()
    return ValueModel(*found.parameters, fit=found)


def parameter_table(spark: SparkSession, names: Sequence[str], fit: Fit) -> DataFrame:
    """One row: the parameters, their standard errors (`se_...`), the mean log-likelihood and the number of customers."""
    columns = ", ".join([f"{n} double" for n in names] + [f"se_{n} double" for n in names])
    row = (*fit.parameters, *fit.errors, fit.loglik, fit.customers)
    return spark.createDataFrame([row], f"{columns}, loglik double, customers long")


# ------------------------------------------------------------ predictions


def p_alive(model: PurchaseModel) -> Column:
    x, s, age = (F.col(c).cast("double") for c in ("frequency", "recency", "age"))
    odds = model.a / (model.b + x) * F.pow((model.alpha + age) / (model.alpha + s), model.r + x)
    return 1 / (1 + odds)


def expected_purchases(model: PurchaseModel, horizon: float = 52.0) -> Column:
    """Expected purchases of the next `horizon` weeks; only the hypergeometric series runs in Python, per batch."""
    r, alpha, a, b = model.r, model.alpha, model.a, model.b

    @F.pandas_udf("double")
    def series(x: pd.Series, age: pd.Series) -> pd.Series:
        x, age = x.to_numpy(dtype=float), age.to_numpy(dtype=float)
        z = horizon / (alpha + age + horizon)
        return pd.Series(hyp2f1(r + x, b + x + 1, a + b + x, z))

    x, age = F.col("frequency").cast("double"), F.col("age").cast("double")
    grow = F.pow((alpha + age) / (alpha + age + horizon), r + x) * series(x, age)
    return p_alive(model) * (a + b + x) / (a - 1) * (1 - grow)


def expected_value(model: ValueModel, frequency: Column | str = "frequency", value: Column | str = "value") -> Column:
    x = (F.col(frequency) if isinstance(frequency, str) else frequency).cast("double")
    m = (F.col(value) if isinstance(value, str) else value).cast("double")
    return model.p * (model.v + x * m) / (model.p * x + model.q - 1)


def lifetime_value(df: DataFrame, purchases: str, value: str) -> DataFrame:
    """Value of the horizon, and the score that weights it by purchases once more."""
    clv = F.col(purchases) * F.col(value)
    return df.withColumns({"clv": clv, "rank_score": F.col(purchases) * clv})


def churned(summary: DataFrame, weeks: int = 52) -> DataFrame:
    """Customers whose last purchase is more than a year ago."""
    return summary.where(F.col("weeks_since") > weeks)


def output_table(scored: DataFrame, churned_: DataFrame, site: str, month: str) -> DataFrame:
    """Final table: rounded numbers, five segments by expected purchases, churned customers as segment -1.

    `scored`: customer_id, frequency, recency, age, value, purchases, p_alive, clv.
    """
    alive = quantile_segments(cut_lineage(scored.join(churned_, "customer_id", "left_anti")), SHARES_5, "purchases", "customer_id")
    names = {"purchases": "x_days_pred", "recency": "time_first_last", "p_alive": "p_alive_pred", "value": "sales_avg_past", "clv": "sales_pred"}
    rows = alive.select(
        "customer_id", F.col("frequency").alias("x_days_past_minus_1"), F.col("age").alias("time_first_end"),
        *[rounded(c, 4).alias(n) for c, n in names.items()], F.col("segment").alias("quintile"),
    )
    gone = churned_.select("customer_id", F.lit("-1").alias("quintile"))
    return rows.unionByName(gone, allowMissingColumns=True).withColumns({"site": F.lit(site), "photo_id": F.lit(month)})


def merge_scores(base: DataFrame, churn: DataFrame, growth: DataFrame, order: str) -> DataFrame:
    """Join value, churn and growth scores (missing scores count 0) and rank again in five segments."""
    rows = base.join(churn, "customer_id", "left").join(growth, "customer_id", "left").na.fill(0.0, ["churn_score", "growth_score"])
    return quantile_segments(cut_lineage(rows), SHARES_5, order, "customer_id", out="new_segment")
