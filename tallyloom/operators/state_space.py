"""Local-level model of a daily series with a control series, for effects after a date.

y = level + slope * control + noise, where the level is a random walk over days. Both series are standardised by the
period before the date. The ratio of the walk's variance to the noise is not known, so every ratio of a grid counts with
its likelihood; with the likeliest alone, intervals would hold the truth too seldom. Only the recursions over the days of one series run in a grouped task, so its rows are bounded by the calendar;
forecasts, intervals and running sums are column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RATIOS = (0.0, 1e-4, 3e-4, 1e-3, 3e-3, 0.01, 0.03, 0.1, 0.3, 1.0, 3.0)
PRIOR = 1e4
NORMAL_95 = 1.959963984540054


def level_filter(y: np.ndarray, z: np.ndarray, gap: np.ndarray, ratios: Sequence[float] = RATIOS) -> tuple[np.ndarray, ...]:
    """Kalman filter of (level, slope) for every ratio at once; variances are in units of the noise's.

    `gap`: days since the row before, 0 for the first one. Returns the filtered means (days, 2, ratios), their
    covariances (days, 3, ratios: level, both, slope), the noise's variance and the log-likelihood of each ratio.
    """
    q = np.asarray(ratios, dtype=float)
    level, slope = np.zeros(len(q)), np.zeros(len(q))
    p11, p12, p22 = np.full(len(q), PRIOR), np.zeros(len(q)), np.full(len(q), PRIOR)
    squares, logs = np.zeros(len(q)), np.zeros(len(q))
    means, covariances = np.empty((len(y), 2, len(q))), np.empty((len(y), 3, len(q)))
    for t in range(len(y)):
        p11 = p11 + q * gap[t]
        f = p11 + 2 * z[t] * p12 + z[t] * z[t] * p22 + 1
        miss = y[t] - level - slope * z[t]
        k1, k2 = (p11 + z[t] * p12) / f, (p12 + z[t] * p22) / f
        level, slope = level + k1 * miss, slope + k2 * miss
        p11, p12, p22 = p11 - k1 * k1 * f, p12 - k1 * k2 * f, p22 - k2 * k2 * f
        squares, logs = squares + miss * miss / f, logs + np.log(f)
        means[t], covariances[t] = (level, slope), (p11, p12, p22)
    noise = squares / len(y)
    with np.errstate(divide="ignore"):
        loglik = -len(y) / 2 * np.log(noise) - logs / 2
    return means, covariances, noise, loglik


def smoothed(means: np.ndarray, covariances: np.ndarray, gap: np.ndarray, ratio: float) -> tuple[np.ndarray, np.ndarray]:
    """Levels given all days, and their variances in units of the noise's: the backward pass for one ratio."""
    n = len(means)
    level, variance = np.empty(n), np.empty(n)
    state = means[-1]
    spread = np.array([[covariances[-1][0], covariances[-1][1]], [covariances[-1][1], covariances[-1][2]]])
    level[-1], variance[-1] = state[0], spread[0, 0]
    for t in range(n - 2, -1, -1):
        here = np.array([[covariances[t][0], covariances[t][1]], [covariances[t][1], covariances[t][2]]])
        ahead = here + np.array([[ratio * gap[t + 1], 0.0], [0.0, 0.0]])
        back = np.linalg.solve(ahead, here).T
        state = means[t] + back @ (state - means[t])
        spread = here + back @ (spread - ahead) @ back.T
        level[t], variance[t] = state[0], spread[0, 0]
    return level, variance


def _before(series: DataFrame, name: str, day: str, y: str, control: str, pre_end: Column) -> DataFrame:
    rows = series.where((F.col(day) <= pre_end) & F.col(y).isNotNull() & F.col(control).isNotNull())
    return rows.select(F.col(name).alias("name"), F.col(day).alias("day"), F.col(y).cast("double").alias("y"), F.col(control).cast("double").alias("x"))


def _standard(values: np.ndarray) -> tuple[np.ndarray, float, float]:
    center, scale = float(values.mean()), float(values.std())
    scale = scale if scale > 0 else 1.0
    return (values - center) / scale, center, scale


def _filtered(rows: pd.DataFrame) -> tuple:
    """Rows in order of days, days between them, the filter's results, and center and scale of both series."""
    rows = rows.sort_values("day")
    y, y_mean, y_scale = _standard(rows["y"].to_numpy())
    z, x_mean, x_scale = _standard(rows["x"].to_numpy())
    days = pd.to_datetime(rows["day"])
    gap = np.concatenate([[0.0], np.diff(days.to_numpy()) / np.timedelta64(1, "D")])
    return rows, gap, level_filter(y, z, gap), (y_mean, y_scale, x_mean, x_scale)


NUMBERS = ("ratio", "weight", "level", "slope", "p11", "p12", "p22", "noise", "y_mean", "y_scale", "x_mean", "x_scale")


def fit_levels(series: DataFrame, name: str, day: str, y: str, control: str, pre_end: Column) -> DataFrame:
    """One row per series and ratio: its weight, last level and slope with covariances, the noise's variance, and how
    the series were standardised. Weights of a series add up to 1."""

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows, _, (means, covariances, noise, loglik), scales = _filtered(rows)
        # a series without noise has infinite likelihoods: all ratios that reach it count alike
        gap = np.where(loglik == loglik.max(), 0.0, loglik - loglik.max())
        weight = np.exp(gap) / np.exp(gap).sum()
        values = np.column_stack([RATIOS, weight, means[-1].T, covariances[-1].T, noise, np.tile(scales, (len(RATIOS), 1))])
        out = pd.DataFrame(values, columns=NUMBERS)
        out.insert(0, "last_day", rows["day"].iloc[-1])
        out.insert(0, "name", rows["name"].iloc[0])
        return out

    before = _before(series, name, day, y, control, pre_end)
    kind, date = before.schema["name"].dataType.simpleString(), before.schema["day"].dataType.simpleString()
    schema = f"name {kind}, last_day {date}, " + ", ".join(f"{c} double" for c in NUMBERS)
    return before.groupBy("name").applyInPandas(fit, schema).withColumnRenamed("name", name)


def smooth_levels(series: DataFrame, name: str, day: str, y: str, control: str, pre_end: Column) -> DataFrame:
    """Level of every day before the date given all of them, and its standard error, in the units of y, for the likeliest ratio."""

    def smooth(rows: pd.DataFrame) -> pd.DataFrame:
        rows, gap, (means, covariances, noise, loglik), (y_mean, y_scale, _, _) = _filtered(rows)
        best = int(np.argmax(loglik))
        level, variance = smoothed(means[:, :, best], covariances[:, :, best], gap, RATIOS[best])
        errors = y_scale * np.sqrt(noise[best] * np.maximum(variance, 0.0))
        return pd.DataFrame({"name": rows["name"], "day": rows["day"], "level": y_mean + y_scale * level, "std_error": errors})

    before = _before(series, name, day, y, control, pre_end)
    kind, date = before.schema["name"].dataType.simpleString(), before.schema["day"].dataType.simpleString()
    out = before.groupBy("name").applyInPandas(smooth, f"name {kind}, day {date}, level double, std_error double")
    return out.withColumnsRenamed({"name": name, "day": day})


def _mixed(value: str, variance: str) -> tuple[Column, Column]:
    """Mean and standard deviation over the ratios of a group."""
    mean = F.sum(F.col("weight") * F.col(value))
    spread = F.sum(F.col("weight") * (F.col(variance) + F.col(value) * F.col(value))) - mean * mean
    return mean, F.sqrt(F.greatest(spread, F.lit(0.0)))


def level_impact(series: DataFrame, name: str, day: str, y: str, control: str, pre_end: Column, post_start: Column) -> DataFrame:
    """Effect of every day from `post_start` on and its running sum, with 95% intervals.

    The level is carried on from `pre_end` and grows less certain by day; errors of several days share it, so the
    interval of the sum is wider than independent days would give. Series without a day before the date have no rows.
    """
    post = series.where((F.col(day) >= post_start) & F.col(y).isNotNull() & F.col(control).isNotNull())
    rows = post.select(name, day, F.col(y).cast("double").alias(y), F.col(control).cast("double").alias("__x"))
    rows = rows.join(fit_levels(series, name, day, y, control, pre_end), name)
    z, h = (F.col("__x") - F.col("x_mean")) / F.col("x_scale"), F.datediff(day, "last_day").cast("double")
    rows = rows.withColumns({"__z": z, "__h": h})
    z, h = F.col("__z"), F.col("__h")
    unit = F.col("y_scale") * F.col("y_scale") * F.col("noise")
    rows = rows.withColumns({
        "__effect": F.col(y) - (F.col("y_mean") + F.col("y_scale") * (F.col("level") + F.col("slope") * z)),
        "__var": unit * (F.col("p11") + F.col("ratio") * h + 2 * z * F.col("p12") + z * z * F.col("p22") + 1),
    })

    order = Window.partitionBy(name, "ratio").orderBy(day)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__n", F.row_number().over(order).cast("double"))
    rows = rows.withColumns({
        "__sum": F.sum("__effect").over(upto), "__zs": F.sum("__z").over(upto),
        "__hs": F.sum("__h").over(upto), "__nhs": F.sum(F.col("__n") * h).over(upto),
    })
    n, zs = F.col("__n"), F.col("__zs")
    # days j and k share the walk up to the earlier one: the sum of min(h_j, h_k) over all pairs of days
    shared = (2 * n + 1) * F.col("__hs") - 2 * F.col("__nhs")
    spread = n * n * F.col("p11") + F.col("ratio") * shared + 2 * n * zs * F.col("p12") + zs * zs * F.col("p22") + n
    rows = rows.withColumn("__sum_var", unit * spread)

    (effect, error), (total, total_error) = _mixed("__effect", "__var"), _mixed("__sum", "__sum_var")
    out = rows.groupBy(name, day).agg(
        F.max(y).alias(y), effect.alias("effect"), error.alias("__error"), total.alias("cumulative"), total_error.alias("__total")
    ).withColumn("expected", F.col(y) - F.col("effect"))
    low, high = (lambda c, e: F.col(c) - NORMAL_95 * F.col(e)), (lambda c, e: F.col(c) + NORMAL_95 * F.col(e))
    return out.select(
        name, day, y, "expected", low("expected", "__error").alias("expected_low"), high("expected", "__error").alias("expected_high"),
        "effect", "cumulative", low("cumulative", "__total").alias("cumulative_low"), high("cumulative", "__total").alias("cumulative_high"),
    )
