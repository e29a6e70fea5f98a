"""The local-level model against matrix algebra and simulated shifts."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.functions.columns import date_lit
from tallyloom.operators import state_space as sp

PRE, POST = "2024-04-29", "2024-05-05"
SHORT_PRE, SHORT_POST = "2024-02-25", "2024-03-02"


def simulated(series, days, ratio, shift=0.0, seed=0, skip=0.0):
    rng = np.random.default_rng(seed)
    out = []
    dates = pd.date_range("2024-01-01", periods=days)
    for i in range(series):
        x = rng.normal(50, 5, days)
        level = np.cumsum(rng.normal(0, np.sqrt(ratio), days))
        y = 20 + level + 0.8 * x + rng.normal(0, 1, days) + shift * (np.arange(days) >= 120)
        kept = rng.random(days) >= skip
        out.append(pd.DataFrame({"s": f"s{i}", "day": dates.date, "y": y, "x": x})[kept])
    return pd.concat(out, ignore_index=True)


def by_matrices(rows):
    """Weights of the ratios, forecasts and levels from the joint normal distribution of all days."""
    pre = rows[rows.day <= pd.Timestamp(SHORT_PRE).date()]
    post = rows[rows.day >= pd.Timestamp(SHORT_POST).date()]
    t = lambda r: np.array([(d - pre.day.iloc[0]).days for d in r.day], dtype=float)
    my, sy, mx, sx = pre.y.mean(), pre.y.std(ddof=0), pre.x.mean(), pre.x.std(ddof=0)
    y, z, zp = (pre.y.to_numpy() - my) / sy, (pre.x.to_numpy() - mx) / sx, (post.x.to_numpy() - mx) / sx
    found = []
    for q in sp.RATIOS:
        walk = lambda a, b: sp.PRIOR + q * np.minimum(a[:, None], b[None, :])  # noqa: B023, E731
        cov = walk(t(pre), t(pre)) + sp.PRIOR * np.outer(z, z) + np.eye(len(y))
        noise = y @ np.linalg.solve(cov, y) / len(y)
        loglik = -len(y) / 2 * np.log(noise) - np.linalg.slogdet(cov)[1] / 2
        cross = walk(t(post), t(pre)) + sp.PRIOR * np.outer(zp, z)
        ahead = walk(t(post), t(post)) + sp.PRIOR * np.outer(zp, zp) + np.eye(len(zp)) - cross @ np.linalg.solve(cov, cross.T)
        up = walk(t(pre), t(pre))
        inside = up - up @ np.linalg.solve(cov, up.T)
        found.append((loglik, my + sy * cross @ np.linalg.solve(cov, y), sy**2 * noise * ahead, my + sy * up @ np.linalg.solve(cov, y), sy * np.sqrt(noise * np.diag(inside))))
    logliks = np.array([f[0] for f in found])
    weights = np.exp(logliks - logliks.max()) / np.exp(logliks - logliks.max()).sum()
    expected = sum(w * f[1] for w, f in zip(weights, found, strict=True))
    gaps = [f[1] - expected for f in found]
    cov = sum(w * (f[2] + np.outer(g, g)) for w, f, g in zip(weights, found, gaps, strict=True))
    best = found[int(np.argmax(logliks))]
    return weights, expected, cov, best[3], best[4]


@pytest.mark.parametrize("ratio,skip", [(0.05, 0.0), (0.0, 0.3), (1.0, 0.1)])
def test_against_the_joint_distribution(spark, ratio, skip):
    pdf = simulated(2, 80, ratio, seed=3, skip=skip)
    df = spark.createDataFrame(pdf).repartition(5)
    got = sp.level_impact(df, "s", "day", "y", "x", date_lit(SHORT_PRE), date_lit(SHORT_POST)).toPandas().sort_values(["s", "day"])
    levels = sp.smooth_levels(df, "s", "day", "y", "x", date_lit(SHORT_PRE)).toPandas().sort_values(["s", "day"])
    fits = sp.fit_levels(df, "s", "day", "y", "x", date_lit(SHORT_PRE)).toPandas().sort_values(["s", "ratio"])
    for name, rows in pdf.groupby("s"):
        weights, expected, cov, level, error = by_matrices(rows)
        mine, inside = got[got.s == name], levels[levels.s == name]
        assert np.allclose(fits[fits.s == name].weight, weights, atol=1e-6)
        assert np.allclose(mine.expected, expected, atol=1e-5)
        assert np.allclose(mine.expected_high - mine.expected, sp.NORMAL_95 * np.sqrt(np.diag(cov)), rtol=1e-5)
        sums = [np.sqrt(cov[:k, :k].sum()) for k in range(1, len(cov) + 1)]
        assert np.allclose(mine.cumulative_high - mine.cumulative, sp.NORMAL_95 * np.array(sums), rtol=1e-5)
        assert np.allclose(inside.level, level, atol=1e-4) and np.allclose(inside.std_error, error, rtol=1e-3)


def test_planted_shift_is_covered(spark):
    """300 series with a lasting shift of 3: the interval of the running sum holds the truth about 95 times in 100."""
    df = spark.createDataFrame(simulated(300, 150, 0.03, shift=3.0, seed=5)).persist()
    last = sp.level_impact(df, "s", "day", "y", "x", date_lit(PRE), date_lit(POST)).groupBy("s").agg(
        F.count(F.lit(1)).alias("n"), F.max_by("cumulative_low", "day").alias("low"), F.max_by("cumulative_high", "day").alias("high")
    ).toPandas()
    truth = 3.0 * last["n"]
    assert len(last) == 300 and 0.9 <= ((last.low <= truth) & (truth <= last.high)).mean() <= 0.99


def test_odd_series(spark):
    """A constant series, one row before the date, missing values, and a series that starts after the date."""
    rows = [("flat", f"2024-04-{d:02d}", 2.0, 1.0) for d in range(1, 20)] + [("flat", "2024-05-06", 5.0, 1.0)]
    rows += [("one", "2024-04-01", 7.0, 3.0), ("one", "2024-05-06", 8.0, 3.0), ("one", "2024-05-07", None, 3.0)]
    rows += [("late", "2024-05-06", 1.0, 1.0)]
    df = spark.createDataFrame(rows, "s string, day string, y double, x double").withColumn("day", F.col("day").cast("date"))
    got = {(r["s"], str(r["day"])): r["effect"] for r in sp.level_impact(df, "s", "day", "y", "x", date_lit(PRE), date_lit(POST)).collect()}
    assert got == {("flat", "2024-05-06"): pytest.approx(3.0), ("one", "2024-05-06"): pytest.approx(1.0)}
    assert sp.level_impact(df.limit(0), "s", "day", "y", "x", date_lit(PRE), date_lit(POST)).count() == 0
