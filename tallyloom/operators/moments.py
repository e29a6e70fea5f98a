"""Linear models from moments: one aggregate gives X'X and X'y, the driver solves p x p."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import as_column
from tallyloom.functions.stats import t_two_sided


@dataclass
class Moments:
    """Sums of products of (1, x1, ..., xp) and y; they add up over parts of the data."""

    xx: np.ndarray
    xy: np.ndarray
    yy: float
    n: int

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.xx + other.xx, self.xy + other.xy, self.yy + other.yy, self.n + other.n)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.xx - other.xx, self.xy - other.xy, self.yy - other.yy, self.n - other.n)

    def solve(self) -> np.ndarray:
        return np.linalg.lstsq(self.xx, self.xy, rcond=None)[0]

    def mean_x(self) -> np.ndarray:
        """Mean of (1, x1, ..., xp)."""
        return self.xx[0] / self.xx[0, 0]


def collect_moments(
    df: DataFrame, xs: Sequence[str | Column], y: str | Column, weight: Column | None = None, group: Sequence[str] = ()
) -> dict[tuple, Moments]:
    """Moments per group: one aggregate, one row per group to the driver (groups are arms or folds)."""
    w = F.lit(1.0) if weight is None else weight
    columns = [F.lit(1.0), *[as_column(x).cast("double") for x in xs]]
    target = as_column(y).cast("double")
    p = len(columns)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    rows = df.groupBy(*group).agg(
        F.array(*[F.sum(w * columns[i] * columns[j]) for i, j in pairs]).alias("xx"),
        F.array(*[F.sum(w * c * target) for c in columns]).alias("xy"),
        F.sum(w * target * target).alias("yy"), F.count(F.lit(1)).alias("n"),
    ).collect()
    out = {}
    for row in rows:
        xx = np.zeros((p, p))
        for (i, j), value in zip(pairs, row["xx"], strict=True):
            xx[i, j] = xx[j, i] = value
        out[tuple(row[g] for g in group)] = Moments(xx, np.array(row["xy"]), float(row["yy"]), int(row["n"]))
    return out


def ols(moments: Moments, names: Sequence[str]) -> dict[str, dict[str, float]]:
    """Coefficients with standard errors, t, p and 95% intervals (normal quantile)."""
    beta = moments.solve()
    df = max(moments.n - len(beta), 1)
    rss = max(moments.yy - beta @ moments.xy, 0.0)
    cov = np.linalg.pinv(moments.xx) * rss / df
    out = {}
    for i, name in enumerate(["intercept", *names]):
        se = math.sqrt(max(cov[i, i], 0.0))
        t = beta[i] / se if se > 0 else math.inf
        out[name] = {
            "estimate": float(beta[i]), "std_error": se, "t": float(t), "p_value": t_two_sided(t, df) if math.isfinite(t) else 0.0,
            "low": float(beta[i] - 1.959963984540054 * se), "high": float(beta[i] + 1.959963984540054 * se),
        }
    return out


def linear_expression(beta: np.ndarray, xs: Sequence[str | Column]) -> Column:
    """Fitted value as a column expression."""
    out = F.lit(float(beta[0]))
    for b, x in zip(beta[1:], xs, strict=True):
        out = out + F.lit(float(b)) * as_column(x).cast("double")
    return out


def as_rows(results: Mapping[str, float]) -> list[tuple[str, float]]:
    return [(k, float(v)) for k, v in results.items()]
