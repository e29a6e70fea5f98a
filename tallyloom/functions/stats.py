"""Tail probabilities and special functions for a few driver-side numbers."""

from __future__ import annotations

import math


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    out = d
    for m in range(1, 500):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1 + step * d
            d = 1 / (d if abs(d) > tiny else tiny)
            c = 1 + step / c
            c = c if abs(c) > tiny else tiny
            out *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return out


def beta_cdf(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def t_two_sided(t: float, df: float) -> float:
    return beta_cdf(df / 2, 0.5, df / (df + t * t))


def ks_two_sample(distance: float, n: int, m: int) -> float:
    """Asymptotic p-value of the two-sample Kolmogorov-Smirnov distance."""
    size = math.sqrt(n * m / (n + m))
    x = size * distance
    if x < 0.2:
        return 1.0
    total = sum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 101))
    return min(max(2 * total, 0.0), 1.0)
