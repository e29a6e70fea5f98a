"""Newton's method for an objective that is a Spark aggregate.

One job returns the value at several points, and at the first of them the gradient and the Hessian as well,
so a step and the shorter steps it may have to fall back to cost one job together.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np


@dataclass
class Curve:
    """Value, gradient and Hessian of an objective at a point."""

    value: float
    gradient: np.ndarray
    hessian: np.ndarray


def stencil(point: np.ndarray, h: float = 1e-3) -> list[np.ndarray]:
    """The points of central differences: the point itself, both ways on each axis, four corners for each pair of axes."""
    moves = h * np.eye(len(point))
    out = [point]
    for i in range(len(point)):
        out += [point + moves[i], point - moves[i]]
        for j in range(i):
            out += [point + a * moves[i] + b * moves[j] for a in (1, -1) for b in (1, -1)]
    return out


def curve(values: Sequence[float], p: int, h: float = 1e-3) -> Curve:
    """Differences of the values at `stencil`."""
    gradient, hessian = np.zeros(p), np.zeros((p, p))
    at = 1
    for i in range(p):
        up, down = values[at], values[at + 1]
        gradient[i], hessian[i, i] = (up - down) / (2 * h), (up - 2 * values[0] + down) / h**2
        at += 2
        for j in range(i):
            a, b, c, d = values[at : at + 4]
            hessian[i, j] = hessian[j, i] = (a - b - c + d) / (4 * h**2)
            at += 4
    return Curve(float(values[0]), gradient, hessian)


def maximise(
    objective: Callable[[list[np.ndarray]], tuple[Curve, Sequence[float]]], start: Sequence[float], iterations: int = 40,
    tolerance: float = 1e-9,
) -> tuple[np.ndarray, Curve, int]:
    """The best point, its curve and the number of evaluations.

    `objective` takes points and returns the curve at the first and the values of the others. Directions in which
    the objective is not concave are climbed by the size of their curvature; a step is at most 2 long.
    """
    x = np.asarray(start, dtype=float)
    here, _ = objective([x])
    jobs = 1
    shorter = [0.5, 0.2, 0.05, 0.01, 0.001]
    for _ in range(iterations):
        if not (np.all(np.isfinite(here.gradient)) and np.all(np.isfinite(here.hessian))):
            break
        sizes, axes = np.linalg.eigh(-here.hessian)
        step = axes @ ((axes.T @ here.gradient) / np.maximum(np.abs(sizes), 1e-6))
        step *= min(1.0, 2 / max(float(np.linalg.norm(step)), 1e-300))
        there, values = objective([x + step, *[x + s * step for s in shorter]])
        jobs += 1
        values = np.where(np.isfinite(values), values, -np.inf)
        whole = there.value if np.isfinite(there.value) else -np.inf
        best = int(np.argmax(values))
        if max(whole, values[best]) - here.value < tolerance:
            break
        if whole >= values[best]:
            x, here = x + step, there
        else:
            x = x + shorter[best] * step
            here, _ = objective([x])
            jobs += 1
    return x, here, jobs
