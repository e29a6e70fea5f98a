"""KS distances by narrowing cells against counting every value; the report of a cluster against its parts."""

import math
import random
from bisect import bisect_right

import pytest

from tallyloom.operators import drift as dr

SCHEMA = "g string, __set int, x double, y double, label string"


def rows(n, seed, shift=0.0):
    """A hot value, ties, NULLs, a cluster without a name and one that has only a base set."""
    draw = random.Random(seed)
    out = []
    for i in range(n):
        side = draw.randrange(2)
        g = draw.choice(["a", "a", "a", "b", None, "only base"])
        if g == "only base":
            side = 0
        x = 1.5 if draw.random() < 0.35 else draw.gauss(shift * side, 1)
        y = None if draw.random() < 0.1 else float(draw.randrange(7))
        out.append((g, side, x, y, draw.choice("pq" if side else "pqr")))
    return out


def distance(a, b):
    if not a or not b:
        return None
    a, b = sorted(a), sorted(b)
    return max(abs(bisect_right(a, v) / len(a) - bisect_right(b, v) / len(b)) for v in {*a, *b})


@pytest.mark.parametrize("shift", [0.0, 0.8])
@pytest.mark.parametrize("cells", [2, 16])
def test_ks_equals_counting_all_values(spark, shift, cells):
    data = rows(3000, 3, shift)
    both = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = {(r["g"], r["feature"]): r for r in dr.ks_scores(both, ["x", "y"], ["g"], cells).collect()}
    limits = {(r["g"], r["feature"]): r for r in dr.ks_bounds(both, ["x", "y"], ["g"], cells).collect()}
    assert got.keys() == limits.keys() == {(g, c) for g in ("a", "b", None, "only base") for c in "xy"}
    for (g, c), r in got.items():
        at = 2 if c == "x" else 3
        sides = [[d[at] for d in data if d[0] == g and d[1] == s and d[at] is not None] for s in (0, 1)]
        want = distance(*sides)
        assert (r["n0"], r["n1"]) == tuple(map(len, sides))
        if want is None:
            assert r["ks"] is None
        else:
            assert math.isclose(r["ks"], want, abs_tol=1e-12)
            assert limits[g, c]["ks_low"] <= r["ks"] + 1e-12 and r["ks"] <= limits[g, c]["ks_high"] + 1e-12


def test_few_values_move_where_the_distance_has_a_peak(spark):
    n = 40_000
    draw = random.Random(1)
    both = spark.createDataFrame([(i % 2, draw.gauss(0.8 * (i % 2), 1)) for i in range(n)], "__set int, x double")
    values = dr._in_cells(both, ["x"], [], dr.KS_CELLS)
    bounds = dr._ks_bounds(values, [])
    moved = values.join(bounds.where("reach > low").select("feature", "cell"), ["feature", "cell"]).count()
    assert 0 < moved < n * 0.2


def test_ks_of_nothing(spark):
    both = spark.createDataFrame([], SCHEMA)
    assert dr.ks_scores(both, ["x"], ["g"]).isEmpty()
    nulls = spark.createDataFrame([("a", 0, None, None, None), ("a", 1, None, None, None)], SCHEMA)
    assert dr.ks_scores(nulls, ["x", "y"]).isEmpty()


def test_infinite_values_and_nan(spark):
    values = [-math.inf, -math.inf, 0.0, 1.0, math.inf, math.nan]
    both = spark.createDataFrame([(s, v) for s, vs in ((0, values[:4]), (1, values[2:])) for v in vs], "__set int, x double")
    assert dr.ks_scores(both, ["x"]).first()["ks"] == 0.5


def test_cluster_report_lists_what_drifted_in_each_cluster(spark):
    draw = random.Random(8)
    data = []
    for i in range(4000):
        side, g = i % 2, "moved" if i % 4 < 2 else "still"
        move = 3.0 if g == "moved" and side else 0.0
        label = "p" if g == "moved" and side else draw.choice("pq")
        data.append((g, side, *[draw.gauss(move if c == 0 else 0, 1) for c in range(8)], label))
    names = [f"x{c}" for c in range(8)]
    both = spark.createDataFrame(data, "g string, __set int, " + ", ".join(f"{c} double" for c in names) + ", label string")
    report = dr.cluster_report(both, names, ["label"], ["g"])
    lists = {r["g"]: r for r in dr.excluded_variables(report, ["g"]).collect()}
    assert lists["moved"]["excluded"] == ["label", "x0"] and lists["moved"]["n_variables"] == 9
    assert "label" not in lists["still"]["excluded"]
    big = {r["feature"]: r["ks"] for r in report.where("g = 'moved' and kind = 'continuous'").collect()}
    assert max(big, key=big.get) == "x0" and big["x0"] > 0.8
