"""The grown tree against one grown by hand, and against planted effects."""

import random

from pyspark.sql import functions as F

from tallyloom.operators import uplift_tree as ut
from tallyloom.operators.sampling import key_hash

SCHEMA = "id long, x double, z double, w int, y int"


def rate(rows):
    t, c = [r[4] for r in rows if r[3] == 1], [r[4] for r in rows if r[3] == 0]
    return len(t), len(c), (sum(t) / len(t) - sum(c) / len(c)) if t and c else None


def best_by_hand(rows, smallest):
    """All cuts of all features, one by one; a missing value is above every cut."""
    n1, n0, whole = rate(rows)
    found = []
    for at, name in ((1, "x"), (2, "z")):
        values = sorted({r[at] for r in rows if r[at] is not None})
        for v in values[1:] + ([float("inf")] if any(r[at] is None for r in rows) else []):
            low = [r for r in rows if r[at] is not None and r[at] < v]
            high = [r for r in rows if r[at] is None or r[at] >= v]
            (a1, a0, a), (b1, b0, b) = rate(low), rate(high)
            if min(a1, a0, b1, b0) >= smallest:
                gain = (a1 + a0) / (n1 + n0) * a * a + (b1 + b0) / (n1 + n0) * b * b - whole * whole
                if gain > 0:
                    found.append((gain, low, high))
    return max(found, key=lambda f: f[0]) if found else None


def test_two_levels_equal_brute_force_on_200_rows(spark):
    draw = random.Random(11)
    data = [(i, None if draw.random() < 0.1 else float(draw.randrange(9)), float(draw.randrange(6)), draw.randrange(2), draw.randrange(2)) for i in range(200)]
    df = spark.createDataFrame(data, SCHEMA).repartition(4)
    tree = ut.grow(df, ["x", "z"], "y", "w", "id", depth=2, smallest=8)
    half = {r["id"]: r["h"] for r in df.select("id", F.pmod(key_hash("id", "honest"), F.lit(2)).alias("h")).collect()}
    leaf = {r["id"]: (r["leaf"], r["uplift"]) for r in ut.predict(df, tree).collect()}
    assert len(leaf) == 200
    nodes = {1: [r for r in data if half[r[0]] == 0]}
    for n in (1, 2, 3):
        if n not in nodes:
            continue
        want = best_by_hand(nodes[n], 8)
        assert (n in tree.splits) == (want is not None)
        if want is not None:
            assert abs(tree.gains[n] - want[0]) < 1e-9
            nodes[2 * n], nodes[2 * n + 1] = (
                [r for r in nodes[n] if tree.path(c) and all((r[1 if f == "x" else 2] is None or r[1 if f == "x" else 2] >= (tree.cuts[f][b - 1] if b <= len(tree.cuts[f]) else float("inf"))) == above for f, b, above in tree.path(c))]
                for c in (2 * n, 2 * n + 1))
            assert sorted(map(len, (nodes[2 * n], nodes[2 * n + 1]))) == sorted(map(len, want[1:]))
    for n in tree.leaves():
        mine = [r for r in data if half[r[0]] == 1 and leaf[r[0]][0] == n]
        n1, n0, effect = rate(mine)
        assert (tree.sums.get(n, {"n1": 0})["n1"], tree.sums.get(n, {"n0": 0})["n0"]) == (n1, n0)
        if effect is not None:
            assert all(abs(u - effect) < 1e-9 for i, (m, u) in leaf.items() if m == n)


def test_planted_effect_is_found_and_noise_is_not_believed(spark):
    """The treatment helps where x >= 0.6 and z < 0.5, by 0.4; nowhere else."""
    draw = random.Random(4)
    data = []
    for i in range(20_000):
        x, z, w = draw.random(), draw.random(), draw.randrange(2)
        data.append((i, x, z, w, int(draw.random() < 0.3 + (0.4 if w and x >= 0.6 and z < 0.5 else 0))))
    df = spark.createDataFrame(data, SCHEMA)
    tree = ut.grow(df, ["x", "z"], "y", "w", "id", depth=2)
    got = ut.predict(df, tree).withColumn("inside", (F.col("x") >= 0.65) & (F.col("z") < 0.45)).groupBy("inside").agg(F.avg("uplift").alias("u")).collect()
    effect = {r["inside"]: r["u"] for r in got}
    assert abs(effect[True] - 0.4) < 0.07 and abs(effect[False]) < 0.07
    assert {f for f, _ in tree.splits.values()} == {"x", "z"}
    again = ut.grow(df.repartition(9), ["x", "z"], "y", "w", "id", depth=2)  # cuts move by a sketch's error, no more
    assert all(abs(tree.uplift(n) - again.uplift(n)) < 0.03 for n in (1, *tree.leaves())) and again.leaves() == tree.leaves()


def test_empty_and_one_armed_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    tree = ut.grow(empty, ["x", "z"], "y", "w", "id")
    assert tree.leaves() == [1] and ut.predict(empty, tree).isEmpty() and ut.leaf_table(empty, tree).first()["uplift"] is None
    treated = spark.createDataFrame([(i, float(i), None, 1, i % 2) for i in range(50)] + [(50, 1.0, 1.0, None, 1), (51, 1.0, 1.0, 0, None)], SCHEMA)
    tree = ut.grow(treated, ["x", "z"], "y", "w", "id", smallest=1)
    assert tree.splits == {} and ut.predict(treated, tree).where("uplift is not null").isEmpty() and ut.predict(treated, tree).count() == 52
