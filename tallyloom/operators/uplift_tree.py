"""Uplift tree grown level by level: one histogram aggregate per level, honest estimates in the leaves.

Features are cut once at approximate quantiles. On each level every row of the growing half adds to one bin per feature of
its node, so a level is one aggregate of (nodes x features x bins) rows, however many rows there are. The other half of the
rows, by a hash of the key, gives the estimates, so a cut that was chosen by chance does not also report its own effect.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import add_all, count_when, ratio, sum_when
from tallyloom.operators.sampling import key_hash
from tallyloom.session import cut_lineage

SUMS = ["n1", "n0", "y1", "y0"]


@dataclass
class Tree:
    """Cuts of the features, splits and estimates. Node 1 is the root; the children of n are 2n (below the cut) and 2n + 1.

    A split is (feature, bin): rows whose bin is at least that one go to 2n + 1, as do rows without a value.
    `sums` has, per node, rows and outcomes of the treated and of the control rows of the honest half.
    """

    cuts: dict[str, list[float]]
    splits: dict[int, tuple[str, int]] = field(default_factory=dict)
    gains: dict[int, float] = field(default_factory=dict)
    sums: dict[int, dict[str, float]] = field(default_factory=dict)

    def leaves(self) -> list[int]:
        return sorted(n for n in {1, *[c for s in self.splits for c in (2 * s, 2 * s + 1)]} if n not in self.splits)

    def path(self, node: int) -> list[tuple[str, int, bool]]:
        """Splits from the root: (feature, bin, whether the rows are at or above it)."""
        out = []
        while node > 1:
            out.append((*self.splits[node // 2], bool(node % 2)))
            node //= 2
        return out[::-1]

    def node_of(self, nodes: Sequence[int], prefix: str = "__bin_") -> Column:
        """The listed node a binned row belongs to, or NULL."""
        out = None
        for n in nodes:
            here = F.lit(True)
            for feature, cut, above in self.path(n):
                bin_ = F.col(prefix + feature)
                here = here & ((bin_ >= cut) if above else (bin_ < cut))
            out = F.when(here, n) if out is None else out.when(here, n)
        return out if out is not None else F.lit(None).cast("int")

    def uplift(self, node: int) -> float | None:
        """Difference of the rates in the nearest node upwards in which both arms have rows."""
        while node:
            s = self.sums.get(node)
            if s and s["n1"] and s["n0"]:
                return s["y1"] / s["n1"] - s["y0"] / s["n0"]
            node //= 2
        return None

    def rule(self, node: int) -> str:
        parts = []
        for f, cut, above in self.path(node):
            if cut > len(self.cuts[f]):  # above every cut are the rows without a value
                parts.append(f"{f} is {'' if above else 'not '}missing")
            else:
                parts.append(f"{f} {'>=' if above else '<'} {self.cuts[f][cut - 1]:g}")
        return " and ".join(parts) or "all"


def _binned(df: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """Adds the bin of every feature: the number of its cuts at or below the value; one more than all for no value."""
    for f, edges in cuts.items():
        wide = df.withColumn("__value", F.col(f).cast("double"))
        splits = [-math.inf, *edges, math.inf]
        df = Bucketizer(splits=splits, inputCol="__value", outputCol=f"__bin_{f}", handleInvalid="keep").transform(wide).drop("__value")
    return df.withColumns({f"__bin_{f}": F.coalesce(F.col(f"__bin_{f}").cast("int"), F.lit(len(edges) + 1)) for f, edges in cuts.items()})


def _divergence(n1: Column, n0: Column, y1: Column, y0: Column) -> Column:
    gap = ratio(y1, n1) - ratio(y0, n0)
    return gap * gap


def _best_cuts(rows: DataFrame, features: Sequence[str], smallest: int) -> DataFrame:
    """The cut with the largest gain in every node; each child keeps `smallest` rows of both arms."""
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"__bin_{f}").alias("bin")) for f in features])
    t, c = F.col("__w") == 1, F.col("__w") == 0
    counts = rows.select("__node", "__y", "__w", F.inline(cells)).groupBy("__node", "feature", "bin").agg(
        count_when(t).alias("n1"), count_when(c).alias("n0"), sum_when(t, "__y").alias("y1"), sum_when(c, "__y").alias("y0")
    )
    # One row per node, feature and bin from here on.
    whole = Window.partitionBy("__node", "feature")
    below = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.select(
        "__node", "feature", "bin", *[F.coalesce(F.sum(n).over(below), F.lit(0)).alias(f"l_{n}") for n in SUMS],
        *[F.sum(n).over(whole).alias(f"a_{n}") for n in SUMS],
    )
    left, every = ([F.col(f"{side}_{n}") for n in SUMS] for side in "la")
    right = [a - b for a, b in zip(every, left, strict=True)]
    size = add_all(every[:2])
    gain = (
        ratio(add_all(left[:2]), size) * _divergence(*left) + ratio(add_all(right[:2]), size) * _divergence(*right) - _divergence(*every)
    )
    enough = F.least(*left[:2], *right[:2]) >= smallest
    place = F.struct((-F.col("gain")).alias("g"), "feature", "bin")
    return sums.withColumn("gain", gain).where(enough & (F.col("gain") > 0)).groupBy("__node").agg(
        F.min_by(F.struct("feature", "bin", "gain"), place).alias("best")
    ).select("__node", "best.*")


def grow(
    df: DataFrame, features: Sequence[str], outcome: str, treated: str, key: Column | str, depth: int = 4, bins: int = 64,
    smallest: int = 100, least_gain: float = 0.0, seed: str = "honest",
) -> Tree:
    """Tree of at most `depth` levels. The driver holds the cuts and one row per node.

    Rows without an outcome or an arm are left out. `key` decides the half of a row, whatever the layout; rows with one key
    stay together. The cuts come from sketches, whose places can move within their error when rows are laid out anew. A table without rows gives the root alone, without an estimate.
    """
    rows = df.where(F.col(outcome).isNotNull() & F.col(treated).isin(0, 1))
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, max(10000, 100 * bins)).alias(f) for f in features]).first()
    tree = Tree({f: sorted({c for c in found[f] or [] if math.isfinite(c)}) or [0.0] for f in features})
    half = F.pmod(key_hash(key, seed), F.lit(2))
    narrow = _binned(rows.select(
        half.alias("__half"), F.col(outcome).cast("double").alias("__y"), F.col(treated).cast("int").alias("__w"), *features
    ), tree.cuts).drop(*features)
    narrow = cut_lineage(narrow)  # one byte-sized bin per feature: read once per level
    growing = narrow.where("__half = 0")
    level = [1]
    for _ in range(depth):
        at = growing.withColumn("__node", tree.node_of(level)).where(F.col("__node").isNotNull())
        best = [r for r in _best_cuts(at, features, smallest).collect() if r["gain"] > least_gain]
        for r in best:
            tree.splits[r["__node"]], tree.gains[r["__node"]] = (r["feature"], r["bin"]), r["gain"]
        level = sorted(c for r in best for c in (2 * r["__node"], 2 * r["__node"] + 1))
        if not level:
            break
    t, c = F.col("__w") == 1, F.col("__w") == 0
    honest = narrow.where("__half = 1").groupBy(tree.node_of(tree.leaves()).alias("__node")).agg(
        count_when(t).alias("n1"), count_when(c).alias("n0"), sum_when(t, "__y").alias("y1"), sum_when(c, "__y").alias("y0")
    )
    for r in honest.collect():
        node = r["__node"]
        while node:  # a leaf counts for all nodes above it
            s = tree.sums.setdefault(node, dict.fromkeys(SUMS, 0))
            for n in SUMS:
                s[n] += r[n]
            node //= 2
    return tree


def predict(df: DataFrame, tree: Tree) -> DataFrame:
    """Adds `leaf` and `uplift` to every row."""
    nodes = tree.leaves()
    binned = _binned(df, tree.cuts).withColumn("leaf", tree.node_of(nodes))
    value = F.lit(None).cast("double")
    for n in nodes:
        value = F.when(F.col("leaf") == n, F.lit(tree.uplift(n)).cast("double")).otherwise(value)
    return binned.withColumn("uplift", value).drop(*[f"__bin_{f}" for f in tree.cuts])


def leaf_table(df: DataFrame, tree: Tree) -> DataFrame:
    """One row per leaf: its rule, honest rows by arm and uplift."""
    empty = dict.fromkeys(SUMS, 0)
    rows = [
        (n, tree.rule(n), int(tree.sums.get(n, empty)["n1"]), int(tree.sums.get(n, empty)["n0"]), tree.uplift(n)) for n in tree.leaves()
    ]
    return df.sparkSession.createDataFrame(rows, "leaf long, rule string, n_treated long, n_control long, uplift double")
