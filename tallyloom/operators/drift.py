"""Drift between a base set and a current set, for all features in one pass each."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.config import DRIFT_CATEGORICAL, DRIFT_SIGMAS, OUTLIER_SIGMAS
from tallyloom.functions import stats
from tallyloom.functions.columns import count_when, ratio
from tallyloom.operators.prepare import split_by_type
from tallyloom.operators.ranking import value_cells
from tallyloom.session import cut_lineage


def variable_types(df: DataFrame, leave_out: Sequence[str]) -> tuple[list[str], list[str]]:
    """Continuous and categorical variables, without id and target."""
    return split_by_type(df, leave_out)


def both_sets(base: DataFrame, current: DataFrame) -> DataFrame:
    """Both sets in one frame, marked 0 (base) and 1 (current)."""
    return base.withColumn("__set", F.lit(0)).unionByName(current.withColumn("__set", F.lit(1)))


def null_outliers(df: DataFrame, columns: Sequence[str], sigmas: float = OUTLIER_SIGMAS, group: Sequence[str] = ()) -> DataFrame:
    """Values at least `sigmas` standard deviations from their mean become NULL; one aggregate for all columns."""
    stats_ = df.groupBy(*group).agg(
        *[f(c).alias(f"__{n}_{c}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))]
    )
    fixed = {
        c: F.when(F.abs(F.try_divide(F.col(c).cast("double") - F.col(f"__m_{c}"), F.col(f"__s_{c}"))) < sigmas, F.col(c)) for c in columns
    }
    if group:
        wide = df.join(stats_, list(group), "left")
    else:
        packed = stats_.select(F.struct("*")).scalar()
        wide = df.withColumn("__stats", packed)
        fixed = {
            c: F.when(F.abs(F.try_divide(F.col(c).cast("double") - F.col(f"__stats.__m_{c}"), F.col(f"__stats.__s_{c}"))) < sigmas, F.col(c))
            for c in columns
        }
    return wide.withColumns(fixed).select(*df.columns)


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str], kind: str = "double") -> DataFrame:
    """One row per feature and value; NULLs are left out. Made inside each task, before any shuffle."""
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(kind).alias("value")) for c in columns])
    return df.select(*keep, F.inline(cells)).where(F.col("value").isNotNull())


def t_scores(both: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """Pooled two-sample t of every feature, from one aggregate over both sets."""
    long = long_values(both, columns, [*group, "__set"])
    a, b = F.col("__set") == 0, F.col("__set") == 1
    v = F.col("value")
    sums = long.groupBy(*group, "feature").agg(
        count_when(a).alias("n0"), count_when(b).alias("n1"), F.avg(F.when(a, v)).alias("m0"), F.avg(F.when(b, v)).alias("m1"),
        F.var_samp(F.when(a, v)).alias("v0"), F.var_samp(F.when(b, v)).alias("v1"),
    )
    n0, n1 = F.col("n0"), F.col("n1")
    pooled = ((n0 - 1) * F.col("v0") + (n1 - 1) * F.col("v1")) / (n0 + n1 - 2)
    t = F.try_divide(F.col("m0") - F.col("m1"), F.sqrt(pooled * (1 / n0 + 1 / n1)))
    return sums.select(*group, "feature", "n0", "n1", t.alias("t"))


KS_CELLS = 256
#: At most this many cuts of a feature reach the driver's plan; more clusters share them.
KS_CUTS = 4096


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, small: bool = False) -> DataFrame:
    """Join in which a NULL key finds a NULL key; the right side's keys go."""
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(F.broadcast(renamed) if small else renamed, same, how).drop(*[f"__r_{k}" for k in keys])


def _ks_cuts(both: DataFrame, columns: Sequence[str], group: Sequence[str], cells: int) -> dict[str, list[float]]:
    """Cuts of every feature from one mergeable sketch for each cluster, set and feature; a value that fills several cells gets its own."""
    shares = [i / cells for i in range(1, cells)]
    sketches = long_values(both, columns, [*group, "__set"]).groupBy(*group, "__set", "feature").agg(
        F.percentile_approx("value", shares, 20 * cells).alias("cuts")
    )
    out: dict[str, set[float]] = {c: set() for c in columns}
    for row in sketches.select("feature", "cuts").toLocalIterator():
        found = row["cuts"]
        out[row["feature"]] |= set(found) | {math.nextafter(x, math.inf) for x, y in zip(found, found[1:], strict=False) if x == y}
    cuts = {}
    for c, edges in out.items():
        ordered = sorted(e for e in edges if math.isfinite(e))
        cuts[c] = ordered[:: len(ordered) // KS_CUTS + 1]
    return cuts


def _ks_bounds(values: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row per cluster, feature and cell: counts before the cell and in all, the distance at its end, and how far it could go inside.

    All values of a cell lie after those of the cells before it. The distance at the end of a cell is exact. Inside, the share of
    one set can have grown by the whole cell before the share of the other grows at all, which bounds the distance there.
    """
    counts = values.groupBy(*group, "feature", "cell").agg(
        count_when(F.col("__set") == 0).alias("a"), count_when(F.col("__set") == 1).alias("b"),
        F.min("value").alias("lo"), F.max("value").alias("hi"),
    )
    # Rows per cluster and feature are bounded by the cuts, so these windows are small.
    whole = Window.partitionBy(*group, "feature")
    upto = whole.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = counts.select("*", F.sum("a").over(upto).alias("ca"), F.sum("b").over(upto).alias("cb"),
                           F.sum("a").over(whole).alias("na"), F.sum("b").over(whole).alias("nb"))
    before = totals.withColumns({"a0": F.col("ca") - F.col("a"), "b0": F.col("cb") - F.col("b")})
    end = F.abs(ratio("ca", "na") - ratio("cb", "nb"))
    reach = F.greatest(ratio("ca", "na") - ratio("b0", "nb"), ratio("cb", "nb") - ratio("a0", "na"))
    known = before.withColumns({"end": end, "reach": F.when(F.col("lo") < F.col("hi"), reach).otherwise(end)})
    return known.withColumn("low", F.max("end").over(whole))


def _in_cells(both: DataFrame, columns: Sequence[str], group: Sequence[str], cells: int) -> DataFrame:
    return value_cells(both, _ks_cuts(both, columns, group, cells), [*group, "__set"])


def ks_bounds(both: DataFrame, columns: Sequence[str], group: Sequence[str] = (), cells: int = KS_CELLS) -> DataFrame:
    """Two numbers that hold the two-sample KS distance of every feature between them, from counts by cell alone."""
    bounds = _ks_bounds(_in_cells(both, columns, group, cells), group)
    return bounds.groupBy(*group, "feature").agg(
        F.max("end").alias("ks_low"), F.max(F.greatest("end", "reach")).alias("ks_high"), F.max("na").alias("n0"), F.max("nb").alias("n1")
    )


def ks_scores(both: DataFrame, columns: Sequence[str], group: Sequence[str] = (), cells: int = KS_CELLS) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance of every feature, per cluster when `group` names one; exact.

    Sketches cut the values into cells, the cells are counted, and only values of cells that can hold a larger distance than
    the ends of all cells are moved and counted one by one, each cell by itself. These are few where the distance has a peak,
    and most where it is flat, as for two sets that are alike. The input is read three times; cut its lineage first when it is the result of a join.
    A distance is NULL where a set has no value. NaN counts as the largest value.
    """
    values = _in_cells(both, columns, group, cells)
    bounds = cut_lineage(_ks_bounds(values, group))  # a row per cluster, feature and cell
    keys = [*group, "feature", "cell"]
    open_ = bounds.where(F.col("reach") > F.col("low")).select(*keys, "a0", "b0", "na", "nb")
    inside = _null_safe(values, open_, keys, "inner", small=True).groupBy(*keys, "value").agg(
        count_when(F.col("__set") == 0).alias("a"), count_when(F.col("__set") == 1).alias("b"),
        *[F.any_value(c).alias(c) for c in ("a0", "b0", "na", "nb")],
    )
    upto = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ca, cb = F.col("a0") + F.sum("a").over(upto), F.col("b0") + F.sum("b").over(upto)
    found = inside.select(*group, "feature", F.abs(F.try_divide(ca.cast("double"), "na") - F.try_divide(cb.cast("double"), "nb")).alias("d"))
    best = found.groupBy(*group, "feature").agg(F.max("d").alias("d"))
    ends = bounds.groupBy(*group, "feature").agg(F.max("end").alias("end"), F.max("na").alias("n0"), F.max("nb").alias("n1"))
    return _null_safe(ends, best, [*group, "feature"], "left").select(*group, "feature", F.greatest("end", "d").alias("ks"), "n0", "n1")


def cluster_report(both: DataFrame, continuous: Sequence[str], categorical: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Drift of every variable in every cluster: t, KS distance or weighted difference of shares, and whether it drifted there.

    Whether a t is far out is judged among the variables of its own cluster.
    """
    keys = [*group, "feature"]
    t = flag_continuous(t_scores(both, continuous, group), group)
    ks = ks_scores(both, continuous, group).select(*keys, "ks")
    first = _null_safe(t, ks, keys, "left").select(*keys, F.lit("continuous").alias("kind"), "n0", "n1", "t", "ks", "drifted")
    second = flag_categorical(categorical_scores(both, categorical, group)).select(
        *keys, F.lit("categorical").alias("kind"), "weighted_difference", "drifted"
    )
    return first.unionByName(second, allowMissingColumns=True)


def excluded_variables(report: DataFrame, group: Sequence[str]) -> DataFrame:
    """The drifted variables of every cluster, by name; an empty list where none did. A list is bounded by the variables."""
    return report.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.when(F.col("drifted"), F.col("feature")))).alias("excluded"),
        count_when(F.col("drifted")).alias("n_excluded"), F.count(F.lit(1)).alias("n_variables"),
    )


def p_values(scores: DataFrame) -> list[dict]:
    """p-values of the t and KS scores: one row per feature, computed on the driver."""
    out = []
    for row in scores.collect():
        r = row.asDict()
        if "t" in r and r["t"] is not None:
            r["t_pvalue"] = stats.t_two_sided(r["t"], r["n0"] + r["n1"] - 2)
        if "ks" in r and r["ks"] is not None:
            r["ks_pvalue"] = stats.ks_two_sample(r["ks"], r["n0"], r["n1"])
        out.append(r)
    return out


def categorical_scores(both: DataFrame, columns: Sequence[str], group: Sequence[str] = (), one_sided: bool = False) -> DataFrame:
    """Sum of |p - q| * q over the categories of both sets; with `one_sided` also of categories of one set."""
    long = long_values(both, columns, [*group, "__set"], "string")
    counts = long.groupBy(*group, "feature", "value").agg(
        count_when(F.col("__set") == 0).alias("a"), count_when(F.col("__set") == 1).alias("b")
    )
    totals = counts.groupBy(*group, "feature").agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    shares = counts.join(totals, [*group, "feature"])
    p, q = ratio("a", "na"), ratio("b", "nb")
    seen = F.lit(True) if one_sided else (F.col("a") > 0) & (F.col("b") > 0)
    return shares.groupBy(*group, "feature").agg(
        F.coalesce(F.sum(F.when(seen, F.abs(p - q) * q)), F.lit(0.0)).alias("weighted_difference")
    )


def flag_continuous(scores: DataFrame, group: Sequence[str] = (), sigmas: float = DRIFT_SIGMAS) -> DataFrame:
    """Features whose t lies outside mean +- sigmas * std of all features' t; one row per feature."""
    whole = Window.partitionBy(*group)
    low = F.avg("t").over(whole) - sigmas * F.stddev_samp("t").over(whole)
    high = F.avg("t").over(whole) + sigmas * F.stddev_samp("t").over(whole)
    return scores.withColumn("drifted", (F.col("t") > high) | (F.col("t") < low))


def flag_categorical(scores: DataFrame, limit: float = DRIFT_CATEGORICAL) -> DataFrame:
    return scores.withColumn("drifted", F.col("weighted_difference") > limit)


def histogram(both: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts per equal-width bin of both sets; bin 0 and bins + 1 hold what lies outside."""
    v = F.col(column).cast("double")
    return both.where(v.isNotNull()).groupBy(
        F.width_bucket(v, F.lit(float(low)), F.lit(float(high)), F.lit(bins)).cast("long").alias("bin")
    ).agg(count_when(F.col("__set") == 0).alias("base"), count_when(F.col("__set") == 1).alias("current"))


def share_above(df: DataFrame, score: str, limit: float, site: str, day: Column) -> DataFrame:
    """Log row of a scoring run: rows above a score and rows in all, per site."""
    return df.groupBy(F.col(site).alias("site"), day.alias("day")).agg(
        count_when(F.col(score) > limit).alias("n_above"), F.count(F.lit(1)).alias("n_total")
    )
