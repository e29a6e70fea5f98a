"""Exact global ranks, running totals and buckets without a single-partition window.

A window without PARTITION BY sends every row to one task, and a window over a few
large groups sends a third of the rows to one task. Here the order key is cut at
approximate quantiles into buckets of equal weight. Rows are ranked inside their
bucket, bucket totals (a few numbers per bucket) are added up in order, and each row
gets the total of the buckets before its own. The result is exact, whatever the cuts.

Values that fill more than one bucket by themselves are cut again by the tie-break
column, so one hot score does not end up in one task either.

The input is read three times (cuts, bucket totals, ranks). When it is a small result of
much work, such as one row per customer out of all orders, cut its lineage first with
`session.cut_lineage`; a plain scan is better read again, with pruned columns.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import as_column

_KEY, _TIE, _BUCKET, _SUB = "__key", "__tie", "__bucket", "__sub"


def bucket_count(df: DataFrame) -> int:
    """Buckets per ranking: the session's shuffle parallelism, within what a sketch can cut."""
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(2, min(wanted, 5000))


def _with_bucket(df: DataFrame, source: str, cuts: Sequence[float], target: str) -> DataFrame:
    splits = [-math.inf, *(cuts or [0.0]), math.inf]  # an empty input has no cuts
    return Bucketizer(splits=splits, inputCol=source, outputCol=target, handleInvalid="keep").transform(df)


def _quantile_cuts(df: DataFrame, column: str, n: int) -> list[float]:
    """Approximate quantiles of one column; the driver receives n numbers."""
    shares = [i / n for i in range(1, n)]
    row = df.agg(F.percentile_approx(column, shares, max(10000, 20 * n)).alias("cuts")).first()
    return list(row["cuts"] or [])


def running_totals(
    df: DataFrame,
    order: Column | str,
    tie: Column | str,
    totals: Mapping[str, Column] | None = None,
    group: Sequence[str] = (),
    descending: bool = False,
    cuts: Sequence[float] | None = None,
    rank: str = "rank",
    group_totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Number the rows of each group by (order, tie) and carry running sums.

    `order` and `tie` are numeric (dates: pass a day number); `tie` makes the order
    total. NULL order keys come last. `totals` maps a new column to the expression that
    is summed from the first row to this one. `group_totals` maps a new column to
    ``"count"`` or to a key of `totals`, for the total of the whole group. `cuts` are
    known quantiles of the order key (hash keys are uniform), which saves a pass.
    """
    totals = dict(totals or {})
    group = list(group)
    key = as_column(order).cast("double")
    key = F.coalesce(-key if descending else key, F.lit(math.inf))
    work = df.withColumns({_KEY: key, _TIE: as_column(tie)})
    n = bucket_count(df)
    hot: list[float] = []
    if cuts is None:
        found = _quantile_cuts(work.select(_KEY), _KEY, n)
        hot = sorted({a for a, b in zip(found, found[1:], strict=False) if a == b})
        edges = set(found)
        for value in hot:
            edges.add(math.nextafter(value, math.inf))
        cuts = sorted(e for e in edges if math.isfinite(e))
    work = _with_bucket(work, _KEY, sorted(set(cuts)), _BUCKET)
    if hot:
        numbers = work.withColumn(_TIE + "_d", F.col(_TIE).cast("double"))
        tie_cuts = sorted(set(_quantile_cuts(numbers.where(F.col(_KEY).isin(hot)), _TIE + "_d", n)))
        work = _with_bucket(numbers, _TIE + "_d", tie_cuts, _SUB + "_t").withColumn(
            _SUB, F.when(F.col(_KEY).isin(hot), F.col(_SUB + "_t")).otherwise(F.lit(0.0))
        ).drop(_TIE + "_d", _SUB + "_t")
    else:
        work = work.withColumn(_SUB, F.lit(0.0))

    place = [*group, _BUCKET, _SUB]
    inside = Window.partitionBy(*place).orderBy(_KEY, _TIE)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = work.withColumns(
        {f"__n_{rank}": F.row_number().over(inside), **{f"__t_{c}": F.sum(e).over(upto) for c, e in totals.items()}}
    )
    parts = work.groupBy(*place).agg(
        F.count(F.lit(1)).alias("__n"), *[F.sum(e).alias(f"__s_{c}") for c, e in totals.items()]
    )
    # One row per group and bucket: small, so this window may hold a group in one task.
    before = Window.partitionBy(*group).orderBy(_BUCKET, _SUB).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    offsets = parts.select(
        *place,
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__n_before"),
        *[F.coalesce(F.sum(f"__s_{c}").over(before), F.lit(0)).alias(f"__s_{c}_before") for c in totals],
        *[
            (F.sum("__n") if source == "count" else F.sum(f"__s_{source}")).over(whole).alias(name)
            for name, source in (group_totals or {}).items()
        ],
    )
    joined = local.join(offsets, place)
    return joined.select(
        *df.columns,
        (F.col(f"__n_{rank}") + F.col("__n_before")).alias(rank),
        *[(F.coalesce(F.col(f"__t_{c}"), F.lit(0)) + F.col(f"__s_{c}_before")).alias(c) for c in totals],
        *(group_totals or {}),
    )


def global_rank(
    df: DataFrame,
    order: Column | str,
    tie: Column | str,
    group: Sequence[str] = (),
    descending: bool = False,
    rank: str = "rank",
    size: str | None = None,
    cuts: Sequence[float] | None = None,
) -> DataFrame:
    """row_number() over (partition by group order by order, tie), for groups of any size."""
    return running_totals(
        df, order, tie, group=group, descending=descending, rank=rank, cuts=cuts,
        group_totals={size: "count"} if size else None,
    )


def tile(rank: Column | str, size: Column | str, n: int) -> Column:
    """Number of the equal-count bucket of a rank, as ntile(n) gives it."""
    rank, size = as_column(rank), as_column(size)
    width = F.floor(size / n)
    longer = size % n
    border = longer * (width + 1)
    in_long = F.floor((rank - 1) / (width + 1)) + 1
    in_short = longer + F.floor((rank - border - 1) / F.greatest(width, F.lit(1))) + 1
    return F.when(rank <= border, in_long).otherwise(in_short).cast("int")


def ntile(
    df: DataFrame, n: int, order: Column | str, tie: Column | str, group: Sequence[str] = (),
    descending: bool = False, out: str = "bucket",
) -> DataFrame:
    """Equal-count buckets by (order, tie)."""
    ranked = global_rank(df, order, tie, group, descending, rank="__rank", size="__size")
    return ranked.withColumn(out, tile("__rank", "__size", n)).drop("__rank", "__size")


def percent_rank_average(df: DataFrame, value: str, out: str = "pct_rank") -> DataFrame:
    """Percentile rank with ties averaged; NULLs share the last place.

    Equal values are counted first, so a hot value is one row of the ranking.
    """
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("__size"))
    placed = running_totals(
        counts, F.col(value), F.lit(0), totals={"__last": F.col("__size")}, group_totals={"__total": "__last"},
        rank="__place",
    )
    average = (F.col("__last") - (F.col("__size") - 1) / 2) / F.col("__total")
    ranks = placed.select(F.col(value).alias("__value"), average.alias(out))
    return df.join(ranks, df[value].eqNullSafe(ranks["__value"]), "left").drop("__value")


def value_cells(df: DataFrame, cuts: Mapping[str, Sequence[float]], keep: Sequence[str] = ()) -> DataFrame:
    """(feature, value, cell) of all values; a column's cell is the number of its cuts at or below the value."""
    df = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cuts])
    for c, edges in cuts.items():
        df = _with_bucket(df, c, edges, f"__cell_{c}")
    cells = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("value"), F.col(f"__cell_{c}").cast("int").alias("cell")) for c in cuts]
    return df.select(*keep, F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], fine: int = 1000, held: int = 50_000) -> DataFrame:
    """Interpolated quantiles of several columns: one row per column, an array with one value per share (null without values).

    Histograms narrow each quantile down: a sketch cuts the values into about `fine` cells, the cells are counted exactly, and
    the cells that hold a wanted rank are cut again, until each has at most `held` values or one value only. Only the values of
    those cells move; everything else is counts by cell, added up inside the tasks. The driver sees cuts and counts.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    grid = [i / fine for i in range(1, fine)]

    def sketched(ranges: Mapping[str, Sequence[tuple[float, float]]]) -> dict[str, list[float]]:
        """Borders of the ranges and cuts inside them; a value that fills several cells gets one of its own."""
        within = [F.percentile_approx(F.when((F.col(c) >= lo) & (F.col(c) < hi) if hi < math.inf else F.col(c) >= lo, F.col(c)), grid, 10 * fine).alias(f"{c}:{i}") for c, r in ranges.items() for i, (lo, hi) in enumerate(r)]
        row, out = values.agg(*within).first(), {}
        for c, r in ranges.items():
            edges: set[float] = set()
            for i, (lo, hi) in enumerate(r):
                found = row[f"{c}:{i}"] or []
                if math.inf in found:
                    edges.add(sys.float_info.max)
                edges |= {lo, hi, *found} | {math.nextafter(x, math.inf) for x, y in zip(found, found[1:], strict=False) if x == y}
            out[c] = sorted(e for e in edges if math.isfinite(e))
        return out

    cuts = sketched({c: [(-math.inf, math.inf)] for c in columns})
    done: dict[str, dict[int, tuple[int, int]]] = {}
    totals: dict[str, int] = {}
    known: dict[str, dict[int, float]] = {c: {} for c in columns}
    ranks: dict[str, set[int]] = {}
    tried: set[tuple[str, float, float]] = set()
    while cuts:
        counts: dict[str, dict[int, int]] = {c: {} for c in cuts}
        for r in value_cells(values, cuts).groupBy("feature", "cell").agg(F.count(F.lit(1)).alias("n")).collect():
            counts[r["feature"]][r["cell"]] = r["n"]
        again: dict[str, list[tuple[float, float]]] = {}
        for c, found in counts.items():
            totals.setdefault(c, sum(found.values()))
            if c not in ranks:
                ranks[c] = {f(q * (totals[c] - 1)) for q in shares for f in (math.floor, math.ceil)} if totals[c] else set()
            edges, upto, open_ = [-math.inf, *(cuts[c] or [0.0]), math.inf], 0, []
            done[c] = {}
            for cell in sorted(found):
                lo, hi = (edges[cell], edges[cell + 1]) if cell + 1 < len(edges) else (math.nan, math.nan)
                for rank in ranks[c]:
                    if upto <= rank < upto + found[cell]:
                        if hi <= math.nextafter(lo, math.inf) or math.isnan(lo):
                            known[c][rank] = hi if lo == sys.float_info.max else lo  # nothing but infinity is above the largest number
                        else:
                            done[c][rank] = (cell, rank - upto)
                            if found[cell] > held and (lo, hi) not in open_ and (c, lo, hi) not in tried:
                                open_.append((lo, hi))
                                tried.add((c, lo, hi))  # a cell that cannot be cut further is taken as it is
                upto += found[cell]
            if open_:
                again[c] = open_
        left = {c: {r: at for r, at in places.items() if r not in known[c]} for c, places in done.items() if c in counts and c not in again}
        left = {c: places for c, places in left.items() if places}
        if left:
            wanted = df.sparkSession.createDataFrame([(c, cell, nth, rank) for c, places in left.items() for rank, (cell, nth) in places.items()], "feature string, cell int, nth long, rank long")
            cells = wanted.select("feature", "cell").distinct()
            # at most `held` values in each of at most 2 x shares cells of a column
            inside = value_cells(values, {c: cuts[c] for c in left}).join(F.broadcast(cells), ["feature", "cell"]).groupBy("feature", "cell").agg(F.sort_array(F.collect_list("value")).alias("values"))
            for r in inside.join(wanted, ["feature", "cell"]).select("feature", "rank", F.element_at("values", (F.col("nth") + 1).cast("int")).alias("value")).collect():
                known[r["feature"]][r["rank"]] = r["value"]
        cuts = sketched(again) if again else {}

    def at(c: str, q: float) -> float | None:
        if not totals[c]:
            return None
        h = q * (totals[c] - 1)
        low, high = known[c][math.floor(h)], known[c][math.ceil(h)]
        return low if low == high else low + (high - low) * (h - math.floor(h))

    return df.sparkSession.createDataFrame([(c, [at(c, q) for q in shares]) for c in columns], "feature string, quantiles array<double>")


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """Best n rows; plans a bounded heap per task, not a full sort."""
    return df.orderBy(*order).limit(n)


def label_top_n(
    df: DataFrame, n: int, order: Column | str, tie: Column | str, yes: str = "selected", no: str = "rest",
    out: str = "label",
) -> DataFrame:
    """Label the n best rows by score, keeping all rows."""
    ranked = global_rank(df, order, tie, descending=True, rank="__rank")
    return ranked.withColumn(out, F.when(F.col("__rank") <= n, yes).otherwise(no)).drop("__rank")
