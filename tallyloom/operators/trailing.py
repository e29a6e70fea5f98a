"""Measures over a date window relative to each anchor row, without a range join.

A range join emits one row for every pair of anchor and fact of a key. Here facts are
reduced to one row per key and day, anchors are added as rows of their day, and each
measure is a RANGE frame over the days of the key. Rows per key are bounded by the
calendar, whatever the number of facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import day_number


@dataclass(frozen=True)
class Trailing:
    """Measure over days [anchor + start, anchor + end].

    `kind`: count (days with facts), sum, min, max (of `column`), first or last (day with facts),
    collect (array of `column` by day).
    """

    kind: str
    start: int
    end: int
    column: str | None = None


def attach_trailing(
    anchors: DataFrame, daily: DataFrame, key: str | Sequence[str], anchor_day: str, fact_day: str, measures: Mapping[str, Trailing]
) -> DataFrame:
    """Add the measures to (key, anchor day) rows; a key is one column or several. Both frames have one row per key and day.

    Counts are differences of running counts, which are exact. Sums slide over their own days only, so that a value outside
    a window neither costs digits nor, as a NaN, spreads into it.
    """
    keys = [key] if isinstance(key, str) else list(key)
    values = sorted({m.column for m in measures.values() if m.column})
    facts = daily.select(*keys, F.col(fact_day).alias("__day"), F.lit(1).alias("__fact"), *values)
    rest = [c for c in anchors.columns if c not in keys]
    rows = anchors.select(*keys, F.col(anchor_day).alias("__day"), F.struct(*rest).alias("__anchor"))
    both = facts.unionByName(rows, allowMissingColumns=True).withColumn("__n", day_number("__day"))
    ahead = Window.partitionBy(*keys).orderBy("__n")
    back = Window.partitionBy(*keys).orderBy(F.desc("__n"))
    day = F.when(F.col("__fact") == 1, F.col("__day"))
    anchor = F.col("__day")

    def until(value: Column, end: int) -> Column:
        return F.sum(value).over(ahead.rangeBetween(Window.unboundedPreceding, end))

    def between(value: Column, m: Trailing) -> Column:
        """Count over the window as a difference of two running counts, which need no second look at a row."""
        return F.coalesce(until(value, m.end), F.lit(0)) - F.coalesce(until(value, m.start - 1), F.lit(0))

    def measure(m: Trailing) -> Column:
        frame = ahead.rangeBetween(m.start, m.end)
        if m.kind == "count":
            return between(F.col("__fact").cast("long"), m)
        if m.kind == "sum":
            return F.sum(m.column).over(frame)
        if m.kind == "last":
            last = F.max(day).over(ahead.rangeBetween(Window.unboundedPreceding, m.end))
            return F.when(last >= F.date_add(anchor, m.start), last)
        if m.kind == "first":
            # Descending order turns "from here on" into a running frame.
            first = F.min(day).over(back.rangeBetween(Window.unboundedPreceding, -m.start))
            return F.when(first <= F.date_add(anchor, m.end), first)
        function = {"min": F.min, "max": F.max, "collect": F.collect_list}[m.kind]
        return function(F.col(m.column)).over(frame)

    out = {name: measure(m) for name, m in measures.items()}
    return both.withColumns(out).where(F.col("__anchor").isNotNull()).select(*keys, "__anchor.*", *measures)
