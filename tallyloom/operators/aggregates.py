"""Aggregations that marketing reports use again and again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import as_column, ratio


def greatest_label(counts: Sequence[str]) -> Column:
    """Name of the largest of several columns; the first listed wins ties."""
    top = F.greatest(*counts)
    out = F.when(F.col(counts[0]) == top, counts[0])
    for name in counts[1:]:
        out = out.when(F.col(name) == top, name)
    return out


def window_grid(
    measures: Mapping[str, tuple[str, Column]], windows: Mapping[str, Column | None]
) -> list[Column]:
    """The same measures over several time windows, as one list of aggregates.

    `measures`: name -> (sum | min | max | avg | distinct, value); `windows`: suffix ->
    condition (None for all rows). One pass computes the whole grid.
    """
    functions = {"sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg, "distinct": F.count_distinct}
    out = []
    for suffix, condition in windows.items():
        for name, (kind, value) in measures.items():
            kept = value if condition is None else F.when(condition, value)
            out.append(functions[kind](kept).alias(name + suffix))
    return out


def newest_array(
    df: DataFrame, key: Sequence[str], order: Sequence[Column], fields: Sequence[str], n: int, out: str
) -> DataFrame:
    """Newest n rows per key as an array of structs, oldest first.

    `order` is newest first and total. The rank filter is applied before the shuffle as
    well, so a key with many rows sends at most n rows per task.
    """
    place = Window.partitionBy(*key).orderBy(*order)
    newest = df.withColumn("__rn", F.row_number().over(place)).where(F.col("__rn") <= n)
    rows = F.array_sort(F.collect_list(F.struct((-F.col("__rn")).alias("__place"), *fields)))
    return newest.groupBy(*key).agg(rows.alias(out)).withColumn(
        out, F.transform(out, lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    )


def frequency_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts and shares of each combination of values."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", ratio("n", counts.agg(F.sum("n")).scalar()))


def crosstab_share(df: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Two-way table with the share of each row value inside a column value."""
    counts = df.groupBy(rows).pivot(columns, list(values)).agg(F.count(F.lit(1)))
    totals = counts.agg(F.struct(*[F.sum(v).alias(v) for v in values])).scalar()
    return counts.select(
        rows, *[F.coalesce(ratio(v, totals.getField(v)), F.lit(0.0)).alias(v) for v in values]
    )


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Confusion counts and their share inside each actual class."""
    cells = df.groupBy(actual, predicted).agg(F.count(F.lit(1)).alias("n"))
    return cells.withColumn("share", ratio("n", F.sum("n").over(Window.partitionBy(actual))))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of all column pairs, long form, from one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}") for a, b in pairs])
    cells = []
    for a, b in pairs:
        value = F.col(f"`{a}|{b}`")
        cells.append(F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), value.alias("corr")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("left"), F.lit(a).alias("right"), value.alias("corr")))
    return wide.select(F.inline(F.array(*cells)))


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of NULLs per column, only columns that have any; one pass."""
    columns = list(columns or df.columns)
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("null_share")) for c in columns])
    return shares.select(F.inline(cells)).where(F.col("null_share") > 0)


def category_share(
    df: DataFrame, key: str, category: str, values: Sequence[str] | None = None, prefix: str = "c_"
) -> DataFrame:
    """Share of each category in the rows of a key, one column per category; NULLs are left out.

    The categories become columns, so there must be few: they are read with a limit, and
    more than `spark.sql.pivotMaxValues` of them is an error.
    """
    known = df.where(F.col(category).isNotNull())
    if values is None:
        most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues", "10000"))
        found = known.select(F.col(category).cast("string").alias("v")).distinct().orderBy("v").limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"{category} has more than {most} values")
        values = [r["v"] for r in found]
    total = F.count(F.lit(1))
    return known.groupBy(key).agg(
        *[
            ratio(F.count(F.when(F.col(category).cast("string") == v, 1)), total).alias(prefix + v)
            for v in values
        ]
    )


def most_frequent(df: DataFrame, key: Sequence[str], value: Sequence[str], out: str = "n") -> DataFrame:
    """Most frequent value per key; ties go to the smallest value. All aggregates combine map-side."""
    counts = df.groupBy(*key, *value).agg(F.count(F.lit(1)).alias(out))
    best = F.min_by(F.struct(*value, out), F.struct((-F.col(out)).alias("o"), *value))
    return counts.groupBy(*key).agg(best.alias("__best")).select(*key, "__best.*")


def first_row(df: DataFrame, key: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Best row per key (row_number() = 1), as one aggregate that combines map-side."""
    rest = [c for c in df.columns if c not in key]
    place = F.struct(*[as_column(o).alias(f"o{i}") for i, o in enumerate(order)])
    return df.groupBy(*key).agg(F.min_by(F.struct(*rest), place).alias("__row")).select(*key, "__row.*").select(*df.columns)
