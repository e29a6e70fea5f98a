"""Feature blocks from a purchase history (date, customer, sales): calendar bins and past value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import dates
from tallyloom.functions.columns import count_when, sum_when
from tallyloom.operators.segments import SHARES_4, quantile_segments
from tallyloom.session import cut_lineage

# Yearly sale events as (month, day).
SALE_EVENTS = [(5, 28), (7, 16), (12, 20)]


def purchase_days(purchases: DataFrame) -> DataFrame:
    """One row per customer and day with the sum of sales; all blocks below start from it."""
    return purchases.groupBy("customer_id", "day").agg(F.sum("sales").alias("sales"))


def month_bins(days: DataFrame, today: Column, months: int = 4) -> DataFrame:
    """Purchase days, sales and recency in weeks (-1 when none) of each of the last months.

    The recency counts from the newest purchase of anyone in that month.
    """
    day = F.col("day")
    columns = []
    newest = {}
    for i in range(months):
        here = (day < F.add_months(today, -i)) & (day >= F.add_months(today, -i - 1))
        newest[i] = F.max(F.when(here, day))
        columns += [
            count_when(here).alias(f"size_{i}"), sum_when(here, "sales").alias(f"sales_{i}"),
            F.max(F.when(here, day)).alias(f"last_{i}"),
        ]
    ends = days.agg(F.struct(*[newest[i].alias(f"m{i}") for i in range(months)])).scalar()
    rows = days.groupBy("customer_id").agg(*columns)
    return rows.select(
        "customer_id",
        *[c for i in range(months) for c in (f"size_{i}", f"sales_{i}")],
        *[
            F.coalesce(F.datediff(ends.getField(f"m{i}"), f"last_{i}") / 7, F.lit(-1.0)).alias(f"recency_{i}")
            for i in range(months)
        ],
    )


def week_bins(days: DataFrame, today: Column, weeks: int = 12) -> DataFrame:
    """Purchase days in each trailing week; both ends count, so a border day is in two weeks."""
    day = F.col("day")
    return days.groupBy("customer_id").agg(
        *[
            count_when(day.between(F.date_sub(today, 7 * (i + 1)), F.date_sub(today, 7 * i))).alias(f"size_{i}_weekly")
            for i in range(weeks)
        ]
    )


def year_ago(days: DataFrame, today: Column) -> DataFrame:
    """Purchase days in the three months that start twelve months back."""
    day = F.col("day")
    rows = days.where((day < F.add_months(today, -9)) & (day >= F.add_months(today, -12)))
    return rows.groupBy("customer_id").agg(F.count(F.lit(1)).alias("size_lag_12"))


def near_sale_event(days: DataFrame, today: Column, events: Sequence[tuple[int, int]] = SALE_EVENTS, around: int = 5) -> DataFrame:
    """Purchase days around the nearest past sale event."""
    event = dates.nearest_date([dates.last_yearly(today, m, d) for m, d in events], today)
    day = F.col("day")
    rows = days.where((day < F.date_add(event, around)) & (day >= F.date_sub(event, around)))
    return rows.groupBy("customer_id").agg(F.count(F.lit(1)).alias("size_last_event"))


def active_cohort(days: DataFrame, today: Column, months: int = 3) -> DataFrame:
    """Customers with a purchase in the last months."""
    day = F.col("day")
    return days.where((day > F.add_months(today, -months)) & (day <= today)).select("customer_id").distinct()


def _value(days: DataFrame, start: Column, end: Column) -> DataFrame:
    """Sales, purchase weeks and their product over (start, end]."""
    rows = days.where((F.col("day") > start) & (F.col("day") <= end))
    weeks = rows.groupBy("customer_id", dates.week_start_monday("day").alias("week")).agg(F.sum("sales").alias("sales"))
    return weeks.groupBy("customer_id").agg(
        F.sum("sales").alias("sales"), F.count(F.lit(1)).alias("weeks")
    ).withColumn("value", F.col("sales").cast("double") * F.col("weeks"))


def past_segment(days: DataFrame, today: Column, months: int = 6) -> DataFrame:
    """Past value in four segments, 3 for the best and 0 for the rest."""
    value = cut_lineage(_value(days, F.add_months(today, -months), today))
    parts = quantile_segments(value, SHARES_4, "value", "customer_id", out="__q")
    return parts.select("customer_id", "value", (4 - F.substring("__q", 2, 1).cast("int")).alias("past_segment"))


def engage_target(population: DataFrame, days: DataFrame, today: Column, months: int = 3) -> DataFrame:
    """Future sales, purchase weeks and their product, in four segments over the whole population."""
    value = _value(days, today, F.add_months(today, months))
    rows = population.join(value, "customer_id", "left").select(
        "customer_id", F.coalesce(F.col("sales").cast("double"), F.lit(0.0)).alias("money_eval"),
        F.coalesce("weeks", F.lit(0)).alias("frequency_eval"), F.coalesce("value", F.lit(0.0)).alias("engage_value"),
    )
    return quantile_segments(cut_lineage(rows), SHARES_4, "engage_value", "customer_id", out="true_segment")


def sum_counters(rows: DataFrame, key: str) -> DataFrame:
    """Sum of every other column per key."""
    return rows.groupBy(key).agg(*[F.sum(c).alias(c) for c in rows.columns if c != key])


def visit_categories(visits: DataFrame, today: Column, key: str, pattern: str, first: str, last: str, suffix: str = "") -> DataFrame:
    """Days since the first and last visit, and the sum of all category columns found by name."""
    categories = [c for c in visits.columns if pattern in c]
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in categories), F.lit(0))
    return visits.select(
        key, *[F.col(c).alias(c + suffix) for c in categories], total.alias("category_total" + suffix),
        F.coalesce(F.datediff(today, last), F.lit(-1)).alias("recency_days" + suffix),
        F.coalesce(F.datediff(today, first), F.lit(-1)).alias("first_days" + suffix),
    )


def join_filled(population: DataFrame, block: DataFrame, key: str, fill: dict[str, float] | None = None) -> DataFrame:
    """Left join a block; missing numbers become 0, or the given fill."""
    fill = dict(fill or {})
    numeric = [c for c, kind in block.dtypes if c != key and c not in fill and kind != "string"]
    return population.join(block, key, "left").na.fill({**dict.fromkeys(numeric, 0), **fill})


def location_onehot(rows: DataFrame, key: str, state: str, n: int, base: str | None, missing: str) -> DataFrame:
    """Most frequent states as 0/1 columns; states not seen in `rows` are 0 columns, the base state is dropped."""
    top = rows.groupBy(state).count().orderBy(F.desc("count"), state).limit(n).collect()
    names = [r[state] for r in top if r[state] is not None and r[state] != base]
    value = F.coalesce(F.col(state), F.lit(missing))
    return rows.select(key, *[(value == name).cast("int").alias(name) for name in names])
