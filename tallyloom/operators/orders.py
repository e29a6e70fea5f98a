"""Feature blocks from orders: population, daily grain, frequency, prices, intervals, target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.config import AMOUNT_LIMIT, ASP_CAP, DEFAULT_PERIOD, MAX_CLOSE_DELAY_DAYS, Period
from tallyloom.functions import dates
from tallyloom.functions.columns import date_lit, ratio, sum_when
from tallyloom.operators.sampling import bernoulli


def valid_orders(
    lines: DataFrame, period: Period = DEFAULT_PERIOD, site: str = "O", limit: int = AMOUNT_LIMIT,
    delay: int = MAX_CLOSE_DELAY_DAYS,
) -> DataFrame:
    """Paid, one site, below the amount limit, closed in the period and soon after creation.

    The earliest creation date follows from the other two rules; stated, it can filter the
    order headers before they are joined.
    """
    return lines.where(
        (F.col("status") == "paid")
        & (F.col("site") == site)
        & (F.col("amount") < limit)
        & F.col("closed").between(date_lit(period.start), date_lit(period.end))
        & (F.col("created") >= F.date_sub("closed", delay))
        & (F.col("created") >= F.date_sub(date_lit(period.start), delay))
        & ~F.col("auto_offer")
        & ~F.col("bonus")
    )


def closed_in_time(orders: DataFrame, delay: int = MAX_CLOSE_DELAY_DAYS) -> DataFrame:
    """The other form of the rule: paid and closed in [created, created + delay]."""
    return orders.where(
        (F.col("status") == "paid") & F.col("closed").between(F.col("created"), F.date_add("created", delay))
    )


def population(valid: DataFrame, sample: int | None = None, seed: str = "s") -> DataFrame:
    """Distinct buyers, or a repeatable sample of about `sample` of them."""
    buyers = valid.select(F.col("buyer_id").alias("customer_id")).distinct()
    return buyers if sample is None else bernoulli(buyers, "customer_id", sample, seed)


def recent_population(lines: DataFrame, today: str, days: int = 3) -> DataFrame:
    """Buyers of paid orders of the last days."""
    last = date_lit(today)
    return lines.where(
        (F.col("status") == "paid") & F.col("created").between(F.date_sub(last, days), last)
    ).select(F.col("buyer_id").alias("customer_id")).distinct()


def of_population(df: DataFrame, population: DataFrame, key: str = "buyer_id") -> DataFrame:
    """Keep the rows of the population's customers."""
    return df.join(population.select(F.col("customer_id").alias(key)), key, "left_semi")


def daily_orders(valid: DataFrame) -> DataFrame:
    """One row per customer and day: sales, items, distinct orders (a pack counts as one order).

    Two steps, so that the distinct count does not expand the rows: first per pack, then
    per day.
    """
    packs = valid.groupBy(
        F.col("buyer_id").alias("customer_id"), F.col("created").alias("day"),
        F.coalesce("pack_id", "order_id").alias("__pack"),
    ).agg(F.sum("amount").alias("sales"), F.sum("items").alias("items"))
    return packs.groupBy("customer_id", "day").agg(
        F.sum("sales").alias("sales"), F.sum("items").alias("items"), F.count(F.lit(1)).alias("orders")
    )


def capped_day_price(cap: int = ASP_CAP) -> Column:
    """Mean day sales, where a day above `cap` per item counts as cap times its items."""
    return F.avg(F.when(ratio("sales", "items") > cap, cap * F.col("items").cast("double")).otherwise(F.col("sales").cast("double")))


def capped_price(daily: DataFrame, cap: int = ASP_CAP) -> DataFrame:
    return daily.groupBy("customer_id").agg(capped_day_price(cap).alias("asp_capped"))


def _bins(today: Column) -> list[Column]:
    """Trailing 30-day bins; both ends are included, so day 30 and day 60 are in two bins."""
    day = F.col("day")
    return [day.between(F.date_sub(today, 30 * (i + 1)), F.date_sub(today, 30 * i)) for i in range(3)]


def order_frequency_measures(today: Column) -> list[Column]:
    """37 measures of the daily grain relative to a date.

    The daily grain has one row per day, so distinct days are counts of rows, and the
    sub-windows are conditions instead of joins of the table with itself.
    """
    day, sales, items, orders = (F.col(c) for c in ("day", "sales", "items", "orders"))
    last90 = day >= F.date_sub(today, 90)

    def short(value: Column) -> Column:
        return F.when(last90, value)

    def zero(value: Column) -> Column:
        return F.coalesce(value.cast("double"), F.lit(0.0))

    money = sales.cast("double")
    per_order = ratio(items, orders)
    age = F.datediff(today, day)
    bins = _bins(today)
    std = F.stddev_samp(money)
    return [
        ratio(F.sum(sales), F.sum(items)).alias("asp_long"),
        zero(ratio(F.sum(short(sales)), F.sum(short(items)))).alias("asp_short"),
        F.avg(per_order).alias("products_long"),
        zero(F.avg(short(per_order))).alias("products_short"),
        F.sum(orders).alias("orders_sum_long"),
        F.avg(orders).alias("orders_mean_long"),
        F.coalesce(F.sum(short(orders)), F.lit(0)).alias("orders_sum_short"),
        zero(F.avg(short(orders))).alias("orders_mean_short"),
        F.count(day).alias("freq_d_long"),
        F.count(short(day)).alias("freq_d_short"),
        F.size(F.collect_set(dates.month_start(day))).alias("freq_m_long"),
        F.size(F.collect_set(short(dates.month_start(day)))).alias("freq_m_short"),
        F.size(F.collect_set(dates.week_start_sunday(day))).alias("freq_w_long"),
        F.size(F.collect_set(short(dates.week_start_sunday(day)))).alias("freq_w_short"),
        F.count(F.when(day >= F.date_sub(today, 6), 1)).alias("freq_7d"),
        F.count(F.when(day >= F.date_sub(today, 180), 1)).alias("freq_180d"),
        F.max(age).alias("first_in_window"),
        F.min(age).alias("recency"),
        F.sum(items).alias("items_sum_long"),
        F.avg(items).alias("items_mean_long"),
        F.coalesce(F.sum(short(items)), F.lit(0)).alias("items_sum_short"),
        zero(F.avg(short(items))).alias("items_mean_short"),
        F.avg(F.when(dates.is_weekend(day), 1).otherwise(0)).alias("weekend_share"),
        (F.sum(sales).cast("double") / F.count(sales)).alias("money_mean"),
        F.max(sales).alias("money_max"),
        F.min(sales).alias("money_min"),
        F.when(std == 0, 0.0).otherwise(F.avg(money) / std).alias("money_mean_over_std"),
        F.sum(sales).alias("money_sum"),
        *[F.count(F.when(b, 1)).alias(f"size_{i}") for i, b in enumerate(bins)],
        *[sum_when(b, money).alias(f"sales_{i}") for i, b in enumerate(bins)],
        *[F.min(F.when(b, age)).alias(f"recency_{i}") for i, b in enumerate(bins)],
    ]


def orders_frequency(daily: DataFrame, today: Column, keys: Sequence[str] = ("customer_id",)) -> DataFrame:
    return daily.groupBy(*keys).agg(*order_frequency_measures(today))


def interval_measures(suffix: str, gap: Column) -> list[Column]:
    logs = F.log10(gap)
    enough = F.count(gap) > 1
    mean, std = F.avg(logs), F.stddev_samp(logs)
    return [
        F.when(enough, F.sum(logs)).alias(f"ipt_sum_{suffix}"),
        F.when(enough, mean).alias(f"ipt_mean_{suffix}"),
        F.when(enough, std).alias(f"ipt_std_{suffix}"),
        F.when(enough, F.min(logs)).alias(f"ipt_min_{suffix}"),
        F.when(enough, F.max(logs)).alias(f"ipt_max_{suffix}"),
        F.when(enough, ratio(std, mean)).alias(f"ipt_cv_{suffix}"),
    ]


def interpurchase(purchase_days: DataFrame, population: DataFrame, today: Column, short_days: int = 60) -> DataFrame:
    """Log10 of the days between purchases: sum, mean, std, min, max, std/mean; at least two intervals.

    `purchase_days` has one row per (customer_id, day). A short interval lies between two
    purchases of the last `short_days` days.
    """
    return population.join(intervals(purchase_days, today, short_days, ["customer_id"]), "customer_id", "left")


def intervals(purchase_days: DataFrame, today: Column, short_days: int, keys: Sequence[str]) -> DataFrame:
    """Measures of the intervals between the days of each key."""
    previous = F.lag("day").over(Window.partitionBy(*keys).orderBy("day"))
    days = purchase_days.withColumn("__previous", previous)
    gap = F.datediff("day", "__previous")
    in_short = F.col("__previous") >= F.date_sub(today, short_days)
    return days.groupBy(*keys).agg(*interval_measures("long", gap), *interval_measures("short", F.when(in_short, gap)))


def target(valid: DataFrame) -> DataFrame:
    """Purchase days and amount of the future window."""
    days = valid.groupBy(F.col("buyer_id").alias("customer_id"), "created").agg(F.sum("amount").alias("amount"))
    return days.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("freq_target"), F.sum("amount").alias("amount_target")
    )


def as_seller(valid: DataFrame, population: DataFrame, today: Column) -> DataFrame:
    """Sales as a seller, days since the last and the first sale."""
    rows = of_population(valid, population, "seller_id")
    return rows.groupBy(F.col("seller_id").alias("customer_id")).agg(
        F.sum("amount").alias("seller_sales"),
        F.min(F.datediff(today, "created")).alias("seller_recency"),
        F.max(F.datediff(today, "created")).alias("seller_first"),
    )


def daily_orders_at(valid: DataFrame, ref_dates: Sequence, lookback: int) -> DataFrame:
    """Daily grain for several reference dates at once: lines closed in [ref - lookback, ref].

    Lines are first reduced to packs, then each pack is listed under the dates it belongs
    to, so the number of scans and joins does not grow with the number of dates.
    """
    packs = valid.groupBy(
        F.col("buyer_id").alias("customer_id"), F.col("created").alias("day"), "closed",
        F.coalesce("pack_id", "order_id").alias("__pack"),
    ).agg(F.sum("amount").alias("sales"), F.sum("items").alias("items"))
    refs = F.array(*[date_lit(d) for d in ref_dates])
    at = packs.withColumn(
        "ref_date", F.explode(F.filter(refs, lambda d: F.col("closed").between(F.date_sub(d, lookback), d)))
    )
    per_pack = at.groupBy("customer_id", "ref_date", "day", "__pack").agg(
        F.sum("sales").alias("sales"), F.sum("items").alias("items")
    )
    return per_pack.groupBy("customer_id", "ref_date", "day").agg(
        F.sum("sales").alias("sales"), F.sum("items").alias("items"), F.count(F.lit(1)).alias("orders")
    )


def panel(valid: DataFrame, ref_dates: Sequence, lookback: int = 365) -> DataFrame:
    """Population and order features at several dates as one plan: one row per (customer, date)."""
    daily = daily_orders_at(valid, ref_dates, lookback)
    return orders_frequency(daily, F.col("ref_date"), ["customer_id", "ref_date"])
