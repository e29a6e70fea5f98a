"""Budget pacing of coupon campaigns: daily spend, targets, alarms. One row per day and site."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import ratio
from tallyloom.functions.dates import date_range
from tallyloom.operators.aggregates import first_row


def daily_spend(pays: DataFrame, coupons: DataFrame, tools: DataFrame, start: Column, end: Column) -> DataFrame:
    """Approved coupon spend per site and day; a tool listed twice counts once."""
    known = tools.select("campaign_id", "site").distinct()
    rows = pays.where((F.col("status") == "approved") & F.col("move_date").between(start, end)).join(coupons, ["payment_id", "buyer_id"])
    return rows.join(known, ["campaign_id", "site"]).groupBy("site", F.col("move_date").alias("day")).agg(F.sum("coupon_amount").alias("amount"))


def expand(spend: DataFrame, start: str, end: str) -> DataFrame:
    """All days of the period for each site, missing days 0, and the running total."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))
    known = spend.groupBy("site").agg(F.map_from_entries(F.collect_list(F.struct("day", "amount"))).alias("__spent"))
    rows = known.select("site", F.explode(days).alias("day"), "__spent").select(
        "site", "day", F.coalesce(F.element_at("__spent", F.col("day")), F.lit(0).cast(spend.schema["amount"].dataType)).alias("amount")
    )
    upto = Window.partitionBy("site").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("acc_amount", F.sum("amount").over(upto))


def daily_target(expanded: DataFrame, budgets: Mapping[str, float], end: str) -> DataFrame:
    """(budget - spent before) / days left; the last day takes what is left of the budget."""
    budget = F.lit(None).cast("double")
    for site, value in budgets.items():
        budget = F.when(F.col("site") == site, float(value)).otherwise(budget)
    place = Window.partitionBy("site").orderBy("day")
    before = F.coalesce(F.lag(F.col("acc_amount").cast("double")).over(place), F.lit(0.0))
    left = F.datediff(F.lit(end).cast("date"), "day")
    target = F.when(left > 0, (budget - before) / left).otherwise(budget - F.col("acc_amount").cast("double"))
    return expanded.withColumns({"budget": budget, "spent_before": before, "target": target})


def alarms(targets: DataFrame, start: str, end: str, over: float = 3.0) -> DataFrame:
    """Target over three times the mean; too little spent after half of the time; too much before it."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    n = F.datediff(last, first) + 1
    time = F.round(1 - F.datediff(last, "day") / n, 2)
    used = F.round(F.col("spent_before") / F.col("budget"), 2)
    return targets.withColumns(
        {
            "time_share": time, "budget_share": used, "over_limit": F.col("target") > over * F.col("budget") / n,
            "under_spend": (time > 0.5) & (used < 0.5), "over_spend": (time < 0.5) & (used > 0.5),
        }
    )


def progress(spend: DataFrame, tools: DataFrame, names: Sequence[str]) -> DataFrame:
    """Share of the budget used so far in %, per tool and in total, one row per day.

    `spend`: day, tool, amount; `tools`: tool, budget.
    """
    wide = spend.groupBy("day").pivot("tool", list(names)).agg(F.sum("amount")).na.fill(0)
    budgets = tools.where(F.col("tool").isin(list(names))).agg(
        F.struct(*[F.sum(F.when(F.col("tool") == n, F.col("budget"))).alias(n) for n in names], F.sum("budget").alias("__all"))
    ).scalar()
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = sum((F.col(n) for n in names), F.lit(0))
    return wide.withColumn("__b", budgets).select(
        "day", *[ratio(F.sum(n).over(upto) * 100, F.col("__b").getField(n)).alias(f"used_{n}") for n in names],
        ratio(F.sum(total).over(upto) * 100, F.col("__b").getField("__all")).alias("used_total"),
    )


def main_coupon(pays: DataFrame, coupons: DataFrame) -> DataFrame:
    """Most used coupon value per day; the larger one wins ties."""
    rows = pays.where(F.col("status") == "approved").join(coupons, ["payment_id", "buyer_id"])
    counts = rows.groupBy(F.col("move_date").alias("day"), "coupon_amount").agg(F.count_distinct("payment_id").alias("n"))
    return first_row(counts, ["day"], [-F.col("n"), -F.col("coupon_amount")])


def cost_dataset(spend: DataFrame, sends: DataFrame, coupon: DataFrame, start: str, end: str) -> DataFrame:
    """Spend, sends, coupon value (carried forward) and weekday of every day."""
    days = date_range(spend.sparkSession, start, end)
    rows = days.join(spend.groupBy("day").agg(F.sum("amount").alias("amount")), "day", "left").join(sends, "day", "left").join(coupon, "day", "left")
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.na.fill(0, ["amount", "sent"]).select(
        "day", "amount", "sent", F.last("coupon_amount", True).over(upto).alias("coupon_amount"), F.weekday("day").alias("day_of_week")
    )


def send_count(pushes: DataFrame, batch: str, start: Column, end: Column) -> DataFrame:
    """Sends per day of the campaign's batches."""
    rows = pushes.where((F.col("push_type") == "sent") & F.col("batch_id").like(batch) & F.col("sent_date").between(start, end))
    return rows.groupBy(F.col("sent_date").alias("day")).agg(F.count(F.lit(1)).alias("sent"))


def campaign_budget(pushes: DataFrame, tools: DataFrame, batch: str, start: Column, end: Column) -> DataFrame:
    """First and last send of each campaign with the budget of its tools.

    `pushes`: campaign_id, batch_id, sent_date; `tools`: campaign_id, tool_id, budget, started.
    """
    sent = pushes.where(F.col("batch_id").like(batch) & F.col("sent_date").between(start, end)).groupBy("campaign_id").agg(
        F.min("sent_date").alias("first_send"), F.max("sent_date").alias("last_send")
    )
    known = tools.groupBy("campaign_id", "tool_id", "budget").agg(F.min("started").alias("first_budget"))
    return sent.join(known, "campaign_id", "left")
