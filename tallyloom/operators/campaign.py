"""Measurement of coupon campaigns: events, persuaded customers, covariates, forecasts, results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.config import ROW_AMOUNT_CAP
from tallyloom.functions.columns import count_when, ratio
from tallyloom.operators.orders import closed_in_time
from tallyloom.operators.trailing import Trailing, attach_trailing

# Batches that are never part of a campaign.
EXCLUDED_BATCHES = ["BLACKL", "HOLDRE", "JNYBLACKLIST"]


def campaign_events(tracks: DataFrame, campaign: str, bu: str, path: str = "/notification/campaigns_%") -> DataFrame:
    """One row per customer, site, date and type, read from the JSON payload of tracking rows.

    A batch that ends in _CG is the control group; excluded batches are dropped.
    """
    # A generator reads the payload once; column expressions would be copied into every condition.
    rows = tracks.where((F.col("bu") == bu) & F.col("path").like(path)).select(
        "user_id", "site", "ds", F.json_tuple("event_data", "batch_id", "event_type", "campaign_id").alias("batch", "kind", "campaign")
    )
    batch, kind = F.col("batch"), F.col("kind")
    kept = rows.where(F.col("campaign").rlike(f"(?i){campaign}") & kind.isin("sent", "shown", "open"))
    for name in EXCLUDED_BATCHES:
        kept = kept.where(~batch.like(rf"%\_{name}%"))
    label = F.when(batch.like(r"%\_CG"), "control").otherwise(kind)
    return kept.select(
        F.col("user_id").try_cast("long").alias("customer_id"), "site", F.col("ds").alias("sent_date"), label.alias("push_type")
    ).distinct()


def campaign_tools(tools: DataFrame, sites: Sequence[str], name: str, today: Column, days: int = 120) -> DataFrame:
    """Numeric ids of the coupon tools of a campaign that started in the last days; blanks in names are ignored."""
    plain = F.replace(F.lower("name"), F.lit(" "), F.lit(""))
    return tools.where(
        F.col("site").isin(*sites) & plain.like(f"%{name}%") & F.col("started").between(F.date_sub(today, days), today)
    ).select(F.col("tool_id").try_cast("long").alias("campaign_id"), "site").where(F.col("campaign_id").isNotNull())


def coupon_payments(pays: DataFrame, coupons: DataFrame, tools: DataFrame) -> DataFrame:
    """Approved payments made with a coupon of one of the tools."""
    approved = pays.where(F.col("status") == "approved")
    return approved.join(coupons, ["payment_id", "buyer_id"]).join(tools, ["campaign_id", "site"])


def coupon_users(pays: DataFrame, coupons: DataFrame, tools: DataFrame, day: Column) -> DataFrame:
    """Customers who paid with a coupon on the day or the day after."""
    rows = coupon_payments(pays, coupons, tools).where(F.col("move_date").between(day, F.date_add(day, 1)))
    return rows.select(F.col("buyer_id").alias("customer_id"), "site", day.alias("sent_date")).distinct()


def bought_within_a_day(sent: DataFrame, orders: DataFrame) -> DataFrame:
    """Sends (customer, site, date, ...) followed by an order on the day or the day after."""
    days = closed_in_time(orders).select(F.col("buyer_id").alias("customer_id"), "site", F.col("created").alias("__day")).distinct()
    near = days.withColumn("sent_date", F.explode(F.array("__day", F.date_sub("__day", 1)))).drop("__day").distinct()
    return sent.join(near, ["customer_id", "site", "sent_date"], "left_semi")


def persuaded(sent: DataFrame, orders: DataFrame, coupon_days: DataFrame) -> DataFrame:
    """Treated: openers who bought, and coupon users who were sent; control: the control group. One label each.

    Sends, orders and coupons are reduced to one row per customer, site and day; opening and
    buying on the day or the day after is a two-day frame over those rows.
    """
    key = ["customer_id", "site", "sent_date"]
    kind = F.col("push_type")
    rows = sent.select(
        *key, F.lit(1).alias("notified"), (kind == "open").cast("int").alias("open"), (kind == "sent").cast("int").alias("sent"),
        (kind == "control").cast("int").alias("control"),
    )
    bought = closed_in_time(orders).select(
        F.col("buyer_id").alias("customer_id"), "site", F.col("created").alias("sent_date"), F.lit(1).alias("bought")
    )
    coupon = coupon_days.select(*key, F.lit(1).alias("coupon"))
    flags = ["notified", "open", "sent", "control", "bought", "coupon"]
    days = rows.unionByName(bought, allowMissingColumns=True).unionByName(coupon, allowMissingColumns=True).groupBy(*key).agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in flags]
    )
    two_days = Window.partitionBy("customer_id", "site").orderBy(F.unix_date("sent_date")).rangeBetween(0, 1)
    seen = days.withColumns({"opened": F.max("open").over(two_days), "bought": F.max("bought").over(two_days)})
    treated = ((F.col("opened") == 1) & (F.col("bought") == 1)) | ((F.col("coupon") == 1) & (F.col("sent") == 1))
    label = F.when(treated, "TG").when(F.col("control") == 1, "CG")
    return seen.where(F.col("notified") == 1).select(*key, label.alias("grp")).where(F.col("grp").isNotNull())


def covariates(persuaded_: DataFrame, orders: DataFrame, visits: DataFrame, cap: int = ROW_AMOUNT_CAP) -> DataFrame:
    """A year of order history, the seven days after the send, and ninety days of visits, each of the customer on the site."""
    capped = F.least(F.col("amount"), F.lit(cap).cast("decimal(18,2)"))
    days = closed_in_time(orders).groupBy(F.col("buyer_id").alias("customer_id"), "site", F.col("created").alias("day")).agg(
        F.sum(capped).alias("money"), F.count(F.lit(1)).alias("n")
    )
    seen = visits.select("customer_id", "site", "log_date").distinct()
    key = ["customer_id", "site"]
    rows = attach_trailing(
        persuaded_, days, key, "sent_date", "day",
        {
            "freq_rfm": Trailing("count", -365, -1), "first_purchase": Trailing("first", -365, -1),
            "last_purchase": Trailing("last", -365, -1), "__money": Trailing("sum", -365, -1, "money"),
            "__n": Trailing("sum", -365, -1, "n"), "freq_7d": Trailing("count", 0, 6), "amount_7d": Trailing("sum", 0, 6, "money"),
        },
    )
    rows = rows.withColumn("amount_mean", ratio("__money", "__n")).drop("__money", "__n")
    return attach_trailing(
        rows, seen, key, "sent_date", "log_date",
        {"last_visit": Trailing("last", -90, -1), "active_days": Trailing("count", -90, -1)},
    )


def forecasts_at(sent: DataFrame, forecasts: DataFrame, days: int) -> DataFrame:
    """Forecasts of the sent customers, `days` after the send."""
    rows = sent.where(F.col("push_type").isin("sent", "control")).select("customer_id", "site", "sent_date").distinct()
    due = rows.withColumn("log_date", F.date_add("sent_date", days))
    return due.join(forecasts, ["customer_id", "site", "log_date"])


def forecasts_with_fallback(sent: DataFrame, forecasts: DataFrame, days: int) -> DataFrame:
    """Forecasts after `days`; sites without any take the day before."""
    first = forecasts_at(sent, forecasts, days)
    second = forecasts_at(sent, forecasts, days - 1).join(first.select("site").distinct(), "site", "left_anti")
    return first.unionByName(second)


def buyers_by_group(sent: DataFrame, orders: DataFrame) -> DataFrame:
    """Distinct buyers within a day of the send, by type and site."""
    rows = bought_within_a_day(sent.where(F.col("push_type").isin("sent", "control")), orders)
    return rows.select("site", "push_type", "customer_id").distinct().groupBy("site", "push_type").agg(
        F.count(F.lit(1)).alias("buyers")
    )


def spend_by_site(pays: DataFrame, coupons: DataFrame, tools: DataFrame, start: Column, end: Column) -> DataFrame:
    rows = coupon_payments(pays, coupons, tools).where(F.col("move_date").between(start, end))
    return rows.groupBy("site").agg(F.sum("coupon_amount").alias("amount"))


def rate_at_last_send(rates: DataFrame, sent: DataFrame) -> DataFrame:
    """Exchange rate of each site on its latest send date."""
    last = sent.groupBy("site").agg(F.max("sent_date").alias("day"))
    return rates.join(last, ["site", "day"]).select("site", "day", "rate")


def result_rows(sent: DataFrame, orders: DataFrame, spend: DataFrame, rates: DataFrame) -> DataFrame:
    """One wide row per site and date: customers by type, buyers, spend, rate and open rates."""
    kinds = ["sent", "shown", "open", "control"]
    users = sent.select("site", "sent_date", "push_type", "customer_id").distinct()
    counts = users.groupBy("site", "sent_date").agg(*[count_when(F.col("push_type") == k).alias(k) for k in kinds])
    bought = bought_within_a_day(users, orders).groupBy("site", "sent_date").agg(
        *[count_when(F.col("push_type") == k).alias(f"buyers_{k}") for k in ("sent", "control")]
    )
    day = F.col("sent_date")
    return (
        counts.join(bought, ["site", "sent_date"], "left").na.fill(0)
        .join(spend.withColumnRenamed("day", "sent_date"), ["site", "sent_date"], "left")
        .join(rates.withColumnRenamed("day", "sent_date"), ["site", "sent_date"], "left")
        .select(
            "site", day, *kinds, "buyers_sent", "buyers_control", "amount", "rate",
            ratio("open", "shown").alias("open_rate"), ratio("shown", "sent").alias("exposure"),
        )
    )


def daily_group_buyers(buyers: DataFrame, groups: DataFrame, names: Sequence[str]) -> DataFrame:
    """Distinct buyers per day, one column per group."""
    rows = buyers.select("customer_id", "day").distinct().join(groups, "customer_id")
    return rows.groupBy("day").pivot("grp", list(names)).agg(F.count(F.lit(1))).na.fill(0)
