"""Push notifications: experiment population and what each customer did before the send."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.columns import ratio
from tallyloom.operators.aggregates import first_row
from tallyloom.operators.newcomers import SEGMENTS
from tallyloom.operators.trailing import Trailing, attach_trailing

KEY = ["customer_id", "site"]


def sends(pushes: DataFrame, start: Column, end: Column, batch: str, types: Sequence[str] = ("sent", "control")) -> DataFrame:
    """Distinct sends and controls of the campaign's batches."""
    return pushes.where(
        F.col("push_type").isin(*types) & F.col("batch_id").like(batch) & F.col("sent_date").between(start, end)
    ).select("customer_id", "site", "sent_date", "push_type").distinct()


def same_day_orders(orders: DataFrame, delay: int = 4) -> DataFrame:
    """Customer days with a paid order that closed in time."""
    return orders.where(
        (F.col("status") == "paid") & F.col("closed").between(F.col("created"), F.date_add("created", delay))
    ).select(F.col("buyer_id").alias("customer_id"), "site", F.col("created").alias("sent_date")).distinct()


def backbone(sent: DataFrame, orders: DataFrame, per: Sequence[str] = ("customer_id", "site")) -> DataFrame:
    """Sends with a same-day conversion flag; one row per `per`, sends without an order first.

    The default keeps one send per customer and site; add "sent_date" to keep one per day.
    """
    days = same_day_orders(orders).withColumn("__bought", F.lit(1))
    rows = sent.join(days, ["customer_id", "site", "sent_date"], "left").select(
        *KEY, "sent_date", "push_type", F.coalesce("__bought", F.lit(0)).alias("conversion")
    )
    bought_day = F.when(F.col("conversion") == 1, F.col("sent_date"))
    order = [F.coalesce(F.unix_date(bought_day), F.lit(-(2**31) + 1)), "sent_date", "push_type"]
    return first_row(rows, list(per), order)


def push_history(backbone_: DataFrame, pushes: DataFrame, own_batch: str) -> DataFrame:
    """Push days of other batches: last 15 days against the 16 before, last 7 days, recency."""
    days = pushes.where(F.col("push_type").isin("sent", "control") & ~F.col("batch_id").like(own_batch)).select(
        *KEY, "sent_date"
    ).distinct()
    keys = backbone_.select(*KEY, "sent_date").distinct()
    rows = attach_trailing(
        keys, days, KEY, "sent_date", "sent_date",
        {
            "__near": Trailing("count", -15, -1), "__far": Trailing("count", -31, -16),
            "push_days_7d": Trailing("count", -7, -1), "__last": Trailing("last", -7, -1),
        },
    )
    return rows.select(
        *KEY, "sent_date", ratio("__near", "__far").alias("push_ratio_15d"), "push_days_7d",
        F.datediff("sent_date", "__last").alias("recency"),
    )


def push_behaviour(
    backbone_: DataFrame, visits: DataFrame, customers: DataFrame, installs: DataFrame, pays: DataFrame
) -> DataFrame:
    """Seven days of browsing, 360 of installs and 90 of payments before each send.

    Each source is reduced to one row per customer and day first; joining the sources
    line by line would multiply the sums. All of them are of the customer on the site of the send.
    Payments are those of the five segments; one that was recorded several times counts once, by its newest record.
    """
    keys = backbone_.select(*KEY, "sent_date").distinct()
    joined = customers.select(*KEY, "joined")
    early = F.col("log_date").between(F.col("joined"), F.date_add("joined", 7))
    views = F.col("view_android") + F.col("view_ios") + F.col("view_desktop") + F.col("view_web")
    daily = visits.join(joined, KEY, "left").groupBy(*KEY, "log_date").agg(
        F.sum("avg_price").alias("price_sum"), F.count("avg_price").alias("price_n"),
        F.sum(F.when(early, F.col("avg_price"))).alias("early_price_sum"), F.count(F.when(early, F.col("avg_price"))).alias("early_price_n"),
        F.sum("category_count").alias("cat"), F.sum(F.when(early, F.col("category_count"))).alias("early_cat"),
        F.min("min_price").alias("lo"), F.max("max_price").alias("hi"), F.sum("buy_intention").alias("buy"),
        F.sum(views).alias("views"), F.sum("question").alias("question"), F.sum("checkout").alias("checkout"),
        F.sum("add_to_cart").alias("cart"), F.sum("bookmark").alias("bookmark"),
    )
    week = {n: Trailing("sum", -7, -1, n) for n in (
        "price_sum", "price_n", "early_price_sum", "early_price_n", "cat", "early_cat", "buy", "views", "question", "checkout", "cart", "bookmark"
    )}
    browsing = attach_trailing(
        keys, daily, KEY, "sent_date", "log_date",
        {**{f"w_{n}": m for n, m in week.items()}, "log_days_7d": Trailing("count", -7, -1), "__last": Trailing("last", -7, -1),
         "min_price": Trailing("min", -7, -1, "lo"), "max_price": Trailing("max", -7, -1, "hi")},
    )

    def zero(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    browsing = browsing.select(
        *KEY, "sent_date", "log_days_7d", F.datediff("sent_date", "__last").alias("recency"),
        F.coalesce(ratio("w_price_sum", "w_price_n"), F.lit(0.0)).alias("avg_price_7d"),
        F.coalesce(ratio("w_early_price_sum", "w_early_price_n"), F.lit(0.0)).alias("avg_price_f7d"),
        zero("w_cat").alias("category_count_7d"), zero("w_early_cat").alias("category_count_f7d"), "min_price", "max_price",
        *[zero(f"w_{n}").alias(n) for n in ("buy", "views", "question", "checkout", "cart", "bookmark")],
    )
    a, b = F.col("app") == "A", F.col("app") == "B"
    install_days = installs.groupBy(*KEY, "install_date").agg(
        F.min("os_name").alias("os"), F.max(a.cast("int")).alias("a"), F.max(b.cast("int")).alias("b"),
        F.max(F.when(a, F.col("install_date"))).alias("day_a"), F.max(F.when(b, F.col("install_date"))).alias("day_b"),
    )
    apps = attach_trailing(
        keys, install_days, KEY, "sent_date", "install_date",
        {
            "os_name": Trailing("min", -360, -1, "os"), "__a": Trailing("max", -360, -1, "a"), "__b": Trailing("max", -360, -1, "b"),
            "__last_a": Trailing("max", -360, -1, "day_a"), "__first_a": Trailing("min", -360, -1, "day_a"),
            "__last_b": Trailing("max", -360, -1, "day_b"), "__first_b": Trailing("min", -360, -1, "day_b"),
        },
    ).select(
        *KEY, "sent_date", "os_name", zero("__a").alias("app_a"), zero("__b").alias("app_b"),
        F.datediff("sent_date", "__last_a").alias("days_last_install_a"), F.datediff("sent_date", "__first_a").alias("days_first_install_a"),
        F.datediff("sent_date", "__last_b").alias("days_last_install_b"), F.datediff("sent_date", "__first_b").alias("days_first_install_b"),
    )
    counted = pays.where((F.col("status") == "approved") & F.col("segment").isin(*SEGMENTS.values()))
    one_each = counted.groupBy(F.col("buyer_id").alias("customer_id"), "site", "payment_id").agg(
        F.max(F.struct("move_date", "amount", "segment")).alias("__pay")
    ).select(*KEY, "payment_id", "__pay.*")
    pay_days = one_each.groupBy(*KEY, "move_date").agg(
        F.sum("amount").alias("total"), F.sum(F.when(F.col("segment") == "Wallet", F.col("amount"))).alias("wallet"),
        F.sum(F.when(F.col("segment") == "Aggregator", F.col("amount"))).alias("aggregator"), F.count("payment_id").alias("n"),
    )
    money = attach_trailing(
        keys, pay_days, KEY, "sent_date", "move_date",
        {f"pay_{n}": Trailing("sum", -90, -1, n) for n in ("total", "wallet", "aggregator", "n")},
    ).select(*KEY, "sent_date", *[zero(f"pay_{n}").alias(f"pay_{n}") for n in ("total", "wallet", "aggregator", "n")])
    return browsing.join(apps, [*KEY, "sent_date"]).join(money, [*KEY, "sent_date"])
