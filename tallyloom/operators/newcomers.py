"""Feature blocks of customers registered in the last sixty days, up to their first order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.config import FILL_RECENCY
from tallyloom.operators.aggregates import window_grid

HORIZON = 60
# Payment segments, and counters of the visits table.
SEGMENTS = {
    "account_fund": "Account Fund", "wallet": "Wallet", "aggregator": "Aggregator", "point": "Point",
    "point_device": "Point Device Sale",
}
COUNTERS = [
    "category_count", "view_android", "view_ios", "view_desktop", "view_web", "buy_intention", "question",
    "checkout", "add_to_cart", "bookmark",
]
PRICE_LIMIT = 10000


def newcomers(
    customers: DataFrame, devices: DataFrame, today: Column, orders: DataFrame | None = None, days: int = HORIZON
) -> DataFrame:
    """Active customers registered in [today - 60, today - 1], with or without the app.

    With `orders`, customers who already have a paid order are left out.
    """
    rows = customers.where(
        (F.col("status") == "active") & ~F.col("nickname").like("%TEST%")
        & F.col("joined").between(F.date_sub(today, days), F.date_sub(today, 1))
    )
    if orders is not None:
        paid = orders.where((F.col("status") == "paid") & F.col("created").between(F.date_sub(today, days), today))
        rows = rows.join(paid.select(F.col("buyer_id").alias("customer_id")).distinct(), "customer_id", "left_anti")
    app = devices.where(
        (F.col("status") == "ACTIVE") & F.upper("platform").isin("ANDROID", "IOS")
    ).select("customer_id", "site").distinct().withColumn("__app", F.lit(True))
    return rows.join(app, ["customer_id", "site"], "left").select(
        "customer_id", "site", "joined", F.when(F.col("__app"), "App").otherwise("No app").alias("app_kind"),
        today.alias("process_date"),
    )


def first_order(customers: DataFrame, orders: DataFrame, days: int = HORIZON) -> DataFrame:
    """First paid order within sixty days of registration that closed within two days."""
    paid = orders.where(
        (F.col("status") == "paid") & F.col("closed").between(F.col("created"), F.date_add("created", 2))
    ).select(F.col("buyer_id").alias("customer_id"), "site", "created")
    rows = customers.select("customer_id", "site", "joined").join(paid, ["customer_id", "site"])
    return rows.where(F.col("created").between(F.col("joined"), F.date_add("joined", days))).groupBy(
        "customer_id", "site"
    ).agg(F.min("created").alias("first_order"))


def _before_order(rows: DataFrame, customers: DataFrame, first: DataFrame | None, day: str, today: Column, days: int) -> DataFrame:
    """Rows of the newcomers between registration and the first order (or the process date)."""
    base = customers.select("customer_id", "site", "joined")
    if first is not None:
        base = base.join(first, ["customer_id", "site"], "left")
    else:
        base = base.withColumn("first_order", F.lit(None).cast("date"))
    d = F.col(day)
    return rows.join(base, ["customer_id", "site"]).where(
        d.between(F.col("joined"), F.date_add("joined", days)) & (d < F.coalesce("first_order", today))
    )


def _windows(day: str, today: Column) -> dict[str, Column | None]:
    d = F.col(day)
    return {
        "": None,
        "_7d": d.between(F.date_sub(today, 7), today),
        "_f7d": d.between(F.col("joined"), F.date_add("joined", 7)),
    }


def payment_grid(pays: DataFrame, customers: DataFrame, first: DataFrame | None, today: Column, days: int = HORIZON) -> DataFrame:
    """Amounts and payment counts per segment over all, the last and the first seven days.

    Lines are reduced to one row per payment first, so counts need no distinct.
    """
    approved = pays.where(F.col("segment").isin(*SEGMENTS.values()) & (F.col("status") == "approved")).groupBy(
        F.col("buyer_id").alias("customer_id"), "site", "payment_id", "move_date", "segment"
    ).agg(F.sum("amount").alias("amount"))
    rows = _before_order(approved, customers, first, "move_date", today, days)
    measures = {"total_amount": ("sum", F.col("amount")), "total_count": ("sum", F.lit(1))}
    for name, label in SEGMENTS.items():
        here = F.col("segment") == label
        measures[f"{name}_amount"] = ("sum", F.when(here, F.col("amount")))
        measures[f"{name}_count"] = ("sum", F.when(here, 1).otherwise(0))
    return rows.groupBy("customer_id", "site").agg(*window_grid(measures, _windows("move_date", today)))


def event_grid(visits: DataFrame, customers: DataFrame, first: DataFrame | None, today: Column, days: int = HORIZON) -> DataFrame:
    """Item counters, prices and active days over all, the last and the first seven days.

    `visits` has one row per customer and day.
    """
    rows = _before_order(visits, customers, first, "log_date", today, days)
    measures = {c: ("sum", F.col(c)) for c in COUNTERS}
    measures |= {
        "min_price": ("min", F.col("min_price")), "max_price": ("max", F.col("max_price")),
        "avg_price": ("avg", F.col("avg_price")), "log_days": ("sum", F.lit(1)),
    }
    low = F.col("max_price") <= PRICE_LIMIT
    return rows.groupBy("customer_id", "site").agg(
        *window_grid(measures, _windows("log_date", today)),
        F.max(F.when(low, F.col("max_price")).otherwise(0)).alias("max_price_cut"),
        F.avg(F.when(F.col("avg_price") <= PRICE_LIMIT, F.col("avg_price")).otherwise(0)).alias("avg_price_cut"),
        F.max("log_date").alias("last_view"), F.min("log_date").alias("first_view"),
    )


def install_block(installs: DataFrame, customers: DataFrame, first: DataFrame | None, today: Column, days: int = HORIZON) -> DataFrame:
    """OS, app flags, first and last install per app."""
    rows = _before_order(installs, customers, first, "install_date", today, days)
    columns = [F.min("os_name").alias("os_name")]
    for app in ("A", "B"):
        here = F.col("app") == app
        columns += [
            F.max(here.cast("int")).alias(f"app_{app.lower()}"),
            F.max(F.when(here, F.col("install_date"))).alias(f"max_install_{app.lower()}"),
            F.min(F.when(here, F.col("install_date"))).alias(f"min_install_{app.lower()}"),
        ]
    return rows.groupBy("customer_id", "site").agg(*columns)


def day_differences(master: DataFrame) -> DataFrame:
    """Days between installs, views, registration and today; missing = -10; missing numbers = 0.

    Today is the first order where there is one, or else the process date.
    """
    today = F.coalesce("first_order", "process_date") if "first_order" in master.columns else F.col("process_date")
    pairs = {
        "days_install_a": (F.col("min_install_a"), F.col("joined")),
        "days_install_b": (F.col("min_install_b"), F.col("joined")),
        "days_last_view": (today, F.col("last_view")),
        "days_first_view": (today, F.col("first_view")),
        "days_last_view_joined": (F.col("last_view"), F.col("joined")),
        "days_first_view_joined": (F.col("first_view"), F.col("joined")),
    }
    numeric = [c for c in master.columns if any(p in c for p in ("_amount", "_count", "min_price", "max_price", "avg_price"))]
    fixed = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric}
    days = {n: F.coalesce(F.datediff(a, b), F.lit(int(FILL_RECENCY))) for n, (a, b) in pairs.items()}
    return master.withColumns({**fixed, **days})
