"""Panel: every feature block and the target at many reference dates, in one plan.

Each source is read once and reduced to what a customer did on a day. Those rows are listed under the reference dates
whose windows hold the day, and every measure is an aggregate per customer and date. Neither scans nor joins depend on
the number of dates; only the listed day rows do.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.functions.columns import count_when, date_lit, ratio, sum_when
from tallyloom.operators import joins, orders, prepare, profile
from tallyloom.operators.aggregates import greatest_label
from tallyloom.operators.sampling import unit_hash

KEYS = ["customer_id", "ref_date"]


@dataclass(frozen=True)
class Grid:
    """Reference dates, days of history before each date and days of the target after it."""

    dates: Sequence
    lookback: int = 365
    ahead: int = 90


def listed(rows: DataFrame, grid: Grid, *windows: tuple[str, int | None, int]) -> DataFrame:
    """Rows once for every reference date whose windows hold them; adds `ref_date`.

    A window is (date column, first day, last day) in days from the reference date, both included; a first day of None
    leaves it open. A row with NULL in a windowed column is listed nowhere.
    """
    low, high = date_lit(min(grid.dates)), date_lit(max(grid.dates))
    for column, first, last in windows:  # what no date can hold, stated so that it can reach the scan
        rows = rows.where(F.col(column) <= F.date_add(high, last))
        if first is not None:
            rows = rows.where(F.col(column) >= F.date_add(low, first))

    def holds(ref: Column) -> Column:
        out = F.lit(True)
        for column, first, last in windows:
            out = out & (F.col(column) <= F.date_add(ref, last))
            if first is not None:
                out = out & (F.col(column) >= F.date_add(ref, first))
        return out

    return rows.withColumn("ref_date", F.explode(F.filter(F.array(*[date_lit(d) for d in grid.dates]), holds)))


def population_at(lines: DataFrame, grid: Grid, sample: int | None = None, seed: str = "s") -> DataFrame:
    """All buyers of the history of each date; with `sample`, a repeatable draw of about that many where a date has more.

    The draw is by a hash of date and customer, so every date has its own.
    """
    days = lines.select(F.col("buyer_id").alias("customer_id"), "closed").distinct()
    buyers = listed(days, grid, ("closed", -grid.lookback, 0)).select(*KEYS).distinct()
    if sample is None:
        return buyers
    share = buyers.groupBy("ref_date").agg((F.lit(float(sample)) / F.count(F.lit(1))).alias("__share"))  # one row per date
    place = unit_hash(F.concat_ws("|", F.col("ref_date").cast("string"), F.col("customer_id").cast("string")), seed)
    return buyers.join(F.broadcast(share), "ref_date").where(place < F.col("__share")).select(*KEYS)


def order_block(lines: DataFrame, grid: Grid) -> DataFrame:
    """Order frequency and capped price, one aggregate over one daily grain."""
    daily = orders.daily_orders_at(lines, grid.dates, grid.lookback)
    price = orders.capped_day_price()
    return daily.groupBy(*KEYS).agg(*orders.order_frequency_measures(F.col("ref_date")), price.alias("asp_capped"))


def target_block(lines: DataFrame, grid: Grid) -> DataFrame:
    """Purchase days and amount of the days after each date."""
    days = lines.groupBy(F.col("buyer_id").alias("customer_id"), "created", "closed").agg(F.sum("amount").alias("amount"))
    per_day = listed(days, grid, ("closed", 1, grid.ahead)).groupBy(*KEYS, "created").agg(F.sum("amount").alias("amount"))
    return per_day.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("freq_target"), F.sum("amount").alias("amount_target"))


def interval_block(lines: DataFrame, grid: Grid, short_days: int = 60) -> DataFrame:
    """Logs of the days between purchases within the history of each date."""
    days = lines.select(F.col("buyer_id").alias("customer_id"), F.col("closed").alias("day")).distinct()
    at = listed(days, grid, ("day", -grid.lookback, 0))
    return orders.intervals(at, F.col("ref_date"), short_days, KEYS)


def seller_block(lines: DataFrame, grid: Grid) -> DataFrame:
    """Sales as a seller, days since the last and the first one."""
    days = lines.groupBy(F.col("seller_id").alias("customer_id"), "created", "closed").agg(F.sum("amount").alias("amount"))
    age = F.datediff("ref_date", "created")
    return listed(days, grid, ("closed", -grid.lookback, 0)).groupBy(*KEYS).agg(
        F.sum("amount").alias("seller_sales"), F.min(age).alias("seller_recency"), F.max(age).alias("seller_first")
    )


def shipping_block(lines: DataFrame, devices: DataFrame, shipments: DataFrame, grid: Grid) -> DataFrame:
    """Carts, sellers in 30-day bins, purchases by device and condition, shipping kinds, main device.

    A line counts towards its order, its seller and its cart. Each of them is laid out by customer and id once; listing
    and reducing it to one row per date then need no further shuffle. A shipment outside the history of a date counts as none.
    """
    forward = shipments.where(F.col("kind") == "forward").select(
        F.col("shipment_id").alias("order_id"), "shipped", "cart_id", "cart_type", "picking", "free_flag"
    )
    rows = lines.join(devices, "channel", "left").join(forward, "order_id", "left")
    mobile = F.col("device_kind") == "Mobile-APP"
    counted = {
        "grocery_lines": F.col("grocery"), "desktop_purchase": F.col("device_kind") == "Desktop",
        "mobile_web_purchase": F.col("device_kind") == "Mobile-WEB", "android_purchase": mobile & (F.col("device_app") == "android"),
        "ios_purchase": mobile & (F.col("device_app") == "iphone"), "new_items": F.col("item_condition") == "new",
        "used_items": F.col("item_condition") == "used",
    }
    ids = {"order": "order_id", "seller": "seller_id", "cart": "cart_id"}

    def entry(kind: str) -> Column:
        ones = [(F.when(c, 1).otherwise(0) if kind == "order" else F.lit(0)).cast("long").alias(n) for n, c in counted.items()]
        return F.struct(F.lit(kind).alias("entry"), F.col(ids[kind]).cast("long").alias("id"), *ones)

    entries = rows.select(
        F.col("buyer_id").alias("customer_id"), "created", "closed", "shipped", (F.coalesce("free_flag", F.lit(0)) >= 1).alias("free"),
        (F.coalesce("cart_type", F.lit(0)) == 0).alias("no_cart"), F.coalesce(F.col("picking") == "drop_off", F.lit(False)).alias("drop"),
        F.inline(F.array(*[entry(k) for k in ids])),
    ).where(F.col("id").isNotNull())
    marks = ["free", "no_cart", "drop"]
    grain = entries.repartition("customer_id", "entry", "id").groupBy("customer_id", "entry", "id", "created", "closed", "shipped").agg(
        *[F.sum(c).alias(c) for c in counted], *[F.max(m).alias(m) for m in marks]
    )
    inside = F.coalesce(F.col("shipped").between(F.date_sub("ref_date", grid.lookback), F.col("ref_date")), F.lit(False))

    def after(days: int) -> Column:
        return F.col("created") >= F.date_sub("ref_date", days)

    flags = {
        "shipped": inside, "free": inside & F.col("free"), "no_cart": ~inside | F.col("no_cart"), "drop": inside & F.col("drop"),
        "s30": after(30), "s60": after(60) & ~after(30), "s90": after(90) & ~after(60),
    }
    each = listed(grain, grid, ("closed", -grid.lookback, 0)).groupBy(*KEYS, "entry", "id").agg(
        *[F.sum(c).alias(c) for c in counted], *[F.max(f).alias(f"f_{n}") for n, f in flags.items()]
    )

    def number(kind: str, mark: Column | None = None) -> Column:
        here = F.col("entry") == kind
        return count_when(here if mark is None else here & mark)

    flag = {n: F.col(f"f_{n}") for n in flags}
    return each.groupBy(*KEYS).agg(
        *[F.sum(c).alias(c) for c in counted],
        number("order", flag["free"]).alias("orders_free_shipping"), number("order", ~flag["shipped"]).alias("orders_unshipped"),
        number("order", flag["no_cart"]).alias("orders_no_cart"), number("order", flag["drop"]).alias("orders_drop_off"),
        number("seller", flag["s30"]).alias("sellers_30"), number("seller", flag["s60"]).alias("sellers_60_30"),
        number("seller", flag["s90"]).alias("sellers_90_60"), number("seller").alias("sellers_long"),
        number("cart", flag["shipped"]).alias("carts"),
    ).withColumn("main_device", greatest_label(profile.DEVICE_COUNTERS))


def location_block(lines: DataFrame, shipments: DataFrame, addresses: DataFrame, grid: Grid) -> DataFrame:
    """Most frequent state and zip of the deliveries in the history of each date; ties by name."""
    forward = shipments.where(F.col("kind") == "forward").select(F.col("shipment_id").alias("order_id"), "shipped", "address_id")
    places = lines.select("order_id", "buyer_id", "closed").join(forward, "order_id").join(addresses, "address_id", "left").select(
        F.col("buyer_id").alias("customer_id"), "closed", "shipped", text.casefold_plain("state_name").alias("location"),
        F.col("zip_code").try_cast("long").alias("zip_code"),
    )
    days = places.groupBy(*places.columns).agg(F.count(F.lit(1)).alias("n"))
    at = listed(days, grid, ("closed", -grid.lookback, 0), ("shipped", -grid.lookback, 0))
    seen = at.groupBy(*KEYS, "location", "zip_code").agg(F.sum("n").alias("most_seen"))
    best = F.min_by(F.struct("location", "zip_code", "most_seen"), F.struct((-F.col("most_seen")).alias("o"), "location", "zip_code"))
    return seen.groupBy(*KEYS).agg(best.alias("__best")).select(*KEYS, "__best.*")


def payment_block(pays: DataFrame, bonus: DataFrame, grid: Grid, site: str, limit: int = 10000) -> DataFrame:
    """Instalments, with and without interest, counts by method. The day rows hold sums, so the mean is exact."""
    approved = pays.where(
        (F.trim("site") == site) & (F.trim("marketplace") == "Y") & (F.col("status") == "approved") & F.col("order_id").isNotNull()
        & (F.col("total_paid") < limit)
    )
    many, method, interest = F.col("installments") > 1, F.col("method"), ratio("total_paid", "price")
    counts = {
        "without_interest": (interest == 1) & many, "with_interest": (interest > 1) & many, "sum_ticket": F.lower(method) == "ticket",
        "sum_account": method == "account_money", "sum_debit": method == "debit_card", "sum_credit": method == "credit_card",
    }
    days = approved.join(bonus.where(~F.col("bonus_flag")), "order_id", "left_semi").groupBy(
        F.col("buyer_id").alias("customer_id"), "move_date"
    ).agg(
        F.sum(F.when(many, F.col("installments"))).alias("many_sum"), count_when(many).alias("many_n"),
        F.max("installments").alias("max_installments"), *[sum_when(c).alias(n) for n, c in counts.items()],
    )
    return listed(days, grid, ("move_date", -grid.lookback, 0)).groupBy(*KEYS).agg(
        ratio(F.sum("many_sum"), F.sum("many_n")).alias("avg_installments"), F.max("max_installments").alias("max_installments"),
        *[F.sum(n).alias(n) for n in counts],
    )


def card_block(pays: DataFrame, lookup: DataFrame, grid: Grid, site: str, home: str, levels: Mapping[str, int]) -> DataFrame:
    """Counts by method, foreign card, card level and prepaid flag, by the first digits of the card."""
    approved = pays.where((F.trim("site") == site) & (F.col("status") == "approved") & (F.col("tpv_flag") == 1)).withColumn(
        "bin", F.col("first_digits").try_cast("long")
    )
    rows = approved.join(lookup.where(F.col("card_type") == "CREDIT"), "bin", "left")
    level = F.lit(0)
    for name, value in levels.items():
        level = F.when(F.col("category") == name, value).otherwise(level)
    counts = {"debit_pay": "debit_card", "credit_pay": "credit_card", "account_pay": "account_money"}
    best = {
        "foreign_card": F.when(F.col("country") != home, 1).otherwise(0), "card_level": level,
        "prepaid_card": F.when(F.col("card_type") == "PREPAID", 1).otherwise(0),
    }
    days = rows.groupBy(F.col("buyer_id").alias("customer_id"), "move_date").agg(
        *[sum_when(F.col("method") == m).alias(n) for n, m in counts.items()], *[F.max(c).alias(n) for n, c in best.items()]
    )
    return listed(days, grid, ("move_date", -grid.lookback, 0)).groupBy(*KEYS).agg(
        *[F.sum(n).alias(n) for n in counts], *[F.max(n).alias(n) for n in best]
    )


def install_block(events: DataFrame, devices: DataFrame, grid: Grid, apps: Mapping[str, str]) -> DataFrame:
    """Days since the last and first install up to each date and the device, for every app in one pass: prefix -> app."""
    first = events.select("customer_id", "app", F.col("install_date").alias("day"), F.col("os_name").alias("os"))
    second = devices.where(F.col("status") == "ACTIVE").select(
        "customer_id", "app", F.col("created").alias("day"), F.col("platform").alias("os")
    )
    rows = first.unionByName(second).where(F.col("app").isin(list(apps.values())))
    days = rows.groupBy("customer_id", "app", "day").agg(F.max("os").alias("os"))
    age = F.datediff("ref_date", "day")
    measures = []
    for prefix, app in apps.items():
        here = F.col("app") == app
        measures += [
            F.min(F.when(here, age)).alias(f"{prefix}_days_last_install"), F.max(F.when(here, age)).alias(f"{prefix}_days_first_install"),
            F.max(F.when(here, F.col("os"))).alias(f"{prefix}_device"),
        ]
    return listed(days, grid, ("day", None, 0)).groupBy(*KEYS).agg(*measures)


def visit_block(daily: DataFrame, grid: Grid) -> DataFrame:
    """Recency, first visit and active days of the last 90 and 30 days, and bookmarks."""
    at = listed(daily.select("customer_id", "log_date", "bookmark"), grid, ("log_date", -90, 0))
    return at.groupBy(*KEYS).agg(*profile.visit_measures(F.col("ref_date")))


def prepaid_block(accounts: DataFrame, withdrawals: DataFrame, cards: DataFrame, grid: Grid) -> DataFrame:
    """Prepaid card flag, recency and activation, and withdrawals of the 180 days before the history begins."""
    active = accounts.where((F.col("status") == "active") & F.col("tags").like("%prod%")).select("customer_id", "account_id")
    spent = withdrawals.where(F.col("status") == "approved").groupBy("account_id", "day").agg(
        F.sum("amount").alias("s"), F.count("amount").alias("n"), F.min("amount").alias("lo"), F.max("amount").alias("hi")
    )
    money = listed(spent, grid, ("day", -grid.lookback - 180, -grid.lookback)).groupBy("account_id", "ref_date").agg(
        F.sum("s").alias("s"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )
    held = cards.groupBy("account_id", "created").agg(F.min("activated").alias("activated"))
    card = listed(held, grid, ("created", None, 0)).groupBy("account_id", "ref_date").agg(
        F.max("created").alias("created"), F.min("activated").alias("activated")
    )
    rows = card.join(active, "account_id").join(money, ["account_id", "ref_date"], "left")
    return rows.groupBy(*KEYS).agg(*profile.prepaid_measures(F.col("ref_date")))


def asset_block(population: DataFrame, assets: DataFrame) -> DataFrame:
    """'investing' when the customer invests since before the date. Both names are fixed values."""
    first = assets.where(F.col("asset_status") == "investing").groupBy("customer_id").agg(F.min("since").alias("__since"))
    status = F.when(F.col("__since") <= F.col("ref_date"), "investing").otherwise("not_investing")
    return population.join(first, "customer_id", "left").select(*KEYS, status.alias("asset_status"))


def tenure_block(population: DataFrame, customers: DataFrame, first_days: DataFrame) -> DataFrame:
    """Days from registration, first listing, first buy and first sale to each date."""
    rows = population.join(customers, "customer_id").join(first_days, "customer_id", "left")
    return rows.select(*KEYS, *profile.tenure_measures(F.col("ref_date")))


def registry_block(population: DataFrame, links: DataFrame, persons: DataFrame) -> DataFrame:
    """Type, school level, gender, income, age in calendar years, profession, civil status."""
    rows = population.join(links, "customer_id").join(persons, ["doc_type", "doc_number"])
    return rows.select(*KEYS, *profile.registry_measures(F.col("ref_date")))


def of_customers(rows: DataFrame, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows of the panel's customers, before anything is shuffled for the blocks."""
    return orders.of_population(rows, customers, key)


def join_panel(population: DataFrame, blocks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per customer and date of the population; every block's columns get its name in front."""
    named = [prepare.prefix_columns(b, name, KEYS) if name else b for name, b in blocks.items()]
    return joins.join_blocks(population, named, KEYS)
