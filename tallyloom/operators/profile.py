"""Feature blocks from customer, payment, card, visit, install and location data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import text
from tallyloom.functions.columns import count_when, ratio, sum_when
from tallyloom.operators.aggregates import greatest_label, most_frequent
from tallyloom.operators.orders import of_population

# Names of the four device counters, in the order that settles ties.
DEVICE_COUNTERS = ["desktop_purchase", "mobile_web_purchase", "android_purchase", "ios_purchase"]

# School levels of the registry.
SCHOOL_LEVELS = {
    4: ["POS-GRADUACAO COMPLETA", "DOUTORADO COMPLETO", "MESTRADO COMPLETO"],
    3: ["SUPERIOR COMPLETO", "SUPERIOR INCOMPLETO"],
    2: ["ENSINO MÉDIO INCOMPLETO", "ENSINO MÉDIO COMPLETO", "MEDIO COMPLETO", "MEDIO INCOMPLETO"],
    1: [
        "ENSINO FUNDAMENTAL INCOMPLETO", "ENSINO FUNDAMENTAL COMPLETO", "FUNDAMENTAL COMPLETO",
        "FUNDAMENTAL INCOMPLETO",
    ],
    0: ["PRIMARIO INCOMPLETO", "PRIMARIO COMPLETO"],
}


def purchases_shipping(
    valid: DataFrame, devices: DataFrame, shipments: DataFrame, start: Column, end: Column
) -> DataFrame:
    """Carts, sellers in 30-day bins, purchases by device and condition, shipping kinds, main device.

    The joined lines are read once: each line counts towards its order, its seller and its
    cart; these are reduced to one row each, and then counted per customer. This takes the
    place of several distinct counts and of one pass over the join for each of them.
    """
    forward = shipments.where((F.col("kind") == "forward") & F.col("shipped").between(start, end)).select(
        F.col("shipment_id").alias("order_id"), "shipment_id", "cart_id", "cart_type", "picking", "free_flag"
    )
    rows = valid.join(devices, "channel", "left").join(forward, "order_id", "left")
    mobile = F.col("device_kind") == "Mobile-APP"

    def after(days: int) -> Column:
        return F.col("created") >= F.date_sub(end, days)

    lines = {
        "grocery_lines": F.col("grocery"),
        "desktop_purchase": F.col("device_kind") == "Desktop",
        "mobile_web_purchase": F.col("device_kind") == "Mobile-WEB",
        "android_purchase": mobile & (F.col("device_app") == "android"),
        "ios_purchase": mobile & (F.col("device_app") == "iphone"),
        "new_items": F.col("item_condition") == "new",
        "used_items": F.col("item_condition") == "used",
    }
    flags = {
        "order": [
            F.coalesce("free_flag", F.lit(0)) >= 1, F.col("shipment_id").isNull(), F.coalesce("cart_type", F.lit(0)) == 0,
            F.coalesce(F.col("picking") == "drop_off", F.lit(False)),
        ],
        "seller": [after(30), after(60) & ~after(30), after(90) & ~after(60), F.lit(False)],
        "cart": [F.lit(False)] * 4,
    }
    ids = {"order": "order_id", "seller": "seller_id", "cart": "cart_id"}

    def entry(kind: str) -> Column:
        counted = [
            (F.when(condition, 1).otherwise(0) if kind == "order" else F.lit(0)).cast("long").alias(name) for name, condition in lines.items()
        ]
        marks = [mark.alias(f"f{i}") for i, mark in enumerate(flags[kind])]
        return F.struct(F.lit(kind).alias("entry"), F.col(ids[kind]).cast("long").alias("id"), *counted, *marks)

    entries = rows.select(F.col("buyer_id").alias("customer_id"), F.inline(F.array(*[entry(k) for k in ids])))
    each = entries.where(F.col("id").isNotNull()).groupBy("customer_id", "entry", "id").agg(
        *[F.sum(c).alias(c) for c in lines], *[F.max(f"f{i}").alias(f"f{i}") for i in range(4)]
    )

    def number(kind: str, mark: int | None = None) -> Column:
        here = F.col("entry") == kind
        return count_when(here if mark is None else here & F.col(f"f{mark}"))

    return each.groupBy("customer_id").agg(
        *[F.sum(c).alias(c) for c in lines],
        number("order", 0).alias("orders_free_shipping"), number("order", 1).alias("orders_unshipped"),
        number("order", 2).alias("orders_no_cart"), number("order", 3).alias("orders_drop_off"),
        number("seller", 0).alias("sellers_30"), number("seller", 1).alias("sellers_60_30"),
        number("seller", 2).alias("sellers_90_60"), number("seller").alias("sellers_long"), number("cart").alias("carts"),
    ).withColumn("main_device", greatest_label(DEVICE_COUNTERS))


def tenure(customers: DataFrame, first_days: DataFrame, population: DataFrame, today: Column) -> DataFrame:
    """Days since registration, first listing, first buy and first sale.

    `customers`: customer_id, registered, first_listing; `first_days`: customer_id, first_buy, first_sale.
    """
    rows = customers.join(population, "customer_id", "left_semi").join(first_days, "customer_id", "left")
    return rows.select("customer_id", *tenure_measures(today))


def tenure_measures(today: Column) -> list[Column]:
    names = {"registered": "registration", "first_listing": "first_listing", "first_buy": "first_buy", "first_sale": "first_sale"}
    return [F.datediff(today, c).alias(f"days_from_{n}") for c, n in names.items()]


def payments(pays: DataFrame, bonus: DataFrame, population: DataFrame, start: Column, end: Column, site: str, limit: int = 10000) -> DataFrame:
    """Instalments, with and without interest, and counts by method.

    Payments without a bonus record are left out, as payments with the bonus are.
    """
    approved = pays.where(
        F.col("move_date").between(start, end) & (F.trim("site") == site) & (F.trim("marketplace") == "Y")
        & (F.col("status") == "approved") & F.col("order_id").isNotNull() & (F.col("total_paid") < limit)
    )
    rows = of_population(approved.join(bonus.where(~F.col("bonus_flag")), "order_id", "left_semi"), population)
    many = F.col("installments") > 1
    interest = ratio("total_paid", "price")
    method = F.col("method")
    return rows.groupBy(F.col("buyer_id").alias("customer_id")).agg(
        F.avg(F.when(many, F.col("installments"))).alias("avg_installments"),
        F.max("installments").alias("max_installments"),
        sum_when((interest == 1) & many).alias("without_interest"),
        sum_when((interest > 1) & many).alias("with_interest"),
        sum_when(F.lower(method) == "ticket").alias("sum_ticket"),
        sum_when(method == "account_money").alias("sum_account"),
        sum_when(method == "debit_card").alias("sum_debit"),
        sum_when(method == "credit_card").alias("sum_credit"),
    )


def cards(pays: DataFrame, lookup: DataFrame, population: DataFrame, start: Column, end: Column, site: str, home: str,
          levels: dict[str, int]) -> DataFrame:
    """Counts by method, foreign card, card level and prepaid flag, by the first digits of the card."""
    approved = pays.where(
        F.col("move_date").between(start, end) & (F.trim("site") == site) & (F.col("status") == "approved")
        & (F.col("tpv_flag") == 1)
    ).withColumn("bin", F.col("first_digits").try_cast("long"))
    rows = of_population(approved, population).join(lookup.where(F.col("card_type") == "CREDIT"), "bin", "left")
    level = F.lit(0)
    for name, value in levels.items():
        level = F.when(F.col("category") == name, value).otherwise(level)
    method = F.col("method")
    return rows.groupBy(F.col("buyer_id").alias("customer_id")).agg(
        sum_when(method == "debit_card").alias("debit_pay"),
        sum_when(method == "credit_card").alias("credit_pay"),
        sum_when(method == "account_money").alias("account_pay"),
        F.max(F.when(F.col("country") != home, 1).otherwise(0)).alias("foreign_card"),
        F.max(level).alias("card_level"),
        F.max(F.when(F.col("card_type") == "PREPAID", 1).otherwise(0)).alias("prepaid_card"),
    )


def installs(events: DataFrame, devices: DataFrame, population: DataFrame, today: Column, app: str) -> DataFrame:
    """Days since the last and first install of an app, and the device, from two sources."""
    first = events.where((F.col("app") == app) & (F.col("install_date") <= today)).select(
        "customer_id", F.col("install_date").alias("day"), F.col("os_name").alias("os")
    )
    second = devices.where((F.col("app") == app) & (F.col("status") == "ACTIVE") & (F.col("created") <= today)).select(
        "customer_id", F.col("created").alias("day"), F.col("platform").alias("os")
    )
    rows = first.unionByName(second).join(population, "customer_id", "left_semi")
    return rows.groupBy("customer_id").agg(
        F.min(F.datediff(today, "day")).alias("days_last_install"),
        F.max(F.datediff(today, "day")).alias("days_first_install"),
        F.max("os").alias("device"),
    )


def visits(daily: DataFrame, population: DataFrame, today: Column) -> DataFrame:
    """Recency, first visit and active days of the last 90 and 30 days, and bookmarks."""
    day = F.col("log_date")
    rows = daily.where(day.between(F.date_sub(today, 90), today)).join(population, "customer_id", "left_semi")
    return rows.groupBy("customer_id").agg(*visit_measures(today))


def visit_measures(today: Column) -> list[Column]:
    """Measures of the visit days of the last 90 days."""
    recent = F.col("log_date") >= F.date_sub(today, 30)
    age = F.datediff(today, "log_date")
    return [
        F.min(age).alias("recency_90d"), F.max(age).alias("first_90d"),
        F.min(F.when(recent, age)).alias("recency_30d"), F.max(F.when(recent, age)).alias("first_30d"),
        sum_when(recent).alias("active_days_30d"), F.count(F.lit(1)).alias("active_days_90d"),
        sum_when(recent, "bookmark").alias("bookmarks_30d"),
    ]


def location(valid: DataFrame, shipments: DataFrame, addresses: DataFrame, start: Column, end: Column) -> DataFrame:
    """Most frequent state and zip of a customer's deliveries; ties by name."""
    forward = shipments.where((F.col("kind") == "forward") & F.col("shipped").between(start, end)).select(
        F.col("shipment_id").alias("order_id"), "address_id"
    )
    rows = valid.select("order_id", "buyer_id").join(forward, "order_id").join(addresses, "address_id", "left").select(
        F.col("buyer_id").alias("customer_id"), text.casefold_plain("state_name").alias("location"),
        F.col("zip_code").try_cast("long").alias("zip_code"),
    )
    return most_frequent(rows, ["customer_id"], ["location", "zip_code"], "most_seen")


def registered_state(population: DataFrame, registry: DataFrame, addresses: DataFrame) -> DataFrame:
    """State of the newest registered address; `registry` links customer and document."""
    newest = addresses.groupBy("doc_type", "doc_number").agg(F.max_by("state", "address_no").alias("state"))
    return population.join(registry.join(newest, ["doc_type", "doc_number"]).select("customer_id", "state"), "customer_id")


def prepaid(
    accounts: DataFrame, withdrawals: DataFrame, cards_: DataFrame, population: DataFrame, start: Column, today: Column
) -> DataFrame:
    """Prepaid card flag, card recency, withdrawals of the 180 days before `start`, activation.

    Each many side is reduced to one row per account before the join, so several cards do
    not multiply the withdrawals.
    """
    active = accounts.where((F.col("status") == "active") & F.col("tags").like("%prod%")).join(
        population, "customer_id", "left_semi"
    )
    money = withdrawals.where(
        (F.col("status") == "approved") & F.col("day").between(F.date_sub(start, 180), start)
    ).groupBy("account_id").agg(
        F.sum("amount").alias("s"), F.count("amount").alias("n"), F.min("amount").alias("lo"), F.max("amount").alias("hi")
    )
    card = cards_.where(F.col("created") <= today).groupBy("account_id").agg(
        F.max("created").alias("created"), F.min("activated").alias("activated")
    )
    return active.join(card, "account_id").join(money, "account_id", "left").groupBy("customer_id").agg(*prepaid_measures(today))


def prepaid_measures(today: Column) -> list[Column]:
    """Measures over a customer's accounts, each with its card dates and the sums of its withdrawals."""
    return [
        F.lit(1).alias("has_prepaid"),
        F.datediff(today, F.max("created")).alias("ppd_recency"),
        F.sum("s").alias("ppd_sum_money"),
        ratio(F.sum("s"), F.sum("n")).alias("ppd_mean_money"),
        F.min("lo").alias("ppd_min_money"),
        F.max("hi").alias("ppd_max_money"),
        F.datediff(today, F.min("activated")).alias("ppd_first_activation"),
    ]


def asset_status(population: DataFrame, assets: DataFrame, today: Column) -> DataFrame:
    """'investing' when the customer invests since before the date. Both names are fixed values."""
    known = assets.where(F.col("since") <= today).groupBy("customer_id").agg(
        F.max(F.col("asset_status") == "investing").alias("__investing")
    )
    return population.join(known, "customer_id", "left").select(
        "customer_id", F.when(F.col("__investing"), "investing").otherwise("not_investing").alias("asset_status")
    )


def school_level(school: Column) -> Column:
    out = F.lit(None).cast("int")
    for level, names in SCHOOL_LEVELS.items():
        out = F.when(school.isin(names), level).otherwise(out)
    return out


def registry(links: DataFrame, persons: DataFrame, population: DataFrame, today: Column) -> DataFrame:
    """Type, school level, gender, income, age in calendar years, profession, civil status."""
    rows = links.join(population, "customer_id", "left_semi").join(persons, ["doc_type", "doc_number"])
    return rows.select("customer_id", *registry_measures(today))


def registry_measures(today: Column) -> list[Column]:
    return [
        F.col("data_type"), school_level(F.col("school")).alias("school"), F.col("gender"),
        text.max_number("income_text").alias("income"), (F.year(today) - F.year("birth_date")).alias("age"),
        F.col("profession"), F.col("civil_status"),
    ]


def monthly_active(activity: DataFrame, months: list[str], apps: list[str]) -> DataFrame:
    """Active flag and active days per month (newest last), per app and over all apps.

    `activity`: customer_id, app, day; may repeat days.
    """
    daily = activity.select("customer_id", "app", "day", F.date_format("day", "yyyyMM").alias("m")).distinct()
    columns = []
    n = len(months)
    for i, month in enumerate(months):
        tag = f"m{n - i}"
        for app in apps:
            days = count_when((F.col("m") == month) & (F.col("app") == app))
            columns += [(days > 0).cast("int").alias(f"active_{app}_{tag}"), days.alias(f"days_{app}_{tag}")]
        both = F.size(F.collect_set(F.when(F.col("m") == month, F.col("day"))))
        columns += [(both > 0).cast("int").alias(f"active_{tag}"), both.alias(f"days_{tag}")]
    return daily.groupBy("customer_id").agg(*columns)


def wallet_payers(pays: DataFrame, months: list[str], target_month: str) -> DataFrame:
    """Payments, payment days, recharges and undiscounted payments per month, dates, methods, label.

    `pays`: customer_id, payment_id, move_date, detail, discount, method_type.
    """
    rows = pays.withColumn("m", F.date_format("move_date", "yyyyMM"))
    recharge = F.col("detail") == "Cellphone Recharge"
    plain = F.coalesce(F.col("discount"), F.lit(0)) == 0
    columns = []
    n = len(months)
    for i, month in enumerate(months):
        here, tag = F.col("m") == month, f"m{n - i}"
        columns += [
            count_when(here).alias(f"payments_{tag}"),
            F.size(F.collect_set(F.when(here, F.col("move_date")))).alias(f"days_w_payments_{tag}"),
            count_when(here & recharge).alias(f"payments_recharge_{tag}"),
            count_when(here & plain).alias(f"payments_no_disc_{tag}"),
            count_when(here & recharge & plain).alias(f"payments_no_disc_recharge_{tag}"),
        ]
    seen = F.when(F.col("m") < target_month, F.col("move_date"))
    return rows.groupBy("customer_id").agg(
        *columns,
        F.min(seen).alias("first_payment"), F.max(seen).alias("last_payment"),
        *[count_when(F.col("method_type") == m).alias(f"payments_{m}") for m in ("account_money", "credit_card", "debit_card")],
        F.max(((F.col("m") == target_month) & recharge).cast("int")).alias("target"),
    )


def payment_extract(pays: DataFrame, start: Column, end: Column, segment: str, n: int) -> DataFrame:
    """Payment lines of one segment, at most n, in payment order."""
    rows = pays.where(F.col("move_date").between(start, end) & (F.col("segment") == segment) & (F.col("tpv_flag") == 1))
    return rows.select("buyer_id", "move_date", "payment_id", "total_paid", "method").orderBy(
        "payment_id", "total_paid", "method"
    ).limit(n)
