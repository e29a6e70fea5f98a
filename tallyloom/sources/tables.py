"""Default binding of the engine's roles to the driver's tables.

Operators take plain column names, so other sources only need an adapter like the
ones below. Columns are projected before any join, so that the Parquet scans read
only what a role needs.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Device of an order, by the text of its priority.
DEVICES = [
    ("1-URGENT", "Desktop", "web"),
    ("2-HIGH", "Mobile-WEB", "web"),
    ("3-MEDIUM", "Mobile-APP", "android"),
    ("4-NOT SPECIFIED", "Mobile-APP", "iphone"),
]

# Payment method of an order, by the text of its priority.
METHODS = {
    "1-URGENT": "Ticket",
    "2-HIGH": "account_money",
    "3-MEDIUM": "debit_card",
    "4-NOT SPECIFIED": "credit_card",
    "5-LOW": "ticket",
}


def labelled(column: Column | str, labels: dict[str, str], otherwise: str | None = None) -> Column:
    """Literal value map as one CASE expression; unmapped values become `otherwise`."""
    column = F.col(column) if isinstance(column, str) else column
    out = None
    for value, label in labels.items():
        out = (F if out is None else out).when(column == value, F.lit(label))
    return out.otherwise(F.lit(otherwise)) if otherwise is not None else out


class Tables:
    """Lazy access to the tables of one folder and to the roles bound to them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.shared_population: DataFrame | None = None
        self.shared_lines: DataFrame | None = None

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def orders(self) -> DataFrame:
        """Order headers: one row per order."""
        return self.read("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("buyer_id"),
            F.when(F.col("o_orderstatus") == "P", "cancelled").otherwise("paid").alias("status"),
            F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
            F.col("o_orderdate").cast("date").alias("created"),
            F.col("o_orderpriority").alias("channel"),
            F.col("o_orderstatus").alias("status_code"),
        )

    @cached_property
    def order_lines(self) -> DataFrame:
        """Order items: the grain of the feature store."""
        lines = self.read("lineitem")
        heads = self.read("orders")
        key = F.col("o_orderkey")
        created = F.col("o_orderdate").cast("date")
        return lines.join(heads, lines.l_orderkey == heads.o_orderkey).select(
            F.col("o_custkey").alias("buyer_id"),
            F.col("l_suppkey").alias("seller_id"),
            key.alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("item_id"),
            F.when(key % 3 != 0, F.expr("o_orderkey div 2")).alias("pack_id"),
            F.when(F.col("o_orderstatus") == "P", "cancelled").otherwise("paid").alias("status"),
            F.col("l_linestatus").alias("site"),
            (F.col("l_extendedprice") / 10).cast("decimal(18,3)").alias("amount"),
            F.col("l_quantity").cast("long").alias("items"),
            created.alias("created"),
            F.date_add(created, F.col("l_linenumber") - 1).alias("closed"),
            (F.col("l_tax") == 0.08).alias("auto_offer"),
            (F.col("l_discount") == 0).alias("bonus"),
            (F.col("l_returnflag") == "A").alias("grocery"),
            labelled("l_returnflag", {"N": "new", "R": "used"}, "unknown").alias("item_condition"),
            F.col("o_orderpriority").alias("channel"),
        )

    @cached_property
    def devices(self) -> DataFrame:
        return self.spark.createDataFrame(DEVICES, "channel string, device_kind string, device_app string")

    @cached_property
    def shipments(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.read("orders").where(F.col("o_orderpriority") != "5-LOW").select(
            key.alias("shipment_id"),
            F.expr("o_orderkey div 2").alias("cart_id"),
            F.date_add(F.col("o_orderdate").cast("date"), 1).alias("shipped"),
            F.when(F.col("o_orderpriority") == "3-MEDIUM", "return").otherwise("forward").alias("kind"),
            F.when(F.col("o_orderpriority") < "3", 1).alias("free_flag"),
            (key % 2).alias("cart_type"),
            F.when(F.col("o_orderstatus") == "F", "drop_off").otherwise("cross_docking").alias("picking"),
            (key % 25).cast("int").alias("address_id"),
        )

    @cached_property
    def addresses(self) -> DataFrame:
        key = F.col("n_nationkey")
        return self.read("nation").where(F.col("n_regionkey") != 4).select(
            key.alias("address_id"),
            F.concat(F.when(key % 2 == 0, "México ").otherwise("MEXICO "), "n_name").alias("state_name"),
            F.when(key % 4 == 0, "n/a").otherwise((key + 1000).cast("string")).alias("zip_code"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        lines = self.read("lineitem")
        heads = self.read("orders")
        price = F.col("l_extendedprice") / 10
        return lines.join(heads, lines.l_orderkey == heads.o_orderkey).select(
            (F.col("o_orderkey") * 8 + F.col("l_linenumber")).alias("payment_id"),
            F.col("o_custkey").alias("buyer_id"),
            F.concat(F.col("l_linestatus"), F.lit(" ")).alias("site"),
            F.col("o_orderdate").cast("date").alias("move_date"),
            F.when(F.col("o_orderstatus") == "P", "rejected").otherwise("approved").alias("status"),
            labelled("o_orderpriority", METHODS).alias("method"),
            F.col("l_linenumber").alias("installments"),
            (price * (1 + F.col("l_tax"))).cast("decimal(18,3)").alias("total_paid"),
            price.cast("decimal(18,3)").alias("price"),
            F.when(F.col("l_returnflag") == "A", "N ").otherwise("Y ").alias("marketplace"),
            F.when(F.col("l_quantity") != 50, F.col("o_orderkey")).alias("order_id"),
            F.when(F.col("l_returnflag") == "R", F.concat(F.lit("x"), F.col("l_partkey").cast("string")))
            .otherwise(F.col("l_partkey").cast("string")).alias("first_digits"),
            labelled("l_returnflag", {"A": "Account Fund", "N": "Wallet", "R": "Aggregator"}).alias("segment"),
            (F.col("l_linenumber") != 7).cast("int").alias("tpv_flag"),
            F.col("l_discount").alias("discount"),
        )

    @cached_property
    def order_bonus(self) -> DataFrame:
        return self.read("orders").where(F.col("o_orderpriority") != "4-NOT SPECIFIED").select(
            F.col("o_orderkey").alias("order_id"),
            (F.col("o_orderpriority") == "1-URGENT").alias("bonus_flag"),
        )

    @cached_property
    def cards(self) -> DataFrame:
        return self.read("part").select(
            F.col("p_partkey").alias("bin"),
            F.col("p_brand").alias("country"),
            F.col("p_type").alias("category"),
            F.when(F.col("p_size") <= 25, "CREDIT").otherwise("PREPAID").alias("card_type"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        key = F.col("c_custkey")
        return self.read("customer").select(
            key.alias("customer_id"),
            F.when(key % 2 == 0, "F").otherwise("O").alias("site"),
            F.date_add(F.lit("1995-01-01").cast("date"), (key % 1500).cast("int")).alias("registered"),
            F.date_add(F.lit("2023-11-15").cast("date"), (key % 75).cast("int")).alias("joined"),
            F.when(F.col("c_acctbal") < 0, "inactive").otherwise("active").alias("status"),
            F.col("c_name").alias("nickname"),
            F.col("c_mktsegment").alias("segment"),
            F.col("c_acctbal").cast("decimal(18,2)").alias("balance"),
            F.col("c_nationkey").alias("nation_id"),
        )

    @cached_property
    def events(self) -> DataFrame:
        """Tracking rows with the JSON payload opened."""
        user = F.col("user_id")
        return self.read("events").select(
            "event_id",
            F.col("user_id").alias("customer_id"),
            F.when(user % 2 == 0, "F").otherwise("O").alias("site"),
            "ts",
            F.col("ts").cast("date").alias("day"),
            "event_type",
            F.col("value").cast("decimal(18,2)").alias("value"),
            F.get_json_object("props", "$.k").try_cast("int").alias("k"),
            "props",
        )

    @cached_property
    def visits(self) -> DataFrame:
        """One row per customer and day with item counters and prices."""

        def of(kind: str) -> Column:
            return F.count(F.when(F.col("event_type") == kind, 1))

        return self.events.groupBy("customer_id", "site", F.col("day").alias("log_date")).agg(
            F.count_distinct("k").alias("category_count"),
            of("view").alias("view_android"),
            of("click").alias("view_ios"),
            of("error").alias("view_desktop"),
            of("signup").alias("view_web"),
            of("purchase").alias("buy_intention"),
            F.count(F.when(F.col("k") < 10, 1)).alias("question"),
            F.count(F.when(F.col("value") > 30, 1)).alias("checkout"),
            F.count(F.when(F.col("value").between(10, 30), 1)).alias("add_to_cart"),
            F.count(F.when(F.col("k") >= 90, 1)).alias("bookmark"),
            F.min("value").alias("min_price"),
            F.max("value").alias("max_price"),
            (F.sum("value").cast("double") / F.count("value")).alias("avg_price"),
        )

    @cached_property
    def pushes(self) -> DataFrame:
        kinds = {"error": "sent", "signup": "control", "view": "shown", "click": "open"}
        return self.events.where(F.col("event_type") != "purchase").select(
            "customer_id", "site", F.col("day").alias("sent_date"),
            labelled("event_type", kinds).alias("push_type"),
            F.when(F.col("k") < 50, "NEWBUYERS_A").otherwise("OTHER_B").alias("batch_id"),
            "event_id",
        )

    @cached_property
    def purchases(self) -> DataFrame:
        """Orders of the event world (dense in days, one site per customer)."""
        return self.events.where(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("order_id"),
            F.col("customer_id").alias("buyer_id"),
            "site",
            F.col("day").alias("created"),
            F.date_add("day", (F.col("event_id") % 7).cast("int")).alias("closed"),
            F.when(F.col("k") < 90, "paid").otherwise("cancelled").alias("status"),
            F.col("value").alias("amount"),
            F.col("k").alias("category_id"),
        )

    @cached_property
    def installs(self) -> DataFrame:
        return self.events.where(F.col("event_type") == "signup").select(
            "customer_id", "site", F.col("day").alias("install_date"),
            F.when(F.col("k") < 50, "A").otherwise("B").alias("app"),
            F.when(F.col("k") % 3 == 0, "ios").otherwise("android").alias("os_name"),
        )

    @cached_property
    def app_devices(self) -> DataFrame:
        return self.events.where(F.col("event_type") == "click").select(
            "customer_id", "site", F.col("day").alias("created"),
            F.when(F.col("k") % 3 == 0, "ios").otherwise("android").alias("platform"),
            F.when(F.col("k") < 80, "ACTIVE").otherwise("REMOVED").alias("status"),
            F.when(F.col("k") < 50, "A").otherwise("B").alias("app"),
        )

    @cached_property
    def wallet(self) -> DataFrame:
        """Payments of the event world."""
        k = F.col("k")
        return self.events.where(F.col("event_type").isin("purchase", "click")).select(
            F.col("event_id").alias("payment_id"),
            F.col("customer_id").alias("buyer_id"),
            "site",
            F.col("day").alias("move_date"),
            F.col("value").alias("amount"),
            F.when(k < 25, "Account Fund").when(k < 50, "Wallet").when(k < 75, "Aggregator")
            .when(k < 90, "Point").otherwise("Point Device Sale").alias("segment"),
            F.when(k < 95, "approved").otherwise("rejected").alias("status"),
        )

    @cached_property
    def coupons(self) -> DataFrame:
        return self.events.where((F.col("event_type") == "purchase") & (F.col("k") < 60)).select(
            F.col("event_id").alias("payment_id"),
            F.col("customer_id").alias("buyer_id"),
            (F.col("k") % 8).alias("campaign_id"),
            ((F.col("k") % 4 + 1) * 5).cast("decimal(18,2)").alias("coupon_amount"),
        )

    @cached_property
    def tools(self) -> DataFrame:
        """Coupon campaigns with their budget, one per nation."""
        key = F.col("n_nationkey")
        return self.read("nation").select(
            key.cast("string").alias("tool_id"),
            F.when(key % 2 == 0, "F").otherwise("O").alias("site"),
            F.concat(F.when(key < 6, "Churn Cupon ").otherwise("Other "), "n_name").alias("name"),
            F.date_add(F.lit("2023-09-01").cast("date"), key * 5).alias("started"),
            (key * 100 + 500).cast("long").alias("budget"),
        )
