"""What a customer paid before a send, by hand."""

import datetime as dt

from pyspark.sql import functions as F

from tallyloom.operators import push


def test_payments_are_of_five_segments_and_count_once(spark):
    day = dt.date(2024, 1, 20)
    back = spark.createDataFrame([(1, "O", day)], "customer_id long, site string, sent_date date")
    people = spark.createDataFrame([(1, "O", day)], "customer_id long, site string, joined date")
    numbers = ["view_android", "view_ios", "view_desktop", "view_web", "category_count", "buy_intention", "question", "checkout", "add_to_cart", "bookmark"]
    visits = spark.createDataFrame([], "customer_id long, site string, log_date date, avg_price double, min_price double, max_price double, " + ", ".join(f"{n} long" for n in numbers))
    installs = spark.createDataFrame([], "customer_id long, site string, install_date date, os_name string, app string")
    pays = spark.createDataFrame([
        (1, "O", 10, day - dt.timedelta(days=3), 5.0, "Wallet", "approved"),
        (1, "O", 10, day - dt.timedelta(days=2), 6.0, "Wallet", "approved"),  # the same payment, recorded again
        (1, "O", 11, day - dt.timedelta(days=90), 7.0, "Aggregator", "approved"),
        (1, "O", 12, day - dt.timedelta(days=5), 100.0, "Lending", "approved"),  # a sixth segment
        (1, "O", 13, day - dt.timedelta(days=5), 100.0, "Wallet", "rejected"),
        (1, "O", 14, day - dt.timedelta(days=91), 100.0, "Wallet", "approved"),
        (1, "O", 15, day, 100.0, "Wallet", "approved"),
        (1, "F", 16, day - dt.timedelta(days=5), 100.0, "Point", "approved"),  # another site
        (1, "O", 17, day - dt.timedelta(days=5), 2.0, "Point", "approved"),
    ], "buyer_id long, site string, payment_id long, move_date date, amount double, segment string, status string")
    row = push.push_behaviour(back, visits, people, installs, pays).select(*[F.col(f"pay_{n}") for n in ("total", "wallet", "aggregator", "n")]).first()
    assert tuple(row) == (15.0, 6.0, 7.0, 3)
