"""Queries of the relational core: sources, filters, joins, aggregates, windows, sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyloom.functions import arrays, dates, text
from tallyloom.functions.columns import count_when, date_lit, day_number, ratio, rounded
from tallyloom.operators import aggregates as ag
from tallyloom.operators import joins as jn
from tallyloom.operators import orders as od
from tallyloom.operators import ranking as rk
from tallyloom.plans.registry import query
from tallyloom.session import shared_folder
from tallyloom.sources import files, keyed

# ------------------------------------------------------------ sources, sinks, tables

ORDER_COLUMNS = ["order_id", "buyer_id", "status", "amount", "created", "channel", "status_code"]


@query("src_parquet", "SELECT order_id, buyer_id, amount::DOUBLE AS amount FROM r_orders WHERE created >= DATE '2000-01-01' AND status_code = 'F'")
def _(t):
    rows = files.read_parquet(t.spark, t.path("orders"), "o_orderdate >= '2000-01-01' AND o_orderstatus = 'F'")
    return rows.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("buyer_id"), F.col("o_totalprice").alias("amount")
    )


_BY_CHANNEL = "SELECT channel, count(*) AS n, sum(amount)::DOUBLE AS amount FROM r_orders GROUP BY 1"


@query("src_csv", _BY_CHANNEL)
def _(t):
    folder = shared_folder(t.spark, "orders-csv")
    files.write_delimited(t.orders.select("order_id", "channel", "amount"), folder)
    back = files.read_delimited(t.spark, folder, "order_id long, channel string, amount decimal(18,2)")
    return back.groupBy("channel").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


@query("src_csv_concat", _BY_CHANNEL)
def _(t):
    first, second = shared_folder(t.spark, "part1"), shared_folder(t.spark, "part2")
    rows = t.orders.select("order_id", "channel", "amount")
    files.write_delimited(rows.where("channel < '3'"), first)
    files.write_delimited(rows.where("channel >= '3'"), second)
    back = files.read_concatenated(t.spark, [first, second], "a long, b string, c decimal(18,2)", ["order_id", "channel", "amount"])
    return back.groupBy("channel").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


@query("src_query", "SELECT channel, count(*) AS n FROM r_orders WHERE amount > 100000 GROUP BY 1")
def _(t):
    return files.run_sql(
        t.spark, "SELECT channel, count(*) AS n FROM {o} WHERE amount > :low GROUP BY channel", {"low": 100000}, o=t.orders
    )


_NAMED = files.NamedQueries(
    {
        "daily": "SELECT created, count(*) AS n FROM {o} WHERE created BETWEEN :from AND :to AND status = :status GROUP BY created",
        "buyers": "SELECT DISTINCT buyer_id FROM {o}",
    }
)


@query("src_named_query", "SELECT created::VARCHAR AS created, count(*) AS n FROM r_orders WHERE created BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' AND status = 'paid' GROUP BY 1")
def _(t):
    args = {"from": dt.date(1998, 1, 1), "to": dt.date(1998, 12, 31), "status": "paid"}
    return _NAMED.run(t.spark, "daily", args, o=t.orders)


_ROUND_TRIP = "SELECT order_id, buyer_id, channel, amount::DOUBLE AS amount FROM r_orders"


@query("sink_parquet", _ROUND_TRIP)
def _(t):
    folder = shared_folder(t.spark, "export")
    files.write_parquet(t.orders.select("order_id", "buyer_id", "channel", "amount"), folder)
    return files.read_parquet(t.spark, folder)


@query("sink_csv", _ROUND_TRIP)
def _(t):
    folder = shared_folder(t.spark, "export")
    files.write_delimited(t.orders.select("order_id", "buyer_id", "channel", "amount"), folder, sep=";")
    return files.read_delimited(t.spark, folder, "order_id long, buyer_id long, channel string, amount decimal(18,2)", sep=";")


@query("sink_typed_load", """
    SELECT customer_id AS "customer__id", nickname, round(balance, 1)::DOUBLE AS balance, registered::VARCHAR AS registered,
           TRY_CAST(nickname AS BIGINT) AS "bad__number" FROM r_customers""")
def _(t):
    raw = t.customers.select(
        F.col("customer_id").cast("string").alias("customer id"), "nickname", F.col("balance").cast("string").alias("balance"),
        F.col("registered").cast("string").alias("registered"), F.col("nickname").alias("bad number"),
    )
    return files.typed(raw, {"customer id": "integer", "nickname": "string", "balance": "decimal(1)", "registered": "date", "bad number": "integer"})


@query("tbl_ctas", "SELECT buyer_id, count(*) AS n FROM r_orders WHERE status = 'paid' GROUP BY 1")
def _(t):
    folder = shared_folder(t.spark, "ctas")
    files.write_parquet(t.orders.where("status = 'paid'").groupBy("buyer_id").agg(F.count("*").alias("n")), folder)
    return files.read_parquet(t.spark, folder)


@query("tbl_truncate_insert", "SELECT order_id, status FROM r_orders WHERE created >= DATE '2000-01-01'")
def _(t):
    return keyed.truncate_insert(t.orders.where("created >= DATE '2000-01-01'"), ["order_id", "status"])


def _history_and_batch(t):
    rows = t.orders.select("order_id", "channel", "created", "amount")
    history = rows.where("created < DATE '2000-06-01'")
    batch = rows.where("created >= DATE '2000-01-01'").withColumn("amount", F.col("amount") * 2)
    return history, batch


_HISTORY = """
    WITH history AS (SELECT order_id, channel, created, amount FROM r_orders WHERE created < DATE '2000-06-01'),
    batch AS (SELECT order_id, channel, created, amount * 2 AS amount FROM r_orders WHERE created >= DATE '2000-01-01')
"""


@query("tbl_replace_keys", _HISTORY + """
    SELECT order_id, channel, created::VARCHAR AS created, amount::DOUBLE AS amount FROM history h
    WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.order_id = h.order_id)
    UNION ALL SELECT order_id, channel, created::VARCHAR, amount::DOUBLE FROM batch""")
def _(t):
    history, batch = _history_and_batch(t)
    return keyed.replace_keys(history, batch, ["order_id"])


@query("tbl_append_absent", _HISTORY + """
    SELECT order_id, channel, created::VARCHAR AS created, amount::DOUBLE AS amount FROM history
    UNION ALL SELECT order_id, channel, created::VARCHAR, amount::DOUBLE FROM batch b
    WHERE NOT EXISTS (SELECT 1 FROM history h WHERE b.order_id = h.order_id)""")
def _(t):
    history, batch = _history_and_batch(t)
    return keyed.append_absent(history, batch, ["order_id"])


@query("tbl_extract_upsert", _HISTORY + """
    , marked AS (SELECT DISTINCT channel, created FROM batch)
    SELECT order_id, channel, created::VARCHAR AS created, amount::DOUBLE AS amount FROM history h
    LEFT JOIN marked m USING (channel, created) WHERE m.created IS NULL
    UNION ALL SELECT order_id, channel, created::VARCHAR, amount::DOUBLE FROM batch""")
def _(t):
    history, batch = _history_and_batch(t)
    return keyed.upsert_extract(history, batch, "channel", "created")


@query("tbl_update_by_key", _HISTORY + """
    SELECT order_id, COALESCE(h.channel, CAST(NULL AS VARCHAR)) AS channel, h.created::VARCHAR AS created,
           COALESCE(b.amount, h.amount)::DOUBLE AS amount
    FROM history h FULL JOIN batch b USING (order_id)""")
def _(t):
    history, batch = _history_and_batch(t)
    return keyed.update_by_key(history, batch, ["order_id"], ["amount"])


@query("tbl_latest_complete", """
    WITH f AS (SELECT created, CASE status_code WHEN 'F' THEN 'groups.bin' WHEN 'O' THEN 'rules.bin' ELSE 'columns.txt' END AS file FROM r_orders)
    SELECT max(created)::VARCHAR AS folder_date FROM
    (SELECT created FROM f GROUP BY 1 HAVING count(DISTINCT file) = 3)""")
def _(t):
    file = F.when(F.col("status_code") == "F", "groups.bin").when(F.col("status_code") == "O", "rules.bin").otherwise("columns.txt")
    paths = t.orders.select(F.concat(F.lit("store/models/"), F.col("created").cast("string"), F.lit("/"), file).alias("path"))
    return files.latest_complete(paths, ["groups.bin", "rules.bin", "columns.txt"])


# ------------------------------------------------------------ filters and projections


@query("flt_valid_orders", "SELECT buyer_id, order_id, line_no::BIGINT AS line_no, item_id, amount::DOUBLE AS amount, closed::VARCHAR AS closed FROM r_valid")
def _(t):
    return od.valid_orders(t.order_lines).select("buyer_id", "order_id", "line_no", "item_id", "amount", "closed")


@query("flt_closed_after_created", "SELECT order_id, created::VARCHAR AS created, closed::VARCHAR AS closed FROM r_purchases WHERE status = 'paid' AND closed BETWEEN created AND created + 4")
def _(t):
    return od.closed_in_time(t.purchases).select("order_id", "created", "closed")


@query("flt_in_list", "SELECT order_id FROM r_orders WHERE channel IN ('1-URGENT', '2-HIGH') AND buyer_id IN (SELECT customer_id FROM r_customers WHERE segment = 'MACHINERY')")
def _(t):
    machinery = t.customers.where("segment = 'MACHINERY'").select(F.col("customer_id").alias("buyer_id"))
    return t.orders.where(F.col("channel").isin("1-URGENT", "2-HIGH")).join(machinery, "buyer_id", "left_semi").select("order_id")


@query("flt_not_in", "SELECT order_id FROM r_orders WHERE channel NOT IN ('1-URGENT', '2-HIGH') AND buyer_id NOT IN (SELECT customer_id FROM r_customers WHERE segment = 'MACHINERY')")
def _(t):
    machinery = t.customers.where("segment = 'MACHINERY'").select(F.col("customer_id").alias("buyer_id"))
    return t.orders.where(~F.col("channel").isin("1-URGENT", "2-HIGH")).join(machinery, "buyer_id", "left_anti").select("order_id")


@query("flt_like", r"""SELECT event_id FROM r_pushes WHERE batch_id LIKE '%\_A' ESCAPE '\' AND push_type NOT LIKE 's%' AND push_type NOT LIKE '%x%'""")
def _(t):
    name = F.col("push_type")
    return t.pushes.where(F.col("batch_id").like(r"%\_A") & ~name.like("s%") & ~name.like("%x%")).select("event_id")


@query("flt_regex", "SELECT doc_id FROM documents WHERE regexp_matches(text, '(?i)license|copyright')")
def _(t):
    return t.read("documents").where(F.col("text").rlike("(?i)license|copyright")).select("doc_id")


@query("flt_null_safe", "SELECT shipment_id FROM r_shipments WHERE COALESCE(free_flag, 0) = 0")
def _(t):
    return t.shipments.where(F.coalesce("free_flag", F.lit(0)) == 0).select("shipment_id")


@query("prj_case", """
    SELECT order_id, CASE channel WHEN '1-URGENT' THEN 'fast' WHEN '2-HIGH' THEN 'fast' ELSE 'normal' END AS speed,
           (CASE WHEN amount > 300000 THEN 3 WHEN amount <= 100000 THEN 1 ELSE 2 END)::BIGINT AS band FROM r_orders""")
def _(t):
    return t.orders.select(
        "order_id",
        F.when(F.col("channel").isin("1-URGENT", "2-HIGH"), "fast").otherwise("normal").alias("speed"),
        F.when(F.col("amount") > 300000, 3).when(F.col("amount") <= 100000, 1).otherwise(2).alias("band"),
    )


@query("prj_star_except", "SELECT order_id, buyer_id, status, channel, status_code FROM r_orders")
def _(t):
    return t.orders.drop("amount", "created")


@query("prj_rename_prefix", "SELECT customer_id, log_date::VARCHAR AS log_date, view_ios AS NAV_view_ios, checkout AS NAV_checkout FROM r_visits")
def _(t):
    from tallyloom.operators.prepare import prefix_columns
    return prefix_columns(t.visits.select("customer_id", "log_date", "view_ios", "checkout"), "NAV", ["customer_id", "log_date"])


@query("prj_positional_names", "SELECT order_id AS id, buyer_id AS cust FROM r_orders")
def _(t):
    return t.orders.select("order_id", "buyer_id").toDF("id", "cust")


@query("prj_typed_split", "SELECT customer_id::VARCHAR AS customer_id, segment, balance::DOUBLE AS balance, nation_id::DOUBLE AS nation_id FROM r_customers")
def _(t):
    from tallyloom.operators.prepare import cast_by_type
    return cast_by_type(t.customers.select("customer_id", "segment", "balance", "nation_id"), categorical=["customer_id"])


@query("prj_remap", """
    SELECT event_id, CASE push_type WHEN 'sent' THEN 1::BIGINT WHEN 'control' THEN 0::BIGINT END AS w,
           CASE push_type WHEN 'shown' THEN 'seen' ELSE push_type END AS push_type FROM r_pushes""")
def _(t):
    from tallyloom.operators.prepare import remap
    return t.pushes.select("event_id", remap("push_type", {"sent": 1, "control": 0}).alias("w"), "push_type").replace({"shown": "seen"}, subset=["push_type"])


# ------------------------------------------------------------ joins


@query("jn_inner", "SELECT order_id, p.closed::VARCHAR AS closed, v.checkout FROM r_purchases p JOIN r_visits v ON v.customer_id = p.buyer_id AND v.site = p.site AND v.log_date = p.created")
def _(t):
    p, v = t.purchases, t.visits.select(F.col("customer_id").alias("buyer_id"), "site", F.col("log_date").alias("created"), "checkout")
    return p.join(v, ["buyer_id", "site", "created"]).select("order_id", "closed", "checkout")


@query("jn_left", "SELECT o.order_id, s.cart_id, s.picking FROM r_orders o LEFT JOIN r_shipments s ON s.shipment_id = o.order_id AND s.kind = 'forward' AND s.shipped BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'")
def _(t):
    s = t.shipments.where("kind = 'forward' AND shipped BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'")
    return t.orders.join(s, t.orders.order_id == s.shipment_id, "left").select("order_id", "cart_id", "picking")


_SEND_DAYS = "SELECT DISTINCT customer_id, sent_date FROM r_pushes WHERE push_type IN ('sent', 'control') AND batch_id LIKE 'NEWBUYERS%'"


def _sends(t):
    return t.pushes.where(F.col("push_type").isin("sent", "control") & F.col("batch_id").like("NEWBUYERS%")).select("customer_id", "sent_date").distinct()


@query("jn_left_range", f"""
    WITH bk AS ({_SEND_DAYS})
    SELECT bk.customer_id, bk.sent_date::VARCHAR AS sent_date, count(v.log_date) AS days, COALESCE(sum(v.checkout), 0)::BIGINT AS checkouts
    FROM bk LEFT JOIN r_visits v ON v.customer_id = bk.customer_id AND v.log_date BETWEEN bk.sent_date - 7 AND bk.sent_date - 1
    GROUP BY 1, 2""")
def _(t):
    from tallyloom.operators.trailing import Trailing, attach_trailing
    return attach_trailing(
        _sends(t), t.visits.groupBy("customer_id", "log_date").agg(F.sum("checkout").alias("checkout")), "customer_id", "sent_date", "log_date",
        {"days": Trailing("count", -7, -1), "checkouts": Trailing("sum", -7, -1, "checkout")},
    ).na.fill(0, ["checkouts"])


@query("jn_inner_range", f"""
    WITH bk AS ({_SEND_DAYS})
    SELECT bk.customer_id, bk.sent_date::VARCHAR AS sent_date, count(*) AS days FROM bk
    JOIN r_visits v ON v.customer_id = bk.customer_id AND v.log_date BETWEEN bk.sent_date AND bk.sent_date + 3
    GROUP BY 1, 2""")
def _(t):
    from tallyloom.operators.trailing import Trailing, attach_trailing
    days = t.visits.select("customer_id", "log_date")
    return attach_trailing(_sends(t), days, "customer_id", "sent_date", "log_date", {"days": Trailing("count", 0, 3)}).where("days > 0")


@query("jn_full_outer", """
    WITH a AS (SELECT buyer_id, count(*) AS n_old FROM r_orders WHERE created < DATE '1996-01-01' GROUP BY 1),
    b AS (SELECT buyer_id, count(*) AS n_new FROM r_orders WHERE created >= DATE '2001-01-01' GROUP BY 1)
    SELECT buyer_id, COALESCE(n_old, 0) AS n_old, COALESCE(n_new, 0) AS n_new FROM a FULL JOIN b USING (buyer_id)""")
def _(t):
    a = t.orders.where("created < DATE '1996-01-01'").groupBy("buyer_id").agg(F.count("*").alias("n_old"))
    b = t.orders.where("created >= DATE '2001-01-01'").groupBy("buyer_id").agg(F.count("*").alias("n_new"))
    return a.join(b, "buyer_id", "full").na.fill(0)


@query("jn_semi", "SELECT order_id FROM r_orders o WHERE EXISTS (SELECT 1 FROM r_population p WHERE p.customer_id = o.buyer_id)")
def _(t):
    population = od.population(od.valid_orders(t.order_lines)).withColumnRenamed("customer_id", "buyer_id")
    return t.orders.join(population, "buyer_id", "left_semi").select("order_id")


@query("jn_anti", "SELECT customer_id FROM r_customers c WHERE status = 'active' AND NOT EXISTS (SELECT 1 FROM r_orders o WHERE o.buyer_id = c.customer_id AND o.created BETWEEN DATE '2001-01-01' AND DATE '2001-03-31')")
def _(t):
    recent = t.orders.where("created BETWEEN DATE '2001-01-01' AND DATE '2001-03-31'").select(F.col("buyer_id").alias("customer_id"))
    return t.customers.where("status = 'active'").join(recent, "customer_id", "left_anti").select("customer_id")


@query("jn_master", """
    SELECT p.customer_id, d.days, c.segment FROM r_population p
    LEFT JOIN (SELECT customer_id, count(*) AS days FROM r_daily WHERE day >= DATE '1998-10-02' GROUP BY 1) d USING (customer_id)
    LEFT JOIN r_customers c USING (customer_id)""")
def _(t):
    valid = od.valid_orders(t.order_lines)
    recent = od.daily_orders(valid).where("day >= DATE '1998-10-02'").groupBy("customer_id").agg(F.count("*").alias("days"))
    return jn.join_blocks(od.population(valid), [recent, t.customers.select("customer_id", "segment")], ["customer_id"])


@query("jn_validated", "SELECT customer_id, segment, balance::DOUBLE AS balance FROM r_customers")
def _(t):
    return jn.join_one_to_one(t.customers.select("customer_id", "segment"), t.customers.select("customer_id", "balance"), ["customer_id"])


@query("jn_index_concat", """
    SELECT COALESCE(a.buyer_id, b.buyer_id) AS buyer_id, a.n AS n_f, b.n AS n_o FROM (SELECT buyer_id, count(*) n FROM r_orders WHERE status_code = 'F' GROUP BY 1) a
    FULL JOIN (SELECT buyer_id, count(*) n FROM r_orders WHERE status_code = 'O' GROUP BY 1) b ON a.buyer_id = b.buyer_id""")
def _(t):
    a = t.orders.where("status_code = 'F'").groupBy("buyer_id").agg(F.count("*").alias("n_f"))
    b = t.orders.where("status_code = 'O'").groupBy("buyer_id").agg(F.count("*").alias("n_o"))
    return jn.bind_columns(a, b, ["buyer_id"])


@query("jn_dim_lookup", "SELECT order_id, device_kind, device_app FROM r_orders o LEFT JOIN r_devices d ON COALESCE(d.channel, '-1') = o.channel")
def _(t):
    devices = t.devices.withColumn("channel", F.coalesce("channel", F.lit("-1")))
    return t.orders.join(devices, "channel", "left").select("order_id", "device_kind", "device_app")


@query("jn_threshold", """
    SELECT customer_id, c.site, balance::DOUBLE AS balance FROM r_customers c JOIN (VALUES ('F', 5000.0), ('O', 7000.0)) AS l(site, threshold) ON l.site = c.site
    WHERE balance >= threshold""")
def _(t):
    return jn.above_threshold(t.customers, {"F": 5000.0, "O": 7000.0}, "site", "balance").select("customer_id", "site", "balance")


@query("jn_latest_snapshot", """
    SELECT customer_id, v.site, v.checkout FROM r_visits v JOIN (SELECT site, max(log_date) AS log_date FROM r_visits GROUP BY 1) m
    ON m.site = v.site AND m.log_date = v.log_date""")
def _(t):
    return jn.latest_snapshot(t.visits, "log_date", ["site"]).select("customer_id", "site", "checkout")


@query("jn_coalesce_sources", """
    SELECT c.customer_id, COALESCE(a.os, b.os) AS os FROM r_customers c
    LEFT JOIN (SELECT customer_id, min(os_name) AS os FROM r_installs WHERE app = 'B' GROUP BY 1) a USING (customer_id)
    LEFT JOIN (SELECT customer_id, min(platform) AS os FROM r_app_devices GROUP BY 1) b USING (customer_id)""")
def _(t):
    a = t.installs.where("app = 'B'").groupBy("customer_id").agg(F.min("os_name").alias("os"))
    b = t.app_devices.groupBy("customer_id").agg(F.min("platform").alias("os"))
    return jn.first_source(t.customers.select("customer_id"), a, b, "customer_id", "os")


# ------------------------------------------------------------ aggregates


@query("agg_basic", """
    SELECT channel, count(*) AS n, sum(amount)::DOUBLE AS total, round(sum(amount)::DOUBLE / count(*), 6) AS mean,
           min(amount)::DOUBLE AS low, max(amount)::DOUBLE AS high, round(stddev_samp(amount::DOUBLE), 4) AS std
    FROM r_orders GROUP BY 1""")
def _(t):
    a = F.col("amount")
    return t.orders.groupBy("channel").agg(
        F.count("*").alias("n"), F.sum(a).alias("total"), rounded(F.sum(a).cast("double") / F.count(a)).alias("mean"),
        F.min(a).alias("low"), F.max(a).alias("high"), rounded(F.stddev_samp(a.cast("double")), 4).alias("std"),
    )


@query("agg_distinct", "SELECT seller_id, count(DISTINCT buyer_id) AS buyers, count(DISTINCT created) AS days, count(DISTINCT CASE WHEN amount > 5000 THEN order_id END) AS big_orders FROM r_lines GROUP BY 1")
def _(t):
    return t.order_lines.groupBy("seller_id").agg(
        F.count_distinct("buyer_id").alias("buyers"), F.count_distinct("created").alias("days"),
        F.count_distinct(F.when(F.col("amount") > 5000, F.col("order_id"))).alias("big_orders"),
    )


@query("agg_conditional", """
    SELECT buyer_id, sum(CASE WHEN item_condition = 'new' THEN 1 ELSE 0 END)::BIGINT AS new_items, count(CASE WHEN grocery THEN 1 END) AS groceries,
           max(CASE WHEN channel = '1-URGENT' THEN created END)::VARCHAR AS last_urgent, min(CASE WHEN bonus THEN amount END)::DOUBLE AS min_bonus FROM r_lines GROUP BY 1""")
def _(t):
    return t.order_lines.groupBy("buyer_id").agg(
        F.sum(F.when(F.col("item_condition") == "new", 1).otherwise(0)).alias("new_items"), count_when(F.col("grocery")).alias("groceries"),
        F.max(F.when(F.col("channel") == "1-URGENT", F.col("created"))).alias("last_urgent"), F.min(F.when(F.col("bonus"), F.col("amount"))).alias("min_bonus"),
    )


@query("agg_window_grid", """
    SELECT customer_id, sum(view_ios)::BIGINT AS views, max(max_price)::DOUBLE AS price, count(DISTINCT log_date) AS days,
           sum(CASE WHEN log_date >= DATE '2024-01-24' THEN view_ios END)::BIGINT AS views_7D, max(CASE WHEN log_date >= DATE '2024-01-24' THEN max_price END)::DOUBLE AS price_7D,
           count(DISTINCT CASE WHEN log_date >= DATE '2024-01-24' THEN log_date END) AS days_7D,
           sum(CASE WHEN log_date <= DATE '2024-01-08' THEN view_ios END)::BIGINT AS views_F7D, max(CASE WHEN log_date <= DATE '2024-01-08' THEN max_price END)::DOUBLE AS price_F7D,
           count(DISTINCT CASE WHEN log_date <= DATE '2024-01-08' THEN log_date END) AS days_F7D FROM r_visits GROUP BY 1""")
def _(t):
    day = F.col("log_date")
    grid = ag.window_grid(
        {"views": ("sum", F.col("view_ios")), "price": ("max", F.col("max_price")), "days": ("distinct", day)},
        {"": None, "_7D": day >= date_lit("2024-01-24"), "_F7D": day <= date_lit("2024-01-08")},
    )
    return t.visits.groupBy("customer_id").agg(*grid)


@query("agg_two_level", "SELECT customer_id, count(*) AS days, round(avg(sales::DOUBLE), 6) AS mean_day_sales FROM r_daily GROUP BY 1")
def _(t):
    daily = od.daily_orders(od.valid_orders(t.order_lines))
    return daily.groupBy("customer_id").agg(F.count("*").alias("days"), rounded(F.avg(F.col("sales").cast("double"))).alias("mean_day_sales"))


@query("agg_capped", "SELECT buyer_id, sum(least(amount, 400))::DOUBLE AS capped, round(sum(least(amount, 400))::DOUBLE / count(*), 6) AS capped_mean FROM r_lines GROUP BY 1")
def _(t):
    capped = F.least(F.col("amount"), F.lit(400).cast("decimal(18,3)"))
    return t.order_lines.groupBy("buyer_id").agg(F.sum(capped).alias("capped"), rounded(ratio(F.sum(capped), F.count("*"))).alias("capped_mean"))


@query("agg_ratio_safe", "SELECT customer_id, round(sum(checkout)::DOUBLE / nullif(sum(bookmark), 0), 6) AS per_bookmark FROM r_visits GROUP BY 1")
def _(t):
    return t.visits.groupBy("customer_id").agg(rounded(ratio(F.sum("checkout"), F.sum("bookmark"))).alias("per_bookmark"))


@query("agg_having", "SELECT buyer_id, count(*) AS n FROM r_orders GROUP BY 1 HAVING count(*) > 10")
def _(t):
    return t.orders.groupBy("buyer_id").agg(F.count("*").alias("n")).where("n > 10")


@query("agg_argmax_band", "SELECT country, max(CASE WHEN category IN ('SMALL', 'STANDARD') THEN 1 WHEN category = 'ECONOMY' THEN 2 WHEN category IN ('PROMO', 'LARGE') THEN 3 ELSE 0 END)::BIGINT AS level FROM r_cards GROUP BY 1")
def _(t):
    c = F.col("category")
    level = F.when(c.isin("SMALL", "STANDARD"), 1).when(c == "ECONOMY", 2).when(c.isin("PROMO", "LARGE"), 3).otherwise(0)
    return t.cards.groupBy("country").agg(F.max(level).alias("level"))


@query("agg_greatest_label", """
    WITH c AS (SELECT customer_id, sum(view_android) a, sum(view_ios) b, sum(view_desktop) c FROM r_visits GROUP BY 1)
    SELECT customer_id, CASE greatest(a, b, c) WHEN a THEN 'view_android' WHEN b THEN 'view_ios' WHEN c THEN 'view_desktop' END AS main FROM c""")
def _(t):
    names = ["view_android", "view_ios", "view_desktop"]
    return t.visits.groupBy("customer_id").agg(*[F.sum(n).alias(n) for n in names]).select("customer_id", ag.greatest_label(names).alias("main"))


@query("agg_capped_array", """
    WITH n AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY ts DESC, event_id DESC) AS rn FROM r_events)
    SELECT customer_id, string_agg(event_type, ',' ORDER BY rn DESC) AS kinds, string_agg(k::VARCHAR, ',' ORDER BY rn DESC) AS ks, count(*) AS n FROM n WHERE rn <= 53 GROUP BY 1""")
def _(t):
    rows = ag.newest_array(t.events, ["customer_id"], [F.col("ts").desc(), F.col("event_id").desc()], ["event_type", "k"], 53, "recent")
    return rows.select("customer_id", arrays.field("recent", "event_type").alias("kinds"), arrays.field("recent", "k").alias("ks"), F.size("recent").cast("long").alias("n"))


@query("agg_freq_table", "SELECT segment, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM r_customers), 6) AS share FROM r_customers GROUP BY 1")
def _(t):
    return ag.frequency_table(t.customers, ["segment"]).withColumn("share", rounded("share"))


@query("agg_pivot", """
    SELECT sent_date::VARCHAR AS sent_date, count(*) FILTER (push_type = 'sent') AS sent, count(*) FILTER (push_type = 'shown') AS shown, count(*) FILTER (push_type = 'open') AS open FROM r_pushes GROUP BY 1""")
def _(t):
    return t.pushes.groupBy("sent_date").pivot("push_type", ["sent", "shown", "open"]).agg(F.count(F.lit(1))).na.fill(0)


@query("agg_crosstab_norm", """
    WITH c AS (SELECT channel, status_code, count(*) n FROM r_orders GROUP BY 1, 2), s AS (SELECT *, n::DOUBLE / sum(n) OVER (PARTITION BY status_code) AS share FROM c)
    SELECT channel, round(max(CASE WHEN status_code = 'F' THEN share END), 6) AS F, round(max(CASE WHEN status_code = 'O' THEN share END), 6) AS O, round(max(CASE WHEN status_code = 'P' THEN share END), 6) AS P FROM s GROUP BY 1""")
def _(t):
    shares = ag.crosstab_share(t.orders, "channel", "status_code", ["F", "O", "P"])
    return shares.select("channel", *[rounded(c).alias(c) for c in "FOP"])


@query("agg_confusion", """
    WITH p AS (SELECT quality, CASE WHEN n_chars > 800 THEN 1 ELSE 0 END AS predicted FROM labels JOIN documents USING (doc_id))
    SELECT quality::BIGINT AS actual, predicted::BIGINT AS predicted, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY quality), 6) AS share FROM p GROUP BY 1, 2, quality""")
def _(t):
    rows = t.read("labels").join(t.read("documents").select("doc_id", "n_chars"), "doc_id").select(F.col("quality").alias("actual"), (F.col("n_chars") > 800).cast("int").alias("predicted"))
    return ag.confusion(rows, "actual", "predicted").withColumn("share", rounded("share"))


@query("agg_corr_matrix", """
    WITH c AS (SELECT corr(l_quantity, l_extendedprice) qe, corr(l_quantity, l_discount) qd, corr(l_extendedprice, l_discount) ed FROM lineitem)
    SELECT 'l_quantity' AS "left", 'l_quantity' AS "right", 1.0::DOUBLE AS corr FROM c UNION ALL SELECT 'l_extendedprice', 'l_extendedprice', 1.0 FROM c UNION ALL SELECT 'l_discount', 'l_discount', 1.0 FROM c
    UNION ALL SELECT 'l_quantity', 'l_extendedprice', round(qe, 6) FROM c UNION ALL SELECT 'l_extendedprice', 'l_quantity', round(qe, 6) FROM c
    UNION ALL SELECT 'l_quantity', 'l_discount', round(qd, 6) FROM c UNION ALL SELECT 'l_discount', 'l_quantity', round(qd, 6) FROM c
    UNION ALL SELECT 'l_extendedprice', 'l_discount', round(ed, 6) FROM c UNION ALL SELECT 'l_discount', 'l_extendedprice', round(ed, 6) FROM c""")
def _(t):
    return ag.correlation_matrix(t.read("lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]).withColumn("corr", rounded("corr"))


@query("agg_null_report", """
    WITH x AS (SELECT o.order_id, s.cart_id, s.free_flag FROM r_orders o LEFT JOIN r_shipments s ON s.shipment_id = o.order_id)
    SELECT 'cart_id' AS "column", round(avg(CASE WHEN cart_id IS NULL THEN 1.0 ELSE 0 END)::DOUBLE, 6) AS null_share FROM x
    UNION ALL SELECT 'free_flag', round(avg(CASE WHEN free_flag IS NULL THEN 1.0 ELSE 0 END)::DOUBLE, 6) FROM x""")
def _(t):
    wide = t.orders.join(t.shipments, t.orders.order_id == t.shipments.shipment_id, "left").select("order_id", "cart_id", "free_flag")
    return ag.null_report(wide).withColumn("null_share", rounded("null_share"))


@query("agg_category_share", """
    SELECT buyer_id, """ + ", ".join(f"round(count(*) FILTER (item_condition = '{v}')::DOUBLE / count(*), 6) AS c_{v}" for v in ["new", "unknown", "used"]) + " FROM r_lines GROUP BY 1")
def _(t):
    shares = ag.category_share(t.order_lines.select("buyer_id", "item_condition"), "buyer_id", "item_condition")
    return shares.select("buyer_id", *[rounded(c).alias(c) for c in shares.columns[1:]])


# ------------------------------------------------------------ windows


@query("win_row_number_top1", "SELECT buyer_id, order_id, amount::DOUBLE AS amount FROM (SELECT *, row_number() OVER (PARTITION BY buyer_id ORDER BY amount DESC, order_id) rn FROM r_orders) WHERE rn = 1")
def _(t):
    return ag.first_row(t.orders.select("buyer_id", "order_id", "amount"), ["buyer_id"], [-F.col("amount"), "order_id"])


@query("win_rank_top", "SELECT buyer_id, order_id, line_no::BIGINT AS line_no, items FROM (SELECT *, rank() OVER (PARTITION BY buyer_id ORDER BY items DESC) rk FROM r_lines) WHERE rk = 1")
def _(t):
    best = t.order_lines.groupBy("buyer_id").agg(F.max("items").alias("items"))
    return t.order_lines.join(best, ["buyer_id", "items"], "left_semi").select("buyer_id", "order_id", "line_no", "items")


@query("win_lag_diff", "SELECT customer_id, day::VARCHAR AS day, (day - lag(day) OVER (PARTITION BY customer_id ORDER BY day))::BIGINT AS gap FROM r_daily")
def _(t):
    daily = od.daily_orders(od.valid_orders(t.order_lines))
    previous = F.lag("day").over(Window.partitionBy("customer_id").orderBy("day"))
    return daily.select("customer_id", "day", F.datediff("day", previous).alias("gap"))


@query("win_first_value", """
    WITH c AS (SELECT move_date, segment, count(*) AS n FROM r_wallet GROUP BY 1, 2)
    SELECT move_date::VARCHAR AS move_date, segment, n, first_value(segment) OVER (PARTITION BY move_date ORDER BY n DESC, segment) AS most_used FROM c""")
def _(t):
    counts = t.wallet.groupBy("move_date", "segment").agg(F.count("*").alias("n"))
    place = Window.partitionBy("move_date").orderBy(F.desc("n"), "segment")
    return counts.withColumn("most_used", F.first("segment").over(place))


@query("win_cumsum", "SELECT day::VARCHAR AS day, n, sum(n) OVER (ORDER BY day)::BIGINT AS running FROM (SELECT day, count(*) AS n FROM r_events GROUP BY 1)")
def _(t):
    daily = t.events.groupBy("day").agg(F.count("*").alias("n"))
    return rk.running_totals(daily, day_number("day"), F.lit(0), {"running": F.col("n")}).select("day", "n", "running")


@query("win_global_rank_cut", "SELECT order_id, CASE WHEN row_number() OVER (ORDER BY amount DESC, order_id) <= 500 THEN 'selected' ELSE 'rest' END AS label FROM r_orders")
def _(t):
    return rk.label_top_n(t.orders.select("order_id", "amount"), 500, "amount", "order_id").select("order_id", "label")


@query("win_pct_rank", """
    WITH r AS (SELECT order_id, free_flag, channel, rank() OVER (ORDER BY v NULLS LAST) rk, count(*) OVER (PARTITION BY v) ties, count(*) OVER () n
               FROM (SELECT o.order_id, s.free_flag, o.channel, s.cart_id AS v FROM r_orders o LEFT JOIN r_shipments s ON s.shipment_id = o.order_id))
    SELECT order_id, round((rk + (ties - 1) / 2.0) / n, 6)::DOUBLE AS pct FROM r""")
def _(t):
    rows = t.orders.join(t.shipments.select("shipment_id", "cart_id"), t.orders.order_id == F.col("shipment_id"), "left").select("order_id", "cart_id")
    return rk.percent_rank_average(rows, "cart_id", "pct").select("order_id", rounded("pct").alias("pct"))


@query("win_ffill", """
    WITH d AS (SELECT customer_id, log_date, CASE WHEN bookmark > 0 THEN max_price END AS price FROM r_visits)
    SELECT customer_id, log_date::VARCHAR AS log_date, last_value(price IGNORE NULLS) OVER (PARTITION BY customer_id ORDER BY log_date)::DOUBLE AS price FROM d""")
def _(t):
    price = F.when(F.col("bookmark") > 0, F.col("max_price"))
    upto = Window.partitionBy("customer_id").orderBy("log_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return t.visits.select("customer_id", "log_date", F.last(price, ignorenulls=True).over(upto).alias("price"))


@query("win_delta_rate", """
    SELECT customer_id, log_date::VARCHAR AS log_date, round((checkout - lag(checkout) OVER w)::DOUBLE / (log_date - lag(log_date) OVER w), 6) AS rate
    FROM r_visits WINDOW w AS (PARTITION BY customer_id ORDER BY log_date)""")
def _(t):
    w = Window.partitionBy("customer_id").orderBy("log_date")
    change = F.col("checkout") - F.lag("checkout").over(w)
    return t.visits.select("customer_id", "log_date", rounded(ratio(change, F.datediff("log_date", F.lag("log_date").over(w)))).alias("rate"))


@query("win_share", "SELECT sent_date::VARCHAR AS sent_date, push_type, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY sent_date), 6) AS share FROM r_pushes GROUP BY sent_date, push_type")
def _(t):
    counts = t.pushes.groupBy("sent_date", "push_type").agg(F.count("*").alias("n"))
    return counts.select("sent_date", "push_type", rounded(ratio("n", F.sum("n").over(Window.partitionBy("sent_date")))).alias("share"))


# ------------------------------------------------------------ sets


@query("set_union_all", """
    SELECT customer_id, min(d)::VARCHAR AS first_seen, count(*) AS n FROM
    (SELECT customer_id, install_date AS d FROM r_installs UNION ALL SELECT customer_id, created FROM r_app_devices WHERE status = 'ACTIVE') GROUP BY 1""")
def _(t):
    a = t.installs.select("customer_id", F.col("install_date").alias("d"))
    b = t.app_devices.where("status = 'ACTIVE'").select("customer_id", F.col("created").alias("d"))
    return a.unionByName(b).groupBy("customer_id").agg(F.min("d").alias("first_seen"), F.count("*").alias("n"))


@query("set_union_priority", """
    SELECT customer_id, max(g) AS g FROM (SELECT customer_id, 'TG' AS g FROM r_pushes WHERE push_type = 'open' AND batch_id LIKE 'OTHER%'
    UNION ALL SELECT customer_id, 'CG' FROM r_pushes WHERE push_type = 'control') GROUP BY 1""")
def _(t):
    opened = t.pushes.where("push_type = 'open' AND batch_id LIKE 'OTHER%'").select("customer_id", F.lit("TG").alias("g"))
    control = t.pushes.where("push_type = 'control'").select("customer_id", F.lit("CG").alias("g"))
    return opened.unionByName(control).groupBy("customer_id").agg(F.max("g").alias("g"))


@query("set_panel_union", " UNION ALL ".join(f"SELECT '{d}' AS ref_date, customer_id, count(*) AS days FROM r_daily WHERE day BETWEEN DATE '{d}' - 89 AND DATE '{d}' GROUP BY 2" for d in ["1998-06-30", "1998-09-30", "1998-12-31"]))
def _(t):
    daily = od.daily_orders(od.valid_orders(t.order_lines))
    cuts = [date_lit(d) for d in ["1998-06-30", "1998-09-30", "1998-12-31"]]
    seen = daily.withColumn("ref_date", F.explode(F.filter(F.array(*cuts), lambda d: F.col("day").between(F.date_sub(d, 89), d))))
    return seen.groupBy("ref_date", "customer_id").agg(F.count("*").alias("days"))


@query("set_distinct", "SELECT customer_id, log_date::VARCHAR AS log_date, event_type FROM (SELECT customer_id, day AS log_date, event_type, row_number() OVER (PARTITION BY customer_id, day ORDER BY ts, event_id) rn FROM r_events) WHERE rn = 1")
def _(t):
    rows = t.events.select("customer_id", F.col("day").alias("log_date"), "event_type", "ts", "event_id")
    return ag.first_row(rows, ["customer_id", "log_date"], ["ts", "event_id"]).select("customer_id", "log_date", "event_type")


@query("set_difference", """
    WITH a AS (SELECT DISTINCT buyer_id FROM r_orders WHERE created < DATE '1995-07-01'), b AS (SELECT DISTINCT buyer_id FROM r_orders WHERE created >= DATE '2001-01-01')
    SELECT buyer_id, 'early' AS source FROM a UNION ALL SELECT buyer_id, 'late' FROM b WHERE buyer_id NOT IN (SELECT buyer_id FROM a)""")
def _(t):
    early = t.orders.where("created < DATE '1995-07-01'").select("buyer_id").distinct()
    late = t.orders.where("created >= DATE '2001-01-01'").select("buyer_id").distinct()
    return early.withColumn("source", F.lit("early")).unionByName(late.join(early, "buyer_id", "left_anti").withColumn("source", F.lit("late")))
