"""Queries of samples, splits, segments and cleaning rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.config import FILL_RECENCY
from tallyloom.functions.columns import date_lit, rounded
from tallyloom.operators import joins as jn
from tallyloom.operators import orders as od
from tallyloom.operators import prepare as pp
from tallyloom.operators import ranking as rk
from tallyloom.operators import sampling as sm
from tallyloom.operators import segments as sg
from tallyloom.plans import campaigns, features
from tallyloom.plans.common import r6
from tallyloom.plans.registry import PARTS, query
from tallyloom.session import written


def hx(key: str, seed: str = "s") -> str:
    return f"('0x' || substr(md5('{seed}|' || {key}), 1, 8))::BIGINT"


# ------------------------------------------------------------ top-k, samples, splits


@query("top_order_limit", "SELECT order_id, amount::DOUBLE AS amount FROM r_orders ORDER BY amount DESC, order_id LIMIT 250")
def _(t):
    return rk.top_n(t.orders.select("order_id", "amount"), 250, F.desc("amount"), F.col("order_id"))


@query("smp_bernoulli", f"SELECT order_id FROM r_orders WHERE {hx('order_id')} / 4294967296.0::DOUBLE < least(1, 3000.0::DOUBLE / (SELECT count(*) FROM r_orders))")
def _(t):
    return sm.bernoulli(t.orders, "order_id", 3000).select("order_id")


@query("smp_fixed_n", f"SELECT order_id, channel FROM r_orders ORDER BY {hx('order_id')}, order_id LIMIT 1000")
def _(t):
    return sm.fixed_n(t.orders.select("order_id", "channel"), "order_id", 1000)


@query("smp_fraction_by_group", f"SELECT order_id, channel FROM r_orders WHERE {hx('order_id')} / 4294967296.0::DOUBLE < CASE channel WHEN '1-URGENT' THEN 0.5 WHEN '2-HIGH' THEN 0.1 ELSE 0 END::DOUBLE")
def _(t):
    return sm.fraction_by_group(t.orders, "channel", "order_id", {"1-URGENT": 0.5, "2-HIGH": 0.1}).select("order_id", "channel")


@query("smp_n_by_group", f"SELECT order_id, status_code FROM (SELECT *, row_number() OVER (PARTITION BY status_code ORDER BY {hx('order_id')}, order_id) rn FROM r_orders) WHERE rn <= 2000")
def _(t):
    return sm.n_by_group(t.orders, "status_code", "order_id", 2000).select("order_id", "status_code")


@query("split_train_test", f"""
    SELECT order_id, channel, CASE WHEN row_number() OVER (PARTITION BY channel ORDER BY {hx('order_id')}, order_id) <= floor(count(*) OVER (PARTITION BY channel) * 0.3::DOUBLE) THEN 'test' ELSE 'train' END AS split FROM r_orders""")
def _(t):
    return sm.train_test(t.orders, "order_id", 0.3, strata=["channel"]).select("order_id", "channel", "split")


@query("split_mod", "SELECT buyer_id, order_id, CASE WHEN buyer_id % 100 < 70 THEN 'train' WHEN buyer_id % 100 < 85 THEN 'valid' ELSE 'test' END AS split FROM r_orders")
def _(t):
    return sm.mod_split(t.orders, "buyer_id", 100, [("train", 70), ("valid", 85), ("test", 100)]).select("buyer_id", "order_id", "split")


@query("split_seed_proof", f"""
    WITH r AS (SELECT order_id, status_code = 'F' AS p, row_number() OVER (PARTITION BY status_code = 'F' ORDER BY {hx('order_id')}, order_id) rn, count(*) OVER (PARTITION BY status_code = 'F') n FROM r_orders)
    SELECT order_id, CASE WHEN NOT p THEN 'others' WHEN rn <= floor(n * 0.2::DOUBLE) THEN 'seeds' WHEN rn <= floor(n * 0.2::DOUBLE) + floor(n * 0.3::DOUBLE) THEN 'proof' ELSE 'others' END AS "set" FROM r""")
def _(t):
    rows = t.orders.select("order_id", (F.col("status_code") == "F").cast("int").alias("target"))
    return sm.seed_proof_split(rows, "order_id", "target", 0.2, 0.3).select("order_id", "set")


@query("smp_balance_under", f"""
    WITH r AS (SELECT order_id, channel, row_number() OVER (PARTITION BY channel ORDER BY {hx('order_id')}, order_id) rn FROM r_orders)
    SELECT order_id, channel FROM r WHERE rn <= (SELECT min(n) FROM (SELECT count(*) n FROM r_orders GROUP BY channel))""")
def _(t):
    return sm.balance_under(t.orders, "channel", "order_id").select("order_id", "channel")


@query("smp_balance_over", f"""
    WITH p AS (SELECT doc_id, quality FROM labels), r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {hx('doc_id')}, doc_id) rn, count(*) OVER (PARTITION BY quality) n FROM p),
    m AS (SELECT max(n) AS m FROM r), c AS (SELECT doc_id, quality, m // n + CASE WHEN rn <= m % n THEN 1 ELSE 0 END AS copies FROM r, m)
    SELECT doc_id, quality::BIGINT AS quality, unnest(range(1, copies + 1))::BIGINT AS copy FROM c""")
def _(t):
    return sm.balance_over(t.read("labels").select("doc_id", "quality"), "quality", "doc_id")


# ------------------------------------------------------------ segments


def _cuts(shares: list[float], order: str, tie: str) -> str:
    n, rn = "count(*) OVER ()", f"row_number() OVER (ORDER BY {order} DESC, {tie})"
    whens, total = "", "0"
    for i, s in enumerate(shares):
        total += f" + floor({n} * {s}::DOUBLE)"
        whens += f" WHEN {rn} <= {total} THEN 'q{i + 1}'"
    return f"CASE{whens} ELSE 'q{len(shares) + 1}' END"


for _n, _shares in [(4, sg.SHARES_4), (5, sg.SHARES_5), (6, sg.SHARES_6)]:

    @query(f"seg_quantile_{_n}", f"SELECT order_id, {_cuts(_shares, 'amount', 'order_id')} AS segment FROM r_orders")
    def _(t, shares=_shares):
        return sg.quantile_segments(t.orders, shares, "amount", "order_id").select("order_id", "segment")


def probabilities(t):
    rows = t.orders.select("order_id", *[sm.unit_hash("order_id", f"q{i}").alias(f"q{i}") for i in (1, 2, 3, 4, 6)])
    return rows


def _quota_sql() -> str:
    parts, free = [], "p"
    columns = ", ".join(f"{hx('order_id', f'q{i}')} / 4294967296.0::DOUBLE AS q{i}" for i in (1, 2, 3, 4, 6))
    text = f"WITH p AS (SELECT order_id, {columns} FROM r_orders)"
    for i in (1, 2, 3, 4, 6):
        share = 0.5 if i == 6 else 0.1
        text += f", s{i} AS (SELECT order_id, 'q{i}' AS segment FROM (SELECT order_id, row_number() OVER (ORDER BY q{i} DESC, order_id) rn FROM {free}) WHERE rn <= floor((SELECT count(*) FROM p) * {share}::DOUBLE)), f{i} AS (SELECT * FROM {free} WHERE order_id NOT IN (SELECT order_id FROM s{i}))"
        free = f"f{i}"
        parts.append(f"SELECT * FROM s{i}")
    return text + " " + " UNION ALL ".join(parts) + f" UNION ALL SELECT order_id, 'q5' FROM {free}"


@query("seg_argmax_quota", _quota_sql())
def _(t):
    return sg.quota_by_probability(probabilities(t), ["q1", "q2", "q3", "q4"], "q6", "order_id").select("order_id", "segment")


@query("seg_qcut", "SELECT order_id, ntile(10) OVER (ORDER BY amount, order_id) AS bucket FROM r_orders")
def _(t):
    return sg.qcut(t.orders, 10, "amount", "order_id").select("order_id", "bucket")


@query("seg_ab_split", f"""
    SELECT customer_id, CASE WHEN rn <= floor(n * 0.25::DOUBLE) THEN 'A' WHEN rn <= floor(n * 0.25::DOUBLE) + floor(n * 0.25::DOUBLE) THEN 'B' ELSE 'CG' END AS "group"
    FROM (SELECT customer_id, row_number() OVER (ORDER BY {hx('customer_id')}, customer_id) rn, count(*) OVER () n FROM r_customers)""")
def _(t):
    return sg.ab_split(t.customers, "customer_id", ["A", "B", "CG"], [0.25, 0.25, 0.5]).select("customer_id", "group")


CLUSTER_COLUMNS = ["freq_d_long", "first_in_window", "recency"]


def order_block(t):
    return od.orders_frequency(od.daily_orders(features.valid(t)), features.end())


@query("seg_kmeans")
def _(t):
    block = order_block(t).select("customer_id", *CLUSTER_COLUMNS)
    return sg.assign_clusters(sg.fit_clusters(block, CLUSTER_COLUMNS, 4), block)


@query("seg_kmeans_elbow")
def _(t):
    return sg.elbow(order_block(t), CLUSTER_COLUMNS, range(2, 8))


_AUDIENCE = """
    WITH snap AS (SELECT customer_id, checkout + bookmark AS score FROM r_visits WHERE log_date = (SELECT max(log_date) FROM r_visits)),
    seen AS (SELECT customer_id FROM r_pushes WHERE sent_date BETWEEN DATE '2024-01-26' - 7 AND DATE '2024-01-26' AND push_type = 'sent' AND batch_id LIKE 'OTHER%'),
    free AS (SELECT customer_id, score FROM snap WHERE customer_id NOT IN (SELECT customer_id FROM seen))"""


@query("aud_top_scored", f"{_AUDIENCE} SELECT customer_id, score FROM free ORDER BY score DESC, customer_id LIMIT 100")
def _(t):
    return audience(t)


def audience(t):
    snap = jn.latest_snapshot(t.visits, "log_date").select("customer_id", (F.col("checkout") + F.col("bookmark")).alias("score"))
    sent = t.pushes.where("push_type = 'sent' AND batch_id LIKE 'OTHER%'")
    free = jn.contacted_within(snap, sent, "customer_id", "sent_date", date_lit("2024-01-26"), 7)
    return rk.top_n(free, 100, F.desc("score"), F.col("customer_id"))


@query("view_audience", f"{_AUDIENCE}, best AS (SELECT * FROM free ORDER BY score DESC, customer_id LIMIT 100) SELECT score, count(*) AS n, min(customer_id) AS first_id FROM best GROUP BY 1")
def _(t):
    audience(t).createOrReplaceTempView("audience_list")
    return t.spark.sql("SELECT score, count(*) AS n, min(customer_id) AS first_id FROM audience_list GROUP BY score")


# ------------------------------------------------------------ cleaning

_X = features.frequency_sql("r_daily", features.D, "customer_id")


@query("pp_cast_fill", "SELECT o.order_id, COALESCE(s.cart_id::DOUBLE, -10.0::DOUBLE) AS cart_id, COALESCE(s.free_flag::DOUBLE, 0.0::DOUBLE) AS free_flag, COALESCE(TRY_CAST(s.picking AS DOUBLE), -1.0::DOUBLE) AS picking FROM r_orders o LEFT JOIN r_shipments s ON s.shipment_id = o.order_id")
def _(t):
    rows = t.orders.join(t.shipments, t.orders.order_id == t.shipments.shipment_id, "left").select("order_id", "cart_id", "free_flag", "picking")
    return pp.cast_fill(rows, {"cart_id": FILL_RECENCY, "free_flag": 0.0, "picking": -1.0})


@query("pp_tenure_rules", f"""
    WITH f AS ({_X}), n AS ({features._TENURE}), x AS (SELECT n.*, f.recency, f.first_in_window FROM f JOIN n USING (customer_id)),
    a AS (SELECT customer_id, recency, first_in_window, days_from_first_listing AS l, days_from_first_sale AS s, COALESCE(days_from_first_buy, recency) AS b, COALESCE(days_from_registration, recency) AS r FROM x),
    b AS (SELECT *, CASE WHEN b < 0 THEN first_in_window ELSE b END AS b2 FROM a), c AS (SELECT *, CASE WHEN r < 0 THEN b2 ELSE r END AS r2 FROM b)
    SELECT customer_id, b2::DOUBLE AS days_from_first_buy, (CASE WHEN r2 < b2 THEN first_in_window ELSE r2 END)::DOUBLE AS days_from_registration, COALESCE(CASE WHEN l < 0 THEN -10 ELSE l END, -10)::DOUBLE AS days_from_first_listing, COALESCE(s, -10)::DOUBLE AS days_from_first_sale FROM c""")
def _(t):
    rows = order_block(t).select("customer_id", "recency", "first_in_window").join(PARTS["fb_tenure"][0](t), "customer_id")
    return pp.tenure_rules(rows, FILL_RECENCY).drop("recency", "first_in_window")


@query("pp_prepaid_rules", f"""
    WITH c AS (SELECT buyer_id AS customer_id, max(created) AS created, min(created + 5) AS activated FROM r_orders WHERE channel = '1-URGENT' AND created <= {features.D} GROUP BY 1),
    x AS (SELECT p.customer_id, ({features.D} - created) AS r, ({features.D} - activated) AS a FROM r_population p LEFT JOIN c USING (customer_id)), y AS (SELECT *, CASE WHEN r < a THEN a ELSE r END AS r2 FROM x)
    SELECT customer_id, COALESCE(CASE WHEN r2 >= 0 THEN r2 END, -10)::DOUBLE AS ppd_recency, COALESCE(CASE WHEN a >= 0 THEN a END, -10)::DOUBLE AS ppd_first_activation, CASE WHEN a >= 0 THEN 1.0::DOUBLE ELSE 0 END AS ppd_active FROM y""")
def _(t):
    cards = t.orders.where("channel = '1-URGENT'").where(F.col("created") <= features.end()).groupBy(F.col("buyer_id").alias("customer_id")).agg(
        F.datediff(features.end(), F.max("created")).alias("ppd_recency"), F.datediff(features.end(), F.min(F.date_add("created", 5))).alias("ppd_first_activation"))
    return pp.prepaid_rules(features.pop(t).join(cards, "customer_id", "left"), FILL_RECENCY)


@query("pp_registry_rules", """
    SELECT customer_id, CASE WHEN balance < 1000 THEN 'company' ELSE 'person' END AS data_type, CASE WHEN customer_id % 2 = 0 THEN 'MASCULINO' ELSE 'FEMININO' END AS gender,
      (CASE WHEN 1998 - year(registered - 9000) <= 0 OR 1998 - year(registered - 9000) > 100 THEN -10 ELSE 1998 - year(registered - 9000) END)::DOUBLE AS age,
      CASE nation_id % 4 WHEN 0 THEN 'CASADO(A)' WHEN 1 THEN 'SOLTEIRO(A)' WHEN 2 THEN 'CASADO(A)' ELSE 'NA' END AS civil_status FROM r_customers JOIN r_population USING (customer_id)""")
def _(t):
    return pp.registry_rules(PARTS["fb_registry"][0](t), FILL_RECENCY).select("customer_id", "data_type", "gender", "age", "civil_status")


@query("pp_location_rules", "SELECT o.order_id, CASE WHEN a.address_id IS NULL OR n.n_regionkey > 2 THEN 'other_state' ELSE strip_accents(lower(a.state_name)) END AS location FROM r_orders o LEFT JOIN r_shipments s ON s.shipment_id = o.order_id LEFT JOIN r_addresses a USING (address_id) LEFT JOIN nation n ON n.n_nationkey = a.address_id")
def _(t):
    from tallyloom.functions.text import casefold_plain
    addresses = t.addresses.select("address_id", casefold_plain("state_name").alias("location"))
    known = addresses.join(t.read("nation").where("n_regionkey <= 2").select(F.col("n_nationkey").alias("address_id")), "address_id", "left_semi")
    rows = t.orders.join(t.shipments.select(F.col("shipment_id").alias("order_id"), "address_id"), "order_id", "left").join(addresses, "address_id", "left")
    return pp.location_rules(rows.select("order_id", "location"), known)


@query("pp_reinstall_flag", f"""
    WITH i AS ({features._installs_sql("A")}) SELECT p.customer_id, COALESCE(days_last_install, -10)::DOUBLE AS days_last_install, COALESCE(days_first_install, -10)::DOUBLE AS days_first_install, COALESCE(device, 'OTHER_DEVICE') AS device,
      CASE WHEN COALESCE(days_last_install, -10) < COALESCE(days_first_install, -10) THEN 1.0::DOUBLE ELSE 0 END AS reinstalled FROM r_population p LEFT JOIN i USING (customer_id)""".replace("WITH i AS (\n    WITH u", "WITH i AS (WITH u"))
def _(t):
    from tallyloom.operators import profile as pf
    block = pf.installs(t.installs, t.app_devices, features.pop(t), date_lit("2024-01-25"), "A")
    return pp.reinstall_flag(features.pop(t).join(block, "customer_id", "left"), FILL_RECENCY)


@query("imp_constant", "SELECT shipment_id, COALESCE(free_flag, 0)::BIGINT AS free_flag FROM r_shipments")
def _(t):
    return t.shipments.select("shipment_id", "free_flag").na.fill({"free_flag": 0})


_REC = "SELECT c.customer_id, (DATE '2024-02-10' - v.l)::BIGINT AS recency, CASE WHEN v.n > 20 THEN v.os END AS os FROM r_customers c LEFT JOIN (SELECT customer_id, max(day) l, count(*) n, CASE WHEN sum(k) % 3 = 0 THEN 'ios' ELSE 'android' END AS os FROM r_events GROUP BY 1) v USING (customer_id)"


def recency_rows(t):
    v = t.events.groupBy("customer_id").agg(F.max("day").alias("l"), F.count("*").alias("n"), F.when(F.sum("k") % 3 == 0, "ios").otherwise("android").alias("os"))
    return t.customers.select("customer_id").join(v, "customer_id", "left").select("customer_id", F.datediff(date_lit("2024-02-10"), "l").alias("recency"), F.when(F.col("n") > 20, F.col("os")).alias("os"))


@query("imp_max_plus_one", f"WITH x AS ({_REC}) SELECT customer_id, COALESCE(recency, (SELECT max(recency) + 1 FROM x)) AS recency FROM x")
def _(t):
    return pp.max_plus_one(recency_rows(t).drop("os"), "recency")


@query("imp_categorical_draw", f"""
    WITH x AS ({_REC}), c AS (SELECT os AS v, count(*) n FROM x WHERE os IS NOT NULL GROUP BY 1), e AS (SELECT v, sum(n) OVER (ORDER BY v)::DOUBLE / sum(n) OVER () AS hi, (sum(n) OVER (ORDER BY v) - n)::DOUBLE / sum(n) OVER () AS lo FROM c)
    SELECT customer_id, COALESCE(os, e.v) AS os FROM x LEFT JOIN e ON {hx('customer_id')} / 4294967296.0::DOUBLE >= lo AND {hx('customer_id')} / 4294967296.0::DOUBLE < hi""")
def _(t):
    return pp.draw_missing(recency_rows(t).select("customer_id", "os"), "os", "customer_id")


@query("imp_forest")
def _(t):
    return r6(pp.forest_impute(masked_orders(t), ["amount", "items", "lines", "line_mean"], "order_id"))


def masked_orders(t, every: int = 10):
    """Orders with measures of their lines; one in `every` misses its amount, others their items."""
    per = t.order_lines.groupBy("order_id").agg(F.sum("amount").cast("double").alias("amount"), F.sum("items").cast("double").alias("items"), F.count(F.lit(1)).cast("double").alias("lines"), F.max("amount").cast("double").alias("line_max"))
    hidden = lambda c, salt: F.when(F.pmod(F.xxhash64("order_id", F.lit(salt)), F.lit(every)) != 0, F.col(c))
    return per.select("order_id", hidden("amount", "a").alias("amount"), hidden("items", "i").alias("items"), "lines", (F.col("line_max") / F.col("lines")).alias("line_mean"))


@query("imp_group_median", """
    WITH b AS (SELECT customer_id, segment, CASE WHEN balance > 0 THEN balance::DOUBLE END AS v FROM r_customers), m AS (SELECT segment, quantile_disc(v, 0.5) AS m FROM b GROUP BY 1)
    SELECT customer_id, segment, COALESCE(v, m) AS balance FROM b JOIN m USING (segment)""")
def _(t):
    rows = t.customers.select("customer_id", "segment", F.when(F.col("balance") > 0, F.col("balance").cast("double")).alias("balance"))
    return pp.median_by_group(rows, ["balance"], ["segment"])


@query("out_clip_quantile", """
    WITH q AS (SELECT quantile_cont(amount::DOUBLE, 0.95) AS a, quantile_cont(items::DOUBLE, 0.95) AS i FROM r_lines)
    SELECT order_id, line_no::BIGINT AS line_no, item_id, round(least(amount::DOUBLE, a), 6) AS amount, round(least(items::DOUBLE, i), 6) AS items FROM r_lines, q""")
def _(t):
    # The quantiles read the lines several times; written once, their join with the orders runs once.
    lines = written(t.order_lines.select("order_id", "line_no", "item_id", "amount", "items"), "clip-lines")
    return r6(pp.clip_upper(lines, ["amount", "items"]))


@query("out_zscore_null", """
    WITH s AS (SELECT avg(value::DOUBLE) m, stddev_pop(value::DOUBLE) s FROM r_events)
    SELECT event_id, (CASE WHEN abs((value::DOUBLE - m) / s) < 3 THEN value END)::DOUBLE AS value FROM r_events, s""")
def _(t):
    from tallyloom.operators.drift import null_outliers
    return null_outliers(t.events.select("event_id", "value"), ["value"])


@query("out_negative_to_sentinel", "SELECT customer_id, CASE WHEN balance < 0 THEN -10.0::DOUBLE ELSE balance::DOUBLE END AS balance FROM r_customers")
def _(t):
    return pp.negative_to(t.customers.select("customer_id", "balance"), ["balance"], FILL_RECENCY)


@query("out_low_activity", """
    WITH d AS (SELECT site, day, count(*) FILTER (event_type = 'error') AS sent, sum(value) FILTER (event_type = 'purchase') AS spend FROM r_events GROUP BY 1, 2)
    SELECT site, day::VARCHAR AS day, (CASE WHEN sent > 30 THEN sent ELSE 0 END)::BIGINT AS sent, (CASE WHEN sent > 30 THEN spend ELSE 0 END)::DOUBLE AS spend FROM d""")
def _(t):
    daily = t.events.groupBy("site", "day").agg(F.count(F.when(F.col("event_type") == "error", 1)).alias("sent"), F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("spend"))
    return pp.low_activity(daily, "sent", "spend", 30)


@query("sc_standard", """
    WITH s AS (SELECT avg(amount::DOUBLE) m, stddev_pop(amount::DOUBLE) s FROM r_orders WHERE created < DATE '1999-01-01')
    SELECT order_id, round((amount::DOUBLE - m) / s, 6) AS amount FROM r_orders, s""")
def _(t):
    scale = pp.fit_scale(t.orders.where("created < DATE '1999-01-01'"), ["amount"])
    return r6(pp.apply_scale(t.orders.select("order_id", "amount"), scale, ["amount"]))


@query("sc_robust", """
    WITH s AS (SELECT quantile_cont(amount::DOUBLE, 0.5) m, quantile_cont(amount::DOUBLE, 0.75) - quantile_cont(amount::DOUBLE, 0.25) s FROM r_orders)
    SELECT order_id, round((amount::DOUBLE - m) / s, 6) AS amount FROM r_orders, s""")
def _(t):
    rows = t.orders.select("order_id", "amount")
    return r6(pp.apply_scale(rows, pp.fit_scale(rows, ["amount"], robust=True), ["amount"]))


@query("enc_antidummy", "SELECT order_id, CASE status_code WHEN 'F' THEN 1::BIGINT WHEN 'O' THEN 2 ELSE 3 END AS code FROM r_orders")
def _(t):
    hot = t.orders.select("order_id", *[(F.col("status_code") == c).cast("int").alias(c) for c in "FOP"])
    return hot.select("order_id", pp.from_dummies(["F", "O", "P"]).alias("code"))


@query("enc_label_code", "WITH l AS (SELECT source FROM documents GROUP BY 1 HAVING count(*) >= 45), c AS (SELECT source, row_number() OVER (ORDER BY source) AS code FROM l) SELECT doc_id, d.source, code FROM documents d JOIN c USING (source)")
def _(t):
    return pp.label_codes(t.read("documents").select("doc_id", "source"), "source", 45)


@query("enc_class_weight", "WITH c AS (SELECT segment, count(*) n FROM r_customers GROUP BY 1) SELECT segment, round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n), 6) AS weight FROM c")
def _(t):
    return r6(pp.class_weights(t.customers, "segment"))


@query("prep_variable_set", f"""
    WITH {campaigns._DAY}, p AS (SELECT DISTINCT customer_id, site, sent_date FROM r_pushes WHERE push_type IN ('sent', 'control') AND batch_id NOT LIKE 'NEWBUYERS%'),
    h AS (SELECT bk.customer_id, bk.site, bk.sent_date, count(*) FILTER (p.sent_date >= bk.sent_date - 15)::DOUBLE / nullif(count(*) FILTER (p.sent_date <= bk.sent_date - 16), 0) AS ratio, count(*) FILTER (p.sent_date >= bk.sent_date - 7) AS n7,
      (bk.sent_date - max(p.sent_date) FILTER (p.sent_date >= bk.sent_date - 7))::BIGINT AS recency FROM bk LEFT JOIN p ON p.customer_id = bk.customer_id AND p.site = bk.site AND p.sent_date BETWEEN bk.sent_date - 31 AND bk.sent_date - 1 GROUP BY bk.customer_id, bk.site, bk.sent_date),
    f AS (SELECT customer_id, site, sent_date, COALESCE(recency, (SELECT max(recency) + 1 FROM h)) AS recency, n7, COALESCE(ratio, -1) AS ratio FROM h),
    k AS (SELECT *, (rank() OVER (ORDER BY ratio) + (count(*) OVER (PARTITION BY ratio) - 1) / 2.0) / count(*) OVER () AS rk FROM f)
    SELECT bk.customer_id, bk.site, bk.sent_date::VARCHAR AS sent_date, conversion AS y, CASE push_type WHEN 'sent' THEN 1::BIGINT ELSE 0 END AS w, recency AS PUSH_recency, n7 AS PUSH_push_days_7d, round(ratio, 6) AS PUSH_push_ratio_15d, round(rk, 6)::DOUBLE AS PUSH_push_rank
    FROM bk JOIN k USING (customer_id, site, sent_date)""")
def _(t):
    from tallyloom.operators import push as ps
    backbone = campaigns.per_day(t)
    block = pp.max_plus_one(ps.push_history(backbone, t.pushes, "NEWBUYERS%"), "recency")
    block = rk.percent_rank_average(block.withColumn("push_ratio_15d", F.coalesce("push_ratio_15d", F.lit(-1.0))), "push_ratio_15d", "push_rank")
    keys = ["customer_id", "site", "sent_date"]
    master = jn.join_one_to_one(backbone, pp.prefix_columns(block, "PUSH", keys), keys)
    return r6(master.withColumn("w", pp.remap("push_type", {"sent": 1, "control": 0})).withColumnRenamed("conversion", "y").drop("push_type"))
