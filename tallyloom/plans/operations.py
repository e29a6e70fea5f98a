"""Queries of budget pacing, job checks, reports and load planning."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions.columns import date_lit, rounded
from tallyloom.operators import budget as bd
from tallyloom.operators import loading as ld
from tallyloom.operators import monitor as mn
from tallyloom.plans.common import r6
from tallyloom.plans.registry import query

# ------------------------------------------------------------ budget

BOP, EOP = "2024-01-01", "2024-01-30"
BUDGETS = {"F": 9000.0, "O": 4000.0}
_TL = "tl AS (SELECT DISTINCT TRY_CAST(tool_id AS BIGINT) AS campaign_id, site FROM r_tools)"
_DS = f"{_TL}, ds AS (SELECT p.site, p.move_date AS day, sum(coupon_amount) AS amount FROM r_wallet p JOIN r_coupons c USING (payment_id, buyer_id) JOIN tl ON tl.campaign_id = c.campaign_id AND tl.site = p.site WHERE p.status = 'approved' AND p.move_date BETWEEN DATE '{BOP}' AND DATE '{EOP}' GROUP BY 1, 2)"
_EX = f"{_DS}, cal AS (SELECT site, g.d::DATE AS day FROM (SELECT DISTINCT site FROM ds), generate_series(DATE '{BOP}', DATE '{EOP}', INTERVAL 1 DAY) g(d)), ex AS (SELECT cal.site, cal.day, COALESCE(amount, 0) AS amount, sum(COALESCE(amount, 0)) OVER (PARTITION BY cal.site ORDER BY cal.day) AS acc_amount FROM cal LEFT JOIN ds ON ds.site = cal.site AND ds.day = cal.day)"
_TG = f"{_EX}, tg AS (SELECT *, CASE site WHEN 'F' THEN 9000.0::DOUBLE ELSE 4000.0::DOUBLE END AS budget, COALESCE(lag(acc_amount) OVER (PARTITION BY site ORDER BY day), 0)::DOUBLE AS spent_before, (DATE '{EOP}' - day) AS left_ FROM ex), tt AS (SELECT *, CASE WHEN left_ > 0 THEN (budget - spent_before) / left_ ELSE budget - acc_amount::DOUBLE END AS target FROM tg)"


def campaigns(t):
    return t.tools.select(F.col("tool_id").try_cast("long").alias("campaign_id"), "site")


def spend(t):
    return bd.daily_spend(t.wallet, t.coupons, campaigns(t), date_lit(BOP), date_lit(EOP))


@query("bd_daily_spend", f"WITH {_DS} SELECT site, day::VARCHAR AS day, amount::DOUBLE AS amount FROM ds")
def _(t):
    return spend(t)


@query("bd_expand", f"WITH {_EX} SELECT site, day::VARCHAR AS day, amount::DOUBLE AS amount, acc_amount::DOUBLE AS acc_amount FROM ex")
def _(t):
    return bd.expand(spend(t), BOP, EOP)


@query("bd_daily_target", f"WITH {_TG} SELECT site, day::VARCHAR AS day, spent_before, round(target, 6) AS target FROM tt")
def _(t):
    return r6(bd.daily_target(bd.expand(spend(t), BOP, EOP), BUDGETS, EOP).select("site", "day", "spent_before", "target"))


@query("bd_alarms", f"""
    WITH {_TG}, sh AS (SELECT *, round(1 - left_ / 30.0::DOUBLE, 2) AS ts, round(spent_before / budget, 2) AS bs FROM tt)
    SELECT site, day::VARCHAR AS day, ts AS time_share, bs AS budget_share, (target > 3 * budget / 30)::BIGINT AS over_limit, (ts > 0.5 AND bs < 0.5)::BIGINT AS under_spend, (ts < 0.5 AND bs > 0.5)::BIGINT AS over_spend FROM sh""")
def _(t):
    rows = bd.alarms(bd.daily_target(bd.expand(spend(t), BOP, EOP), BUDGETS, EOP), BOP, EOP)
    return rows.select("site", "day", "time_share", "budget_share", "over_limit", "under_spend", "over_spend")


_TOOLS = ["T0", "T2", "T4", "T6"]
_PT = f"sp AS (SELECT p.move_date AS day, 'T' || c.campaign_id AS tool, sum(coupon_amount) AS amount FROM r_wallet p JOIN r_coupons c USING (payment_id, buyer_id) WHERE p.site = 'F' AND p.status = 'approved' GROUP BY 1, 2), wd AS (SELECT day, " + ", ".join(f"COALESCE(sum(amount) FILTER (tool = '{x}'), 0) AS {x}" for x in _TOOLS) + " FROM sp GROUP BY 1)"


@query("bd_progress", f"WITH {_PT} SELECT day::VARCHAR AS day, " + ", ".join(f"round(sum({x}) OVER (ORDER BY day)::DOUBLE * 100 / {int(x[1:]) * 100 + 500}, 6) AS used_{x}" for x in _TOOLS) + ", round(sum(T0 + T2 + T4 + T6) OVER (ORDER BY day)::DOUBLE * 100 / 3200, 6) AS used_total FROM wd")
def _(t):
    rows = t.wallet.where("site = 'F' AND status = 'approved'").join(t.coupons, ["payment_id", "buyer_id"])
    by_tool = rows.groupBy(F.col("move_date").alias("day"), F.concat(F.lit("T"), F.col("campaign_id").cast("string")).alias("tool")).agg(F.sum("coupon_amount").alias("amount"))
    budgets = t.tools.where("site = 'F'").select(F.concat(F.lit("T"), "tool_id").alias("tool"), "budget")
    return r6(bd.progress(by_tool, budgets, _TOOLS))


_MC = "mc AS (SELECT * FROM (SELECT move_date AS day, coupon_amount, count(DISTINCT payment_id) AS n, row_number() OVER (PARTITION BY move_date ORDER BY count(DISTINCT payment_id) DESC, coupon_amount DESC) rn FROM r_wallet JOIN r_coupons USING (payment_id, buyer_id) WHERE status = 'approved' GROUP BY 1, 2) WHERE rn = 1)"


@query("bd_main_coupon", f"WITH {_MC} SELECT day::VARCHAR AS day, coupon_amount::DOUBLE AS coupon_amount, n FROM mc")
def _(t):
    return bd.main_coupon(t.wallet, t.coupons)


_SC = "sc AS (SELECT sent_date AS day, count(*) AS sent FROM r_pushes WHERE push_type = 'sent' AND batch_id LIKE 'NEWBUYERS%' AND sent_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY 1)"


@query("bd_send_count", f"WITH {_SC} SELECT day::VARCHAR AS day, sent FROM sc")
def _(t):
    return bd.send_count(t.pushes, "NEWBUYERS%", date_lit(BOP), date_lit(EOP))


@query("bd_cost_dataset", f"""
    WITH {_DS}, {_MC}, {_SC}, j AS (SELECT g.d::DATE AS day, COALESCE((SELECT sum(amount) FROM ds WHERE ds.day = g.d::DATE), 0) AS amount, COALESCE(sent, 0) AS sent, coupon_amount FROM generate_series(DATE '2023-12-30', DATE '2024-02-02', INTERVAL 1 DAY) g(d) LEFT JOIN mc ON mc.day = g.d::DATE LEFT JOIN sc ON sc.day = g.d::DATE)
    SELECT day::VARCHAR AS day, amount::DOUBLE AS amount, sent, last_value(coupon_amount IGNORE NULLS) OVER (ORDER BY day)::DOUBLE AS coupon_amount, isodow(day) - 1 AS day_of_week FROM j""")
def _(t):
    sends = bd.send_count(t.pushes, "NEWBUYERS%", date_lit(BOP), date_lit(EOP))
    coupon = bd.main_coupon(t.wallet, t.coupons).select("day", "coupon_amount")
    return bd.cost_dataset(spend(t), sends, coupon, "2023-12-30", "2024-02-02")


@query("bd_campaign_budget", """
    WITH p AS (SELECT k % 8 AS campaign_id, min(day) AS first_send, max(day) AS last_send FROM r_events WHERE event_type = 'error' AND k < 50 AND day BETWEEN DATE '2024-01-01' AND DATE '2024-01-20' GROUP BY 1)
    SELECT p.campaign_id::BIGINT AS campaign_id, first_send::VARCHAR AS first_send, last_send::VARCHAR AS last_send, tool_id, budget, started::VARCHAR AS first_budget FROM p LEFT JOIN r_tools t ON TRY_CAST(t.tool_id AS BIGINT) = p.campaign_id AND t.site = 'F'""")
def _(t):
    pushes = t.events.where("event_type = 'error'").select((F.col("k") % 8).cast("long").alias("campaign_id"), F.when(F.col("k") < 50, "NEWBUYERS_A").otherwise("OTHER").alias("batch_id"), F.col("day").alias("sent_date"))
    tools = t.tools.where("site = 'F'").select(F.col("tool_id").try_cast("long").alias("campaign_id"), "tool_id", "budget", "started")
    return bd.campaign_budget(pushes, tools, "NEWBUYERS%", date_lit("2024-01-01"), date_lit("2024-01-20"))


# ------------------------------------------------------------ reports, job checks


@query("rp_audience_metrics", """
    SELECT l_orderkey AS order_id, l_extendedprice AS cost, CASE WHEN s_nationkey % 3 = 0 THEN 'interest ' || s_nationkey ELSE s_name END AS list_name,
      CASE s_nationkey % 9 WHEN 0 THEN 'USER_INTEREST' WHEN 2 THEN 'APP_USERS' WHEN 3 THEN 'COMBINED_LIST' WHEN 5 THEN 'WEBSITE_VISITORS' WHEN 6 THEN 'SIMILAR_AUDIENCE' WHEN 7 THEN 'CUSTOMER_LIST' ELSE (s_nationkey % 9)::VARCHAR END AS list_type
    FROM lineitem JOIN supplier ON s_suppkey = l_suppkey""")
def _(t):
    metrics = t.read("lineitem").select(F.col("l_suppkey").alias("criterion_id"), F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("cost"))
    nation = F.col("s_nationkey")
    lists = t.read("supplier").select(
        F.col("s_suppkey").alias("criterion_id"), F.when(nation % 3 == 0, "").otherwise(F.col("s_name")).alias("user_list"),
        F.concat(F.lit("interest "), nation.cast("string")).alias("interest_name"), (nation % 9).alias("user_type"))
    return mn.audience_metrics(metrics, lists.unionByName(lists), ["order_id", "cost"])


@query("rp_control_counts", "SELECT channel, strftime(created, '%Y%m') AS photo_id, count(*) AS n FROM r_orders GROUP BY 1, 2")
def _(t):
    return mn.control_counts(t.orders.withColumn("photo_id", F.date_format("created", "yyyyMM")), "channel", "photo_id")


_DAY = "DATE '1998-12-29'"
_JOBS = "jobs AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'O' END AS site, c_mktsegment AS bu, 'I' || (c_custkey % 7) AS initiative, c_name AS job, CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'MA' WHEN 2 THEN 'VI' ELSE 'LU' END AS weekday, c_custkey % 20 AS sh, c_custkey % 60 AS sm FROM customer)"
_SCH = f"{_JOBS}, sch AS (SELECT site, bu, initiative, job, {_DAY}::TIMESTAMP + to_hours(sh::INT) + to_minutes(sm::INT) AS expected_start, {_DAY}::TIMESTAMP + to_hours(sh::INT + 2) + to_minutes(sm::INT) AS expected_end, {_DAY} AS photo_day FROM jobs WHERE weekday IN ('', 'MA'))"


def jobs(t):
    key = F.col("customer_id")
    n = key % 4
    return t.customers.select(
        "site", F.col("segment").alias("bu"), F.concat(F.lit("I"), (key % 7).cast("string")).alias("initiative"), F.col("nickname").alias("job"),
        F.when(n == 0, "").when(n == 1, "MA").when(n == 2, "VI").otherwise("LU").alias("weekday"), (key % 20).cast("string").alias("start_hour"),
        (key % 60).cast("string").alias("start_minute"), (key % 20 + 2).cast("string").alias("end_hour"), (key % 60).cast("string").alias("end_minute"))


def schedule(t):
    return mn.schedule_of(jobs(t), date_lit("1998-12-29"))


_F = "'%Y-%m-%d %H:%M:%S'"


@query("mon_schedule", f"WITH {_SCH} SELECT site, bu, initiative, job, strftime(expected_start, {_F}) AS expected_start, strftime(expected_end, {_F}) AS expected_end, photo_day::VARCHAR AS photo_day FROM sch")
def _(t):
    return schedule(t)


_MON = f"""{_SCH}, monitor AS (SELECT site, bu, initiative, job, expected_start, expected_end, CASE WHEN sh % 3 > 0 THEN expected_start + INTERVAL 5 MINUTE END AS real_start, CASE WHEN sh % 3 > 1 THEN expected_end - INTERVAL 5 MINUTE END AS real_end, photo_day
    FROM (SELECT s.*, j.sh FROM sch s JOIN jobs j USING (site, bu, initiative, job)) WHERE bu <> 'MACHINERY')"""


def monitor(t):
    hour = F.hour("expected_start") % 3
    return schedule(t).where("bu <> 'MACHINERY'").select(
        "site", "bu", "initiative", "job", "expected_start", "expected_end", F.when(hour > 0, F.col("expected_start") + F.expr("interval 5 minutes")).alias("real_start"),
        F.when(hour > 1, F.col("expected_end") - F.expr("interval 5 minutes")).alias("real_end"), "photo_day")


@query("mon_load", f"""
    WITH {_MON}, kept AS (SELECT * FROM monitor WHERE NOT (photo_day = {_DAY} AND real_start IS NULL AND real_end IS NULL)), allr AS (SELECT site, bu, initiative, job, expected_start, real_start FROM kept UNION ALL
      SELECT site, bu, initiative, job, expected_start, NULL FROM sch s WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.site = s.site AND k.bu = s.bu AND k.initiative = s.initiative AND k.job = s.job AND k.photo_day = s.photo_day))
    SELECT site, bu, initiative, job, strftime(expected_start, {_F}) AS expected_start, strftime(real_start, {_F}) AS real_start FROM allr""")
def _(t):
    return mn.load_schedule(monitor(t), schedule(t), date_lit("1998-12-29")).select("site", "bu", "initiative", "job", "expected_start", "real_start")


_NOW = "TIMESTAMP '1998-12-29 12:00:00'"
_SENT = "snt AS (SELECT site, bu, initiative, job, 'START' AS alert FROM jobs WHERE initiative = 'I3')"


@query("mon_late", f"""
    WITH {_MON}, {_SENT}, a AS (SELECT DISTINCT site, bu, initiative, job, 'START' AS alert FROM monitor WHERE expected_start <= {_NOW} AND real_start IS NULL UNION ALL SELECT DISTINCT site, bu, initiative, job, 'END' FROM monitor WHERE expected_end <= {_NOW} AND real_end IS NULL)
    SELECT * FROM a WHERE (site, bu, initiative, job, alert) NOT IN (SELECT (site, bu, initiative, job, alert) FROM snt)""")
def _(t):
    sent = jobs(t).where("initiative = 'I3'").select("site", "bu", "initiative", "job", F.lit("START").alias("alert"))
    return mn.late_jobs(monitor(t), F.lit("1998-12-29 12:00:00").cast("timestamp_ntz"), sent)


@query("mon_dependency", f"WITH {_MON} SELECT job, strftime(real_end, {_F}) AS real_end FROM monitor WHERE initiative = 'I2' AND site = 'F' AND photo_day = {_DAY} AND real_end IS NOT NULL")
def _(t):
    return mn.upstream_end(monitor(t), "I2", "F", date_lit("1998-12-29"))


# ------------------------------------------------------------ load planning

_FLEET = """vh AS (SELECT r_name AS vehicle, (r_regionkey + 1) * 2000.0::DOUBLE AS capacity_weight, (r_regionkey + 1) * 40.0::DOUBLE AS capacity_volume FROM region), rt AS (SELECT n_name AS city, vehicle, (capacity_weight / 10 + n_nationkey)::DOUBLE AS rate FROM nation, vh WHERE NOT (n_nationkey % 5 = 0 AND vehicle LIKE '%0')),
    fl AS (SELECT city, vehicle, capacity_weight, capacity_volume, rate FROM vh JOIN rt USING (vehicle))"""
_GOODS = "gd AS (SELECT n_name AS city, o.created AS day, o.items::DOUBLE AS weight, o.items / 50.0::DOUBLE AS volume, o.amount::DOUBLE AS value FROM r_lines o JOIN r_customers c ON c.customer_id = o.buyer_id JOIN nation ON n_nationkey = nation_id WHERE o.status = 'paid')"


def fleet(t):
    vehicles = t.read("region").select(F.col("r_name").alias("vehicle"), ((F.col("r_regionkey") + 1) * 2000.0).alias("capacity_weight"), ((F.col("r_regionkey") + 1) * 40.0).alias("capacity_volume"))
    every = vehicles.agg(F.collect_list(F.struct("vehicle", F.col("capacity_weight").alias("w")))).scalar()  # one entry per region
    cities = t.read("nation").select(F.concat("n_name", F.lit(" ")).alias("city"), "n_nationkey").withColumn("every", every)
    priced = cities.select("city", "n_nationkey", F.inline("every")).where(~((F.col("n_nationkey") % 5 == 0) & F.col("vehicle").like("%0")))
    rates = priced.select("city", "vehicle", (F.col("w") / 10 + F.col("n_nationkey")).alias("rate"))
    return ld.vehicle_rates(vehicles, rates.unionByName(rates.withColumn("rate", F.col("rate") + 5)))


def goods(t):
    rows = t.order_lines.where("status = 'paid'").join(t.customers.select(F.col("customer_id").alias("buyer_id"), "nation_id"), "buyer_id")
    rows = rows.join(t.read("nation").select(F.col("n_nationkey").alias("nation_id"), F.col("n_name").alias("city")), "nation_id")
    return rows.select(
        "city", F.xxhash64("order_id", "line_no", "item_id", "seller_id", "amount", "items").alias("item_id"), F.col("created").alias("day"), F.col("items").cast("double").alias("weight"),
        (F.col("items") / 50.0).alias("volume"), F.col("amount").cast("double").alias("value"))


@query("ld_vehicle_rates", f"WITH {_FLEET} SELECT * FROM fl")
def _(t):
    return fleet(t).select("city", "vehicle", "capacity_weight", "capacity_volume", "rate")


@query("ld_candidates", f"""
    WITH {_FLEET}, {_GOODS}, w AS (SELECT city, sum(weight) weight, sum(volume) volume FROM gd GROUP BY 1)
    SELECT city, vehicle, capacity_weight, capacity_volume, rate, row_number() OVER (PARTITION BY city ORDER BY capacity_weight DESC, vehicle) AS choice FROM fl JOIN w USING (city) WHERE capacity_weight * 0.8::DOUBLE <= weight OR capacity_volume * 0.8::DOUBLE <= volume""")
def _(t):
    waiting = goods(t).groupBy("city").agg(F.sum("weight").alias("weight"), F.sum("volume").alias("volume"))
    return ld.candidates(waiting, fleet(t))


@query("ld_pack")
def _(t):
    return ld.pack(goods(t), fleet(t))


@query("ld_delay")
def _(t):
    return ld.load_delay(ld.pack(goods(t), fleet(t)))


@query("ld_totals")
def _(t):
    return r6(ld.totals(ld.pack(goods(t), fleet(t)), fleet(t)))


@query("ld_pending", f"""
    WITH {_FLEET}, {_GOODS}, s AS (SELECT city, sum(volume) v, sum(weight) w, sum(value) m FROM gd GROUP BY 1), l AS (SELECT city, min(capacity_volume) cv, min(capacity_weight) cw FROM fl GROUP BY 1)
    SELECT city, round(v, 4) AS volume, round(w, 4) AS weight, round(m, 2) AS value, cv AS capacity_volume, cw AS capacity_weight, (v < cv * 0.8 AND w < cw * 0.8)::BIGINT AS explained FROM s JOIN l USING (city)""")
def _(t):
    rows = ld.pending(goods(t), fleet(t))
    return rows.withColumns({"volume": rounded("volume", 4), "weight": rounded("weight", 4), "value": rounded("value", 2)})
