"""Queries of newcomers, push experiments and campaign measurement."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions.columns import date_lit, ratio, rounded
from tallyloom.operators import campaign as cp
from tallyloom.operators import joins as jn
from tallyloom.operators import newcomers as nc
from tallyloom.operators import push as ps
from tallyloom.plans.common import r6
from tallyloom.plans.registry import query
from tallyloom.sources import keyed

T_ = "DATE '2024-01-20'"


def today():
    return date_lit("2024-01-20")


_APP = "SELECT DISTINCT customer_id, site FROM r_app_devices WHERE status = 'ACTIVE' AND upper(platform) IN ('ANDROID', 'IOS')"
_BASE = f"""
    cust AS (SELECT c.customer_id, c.site, c.joined, CASE WHEN a.customer_id IS NULL THEN 'No app' ELSE 'App' END AS app_kind, {T_} AS process_date
      FROM r_customers c LEFT JOIN ({_APP}) a ON a.customer_id = c.customer_id AND a.site = c.site
      WHERE status = 'active' AND nickname NOT LIKE '%TEST%' AND joined BETWEEN {T_} - 60 AND {T_} - 1),
    first AS (SELECT c.customer_id, c.site, min(created) AS first_order FROM cust c JOIN r_purchases o ON o.buyer_id = c.customer_id AND o.site = c.site
      WHERE status = 'paid' AND created BETWEEN joined AND joined + 60 AND closed BETWEEN created AND created + 2 GROUP BY 1, 2)"""


def base(t):
    customers = nc.newcomers(t.customers, t.app_devices, today())
    return customers, nc.first_order(customers, t.purchases)


@query("fb_newcomer_population", f"""
    WITH {_BASE} SELECT customer_id, site, joined::VARCHAR AS joined, app_kind, process_date::VARCHAR AS process_date FROM cust c
    WHERE NOT EXISTS (SELECT 1 FROM r_purchases o WHERE o.buyer_id = c.customer_id AND o.status = 'paid' AND o.created BETWEEN {T_} - 60 AND {T_})""")
def _(t):
    return nc.newcomers(t.customers, t.app_devices, today(), t.purchases)


@query("fb_newcomer_first_order", f"WITH {_BASE} SELECT customer_id, site, first_order::VARCHAR AS first_order FROM first")
def _(t):
    return base(t)[1]


_SEG = {"total": None, "account_fund": "Account Fund", "wallet": "Wallet", "aggregator": "Aggregator", "point": "Point", "point_device": "Point Device Sale"}


def _windows(day: str) -> dict[str, str]:
    return {"": "TRUE", "_7d": f"{day} BETWEEN {T_} - 7 AND {T_}", "_f7d": f"{day} BETWEEN joined AND joined + 7"}


def _pay_columns() -> str:
    out = []
    for suffix, w in _windows("move_date").items():
        for name, label in _SEG.items():
            here = w if label is None else f"({w}) AND segment = '{label}'"
            out.append(f"sum(amount) FILTER ({here})::DOUBLE AS {name}_amount{suffix}")
            empty = f"CASE WHEN count(*) FILTER ({w}) > 0 THEN count(DISTINCT payment_id) FILTER ({here}) END"
            out.append(f"({empty})::BIGINT AS {name}_count{suffix}")
    return ", ".join(out)


_PAY = f"""pay AS (SELECT c.customer_id, c.site, {_pay_columns()} FROM r_wallet p JOIN cust c ON c.site = p.site AND c.customer_id = p.buyer_id LEFT JOIN first f ON f.customer_id = c.customer_id AND f.site = c.site
    WHERE status = 'approved' AND move_date BETWEEN joined AND joined + 60 AND move_date < COALESCE(first_order, {T_}) GROUP BY 1, 2)"""


@query("fb_newcomer_payments", f"WITH {_BASE}, {_PAY} SELECT * FROM pay")
def _(t):
    return nc.payment_grid(t.wallet, *base(t), today())


def _event_columns() -> str:
    out = []
    for suffix, w in _windows("log_date").items():
        out += [f"sum({c}) FILTER ({w})::BIGINT AS {c}{suffix}" for c in nc.COUNTERS]
        out += [f"min(min_price) FILTER ({w})::DOUBLE AS min_price{suffix}", f"max(max_price) FILTER ({w})::DOUBLE AS max_price{suffix}",
                f"round(avg(avg_price) FILTER ({w}), 6) AS avg_price{suffix}", f"(CASE WHEN count(*) FILTER ({w}) > 0 THEN count(DISTINCT log_date) FILTER ({w}) END)::BIGINT AS log_days{suffix}"]
    return ", ".join(out)


_EV = f"""ev AS (SELECT c.customer_id, c.site, {_event_columns()}, max(CASE WHEN max_price <= 10000 THEN max_price ELSE 0 END)::DOUBLE AS max_price_cut,
      round(avg(CASE WHEN avg_price <= 10000 THEN avg_price ELSE 0 END), 6) AS avg_price_cut, max(log_date) AS last_view, min(log_date) AS first_view
    FROM r_visits v JOIN cust c ON c.customer_id = v.customer_id AND c.site = v.site LEFT JOIN first f ON f.customer_id = c.customer_id AND f.site = c.site
    WHERE log_date BETWEEN joined AND joined + 60 AND log_date < COALESCE(first_order, {T_}) GROUP BY 1, 2)"""


@query("fb_newcomer_events", f"WITH {_BASE}, {_EV} SELECT * REPLACE (last_view::VARCHAR AS last_view, first_view::VARCHAR AS first_view) FROM ev")
def _(t):
    return r6(nc.event_grid(t.visits, *base(t), today()))


_INST = f"""inst AS (SELECT c.customer_id, c.site, min(os_name) AS os_name, max(CASE WHEN app = 'A' THEN 1 ELSE 0 END)::BIGINT AS app_a, max(CASE WHEN app = 'A' THEN install_date END) AS max_install_a, min(CASE WHEN app = 'A' THEN install_date END) AS min_install_a,
      max(CASE WHEN app = 'B' THEN 1 ELSE 0 END)::BIGINT AS app_b, max(CASE WHEN app = 'B' THEN install_date END) AS max_install_b, min(CASE WHEN app = 'B' THEN install_date END) AS min_install_b
    FROM r_installs i JOIN cust c ON c.customer_id = i.customer_id AND c.site = i.site LEFT JOIN first f ON f.customer_id = c.customer_id AND f.site = c.site
    WHERE install_date BETWEEN joined AND joined + 60 AND install_date < COALESCE(first_order, {T_}) GROUP BY 1, 2)"""


@query("fb_newcomer_installs", f"WITH {_BASE}, {_INST} SELECT * REPLACE (max_install_a::VARCHAR AS max_install_a, min_install_a::VARCHAR AS min_install_a, max_install_b::VARCHAR AS max_install_b, min_install_b::VARCHAR AS min_install_b) FROM inst")
def _(t):
    return nc.install_block(t.installs, *base(t), today())


@query("fb_newcomer_dates", f"""
    WITH {_BASE}, {_EV}, {_INST}
    SELECT c.customer_id, c.app_kind, COALESCE(category_count, 0)::DOUBLE AS category_count, COALESCE(max_price, 0)::DOUBLE AS max_price, COALESCE(min_install_a - joined, -10)::BIGINT AS days_install_a, COALESCE(min_install_b - joined, -10)::BIGINT AS days_install_b,
      COALESCE(COALESCE(first_order, process_date) - last_view, -10)::BIGINT AS days_last_view, COALESCE(COALESCE(first_order, process_date) - first_view, -10)::BIGINT AS days_first_view,
      COALESCE(last_view - joined, -10)::BIGINT AS days_last_view_joined, COALESCE(first_view - joined, -10)::BIGINT AS days_first_view_joined
    FROM cust c LEFT JOIN ev USING (customer_id, site) LEFT JOIN inst USING (customer_id, site) LEFT JOIN first USING (customer_id, site)""")
def _(t):
    customers, first = base(t)
    blocks = [nc.event_grid(t.visits, customers, first, today()), nc.install_block(t.installs, customers, first, today()), first]
    rows = nc.day_differences(jn.join_blocks(customers, blocks, ["customer_id", "site"]))
    return rows.select("customer_id", "app_kind", "category_count", "max_price", *[c for c in rows.columns if c.startswith("days_")])


# ------------------------------------------------------------ push

_SENT = "sent AS (SELECT DISTINCT customer_id, site, sent_date, push_type FROM r_pushes WHERE push_type IN ('sent', 'control') AND batch_id LIKE 'NEWBUYERS%' AND sent_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31')"
_CONV = f"""{_SENT}, conv AS (SELECT DISTINCT s.customer_id, s.site, s.sent_date, s.push_type, CASE WHEN o.buyer_id IS NULL THEN 0 ELSE 1 END::BIGINT AS conversion, o.created FROM sent s
    LEFT JOIN r_purchases o ON o.buyer_id = s.customer_id AND o.site = s.site AND o.status = 'paid' AND o.closed BETWEEN s.sent_date AND s.sent_date + 4 AND o.created = s.sent_date)"""


def sent(t):
    return ps.sends(t.pushes, date_lit("2024-01-01"), date_lit("2024-01-31"), "NEWBUYERS%")


def per_day(t):
    return ps.backbone(sent(t), t.purchases, ["customer_id", "site", "sent_date"])


@query("fb_push_backbone", f"WITH {_CONV} SELECT customer_id, site, sent_date::VARCHAR AS sent_date, push_type, conversion FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, site ORDER BY created NULLS FIRST, sent_date, push_type) rn FROM conv) WHERE rn = 1")
def _(t):
    return ps.backbone(sent(t), t.purchases)


_DAY = f"{_CONV}, bk AS (SELECT customer_id, site, sent_date, push_type, conversion FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, site, sent_date ORDER BY created NULLS FIRST, push_type) rn FROM conv) WHERE rn = 1)"


@query("xp_conversion_query", f"WITH {_DAY} SELECT customer_id, site, sent_date::VARCHAR AS sent_date, push_type, conversion FROM bk")
def _(t):
    return per_day(t)


@query("xp_conversion_by_group", f"WITH {_DAY} SELECT sent_date::VARCHAR AS sent_date, push_type, count(*) AS n, round(avg(conversion), 6) AS rate FROM bk GROUP BY 1, 2")
def _(t):
    return r6(per_day(t).groupBy("sent_date", "push_type").agg(F.count("*").alias("n"), F.avg("conversion").alias("rate")))


@query("fb_push_history", f"""
    WITH {_DAY}, p AS (SELECT DISTINCT customer_id, site, sent_date FROM r_pushes WHERE push_type IN ('sent', 'control') AND batch_id NOT LIKE 'NEWBUYERS%')
    SELECT bk.customer_id, bk.site, bk.sent_date::VARCHAR AS sent_date, round(count(*) FILTER (p.sent_date >= bk.sent_date - 15)::DOUBLE / nullif(count(*) FILTER (p.sent_date <= bk.sent_date - 16), 0), 6) AS push_ratio_15d,
      count(*) FILTER (p.sent_date >= bk.sent_date - 7) AS push_days_7d, (bk.sent_date - max(p.sent_date) FILTER (p.sent_date >= bk.sent_date - 7))::BIGINT AS recency
    FROM bk LEFT JOIN p ON p.customer_id = bk.customer_id AND p.site = bk.site AND p.sent_date BETWEEN bk.sent_date - 31 AND bk.sent_date - 1 GROUP BY bk.customer_id, bk.site, bk.sent_date""")
def _(t):
    return r6(ps.push_history(per_day(t), t.pushes, "NEWBUYERS%"))


_SUMS = ", ".join(f"COALESCE(sum({e}), 0)::BIGINT AS {n}" for n, e in {"buy": "buy_intention", "views": "view_android + view_ios + view_desktop + view_web", "question": "question", "checkout": "checkout", "cart": "add_to_cart", "bookmark": "bookmark"}.items())


@query("fb_push_behaviour", f"""
    WITH {_DAY}, v AS (SELECT v.*, c.joined FROM r_visits v LEFT JOIN r_customers c USING (customer_id, site)),
    b AS (SELECT bk.customer_id, bk.site, bk.sent_date, count(log_date) AS log_days_7d, (bk.sent_date - max(log_date))::BIGINT AS recency, round(COALESCE(avg(avg_price), 0), 6) AS avg_price_7d,
      round(COALESCE(avg(CASE WHEN log_date BETWEEN joined AND joined + 7 THEN avg_price END), 0), 6) AS avg_price_f7d, COALESCE(sum(category_count), 0)::BIGINT AS category_count_7d,
      COALESCE(sum(CASE WHEN log_date BETWEEN joined AND joined + 7 THEN category_count END), 0)::BIGINT AS category_count_f7d, min(min_price)::DOUBLE AS min_price, max(max_price)::DOUBLE AS max_price, {_SUMS}
      FROM bk LEFT JOIN v ON v.customer_id = bk.customer_id AND v.site = bk.site AND v.log_date BETWEEN bk.sent_date - 7 AND bk.sent_date - 1 GROUP BY bk.customer_id, bk.site, bk.sent_date),
    i AS (SELECT bk.customer_id, bk.site, bk.sent_date, min(os_name) AS os_name, COALESCE(max(CASE WHEN app = 'A' THEN 1 ELSE 0 END), 0)::BIGINT AS app_a, COALESCE(max(CASE WHEN app = 'B' THEN 1 ELSE 0 END), 0)::BIGINT AS app_b,
      (bk.sent_date - max(CASE WHEN app = 'A' THEN install_date END))::BIGINT AS days_last_install_a, (bk.sent_date - min(CASE WHEN app = 'A' THEN install_date END))::BIGINT AS days_first_install_a,
      (bk.sent_date - max(CASE WHEN app = 'B' THEN install_date END))::BIGINT AS days_last_install_b, (bk.sent_date - min(CASE WHEN app = 'B' THEN install_date END))::BIGINT AS days_first_install_b
      FROM bk LEFT JOIN r_installs n ON n.customer_id = bk.customer_id AND n.site = bk.site AND n.install_date BETWEEN bk.sent_date - 360 AND bk.sent_date - 1 GROUP BY bk.customer_id, bk.site, bk.sent_date),
    once AS (SELECT buyer_id, site, payment_id, max_by(amount, move_date) AS amount, max_by(segment, move_date) AS segment, max(move_date) AS move_date FROM r_wallet
      WHERE status = 'approved' AND segment IN ('Account Fund', 'Wallet', 'Aggregator', 'Point', 'Point Device Sale') GROUP BY ALL),
    m AS (SELECT bk.customer_id, bk.site, bk.sent_date, COALESCE(sum(amount), 0)::DOUBLE AS pay_total, COALESCE(sum(amount) FILTER (segment = 'Wallet'), 0)::DOUBLE AS pay_wallet,
      COALESCE(sum(amount) FILTER (segment = 'Aggregator'), 0)::DOUBLE AS pay_aggregator, count(payment_id) AS pay_n
      FROM bk LEFT JOIN once ON buyer_id = bk.customer_id AND once.site = bk.site AND move_date BETWEEN bk.sent_date - 90 AND bk.sent_date - 1 GROUP BY ALL)
    SELECT b.* REPLACE (sent_date::VARCHAR AS sent_date), i.* EXCLUDE (customer_id, site, sent_date), m.* EXCLUDE (customer_id, site, sent_date) FROM b JOIN i USING (customer_id, site, sent_date) JOIN m USING (customer_id, site, sent_date)""")
def _(t):
    return r6(ps.push_behaviour(per_day(t), t.visits, t.customers, t.installs, t.wallet))


# ------------------------------------------------------------ campaign

N = "DATE '2024-01-15'"
_BATCH = "CASE WHEN event_type = 'signup' THEN 'ENERO_CG' WHEN k % 10 = 3 THEN 'ENERO_BLACKLIST' WHEN k % 10 = 4 THEN 'ENEROXCG' ELSE 'ENERO_TG' END"
_KIND = "CASE event_type WHEN 'error' THEN 'sent' WHEN 'signup' THEN 'sent' WHEN 'view' THEN 'shown' WHEN 'click' THEN 'open' ELSE 'buy' END"
_TRACK = f"""tr AS (SELECT DISTINCT customer_id, site, day AS sent_date, CASE WHEN {_BATCH} LIKE '%\\_CG' ESCAPE '\\' THEN 'control' ELSE {_KIND} END AS push_type FROM r_events
    WHERE {_KIND} IN ('sent', 'shown', 'open') AND {_BATCH} NOT LIKE '%\\_BLACKL%' ESCAPE '\\' AND k < 95)"""


def tracks(t):
    k, kind = F.col("k"), F.col("event_type")
    batch = F.when(kind == "signup", "ENERO_CG").when(k % 10 == 3, "ENERO_BLACKLIST").when(k % 10 == 4, "ENEROXCG").otherwise("ENERO_TG")
    name = F.when(kind.isin("error", "signup"), "sent").when(kind == "view", "shown").when(kind == "click", "open").otherwise("buy")
    campaign = F.when(k < 95, "2024_ChurnCupon_A").otherwise("other")
    data = F.to_json(F.struct(batch.alias("batch_id"), name.alias("event_type"), campaign.alias("campaign_id")))
    return t.events.select(
        F.col("customer_id").cast("string").alias("user_id"), "site", F.col("day").alias("ds"), F.lit("market").alias("bu"),
        F.lit("/notification/campaigns_x").alias("path"), data.alias("event_data"))


def campaign(t):
    return cp.campaign_events(tracks(t), "churncupon", "market")


def tools(t):
    return cp.campaign_tools(t.tools, ["F", "O"], "churncupon", date_lit("2024-01-15"))


@query("fb_campaign_events", f"WITH {_TRACK} SELECT customer_id, site, sent_date::VARCHAR AS sent_date, push_type FROM tr")
def _(t):
    return campaign(t)


_TOOLS = f"tl AS (SELECT TRY_CAST(tool_id AS BIGINT) AS campaign_id, site FROM r_tools WHERE replace(lower(name), ' ', '') LIKE '%churncupon%' AND started BETWEEN {N} - 120 AND {N})"


@query("fb_campaign_tools", f"WITH {_TOOLS} SELECT * FROM tl")
def _(t):
    return tools(t)


_USERS = f"cu AS (SELECT DISTINCT p.buyer_id AS customer_id, p.site, {N} AS sent_date FROM r_wallet p JOIN r_coupons c USING (payment_id, buyer_id) JOIN tl ON tl.campaign_id = c.campaign_id AND tl.site = p.site WHERE p.status = 'approved' AND p.move_date BETWEEN {N} AND {N} + 1)"


@query("fb_coupon_users", f"""
    WITH {_TOOLS}, {_USERS}, old AS (SELECT DISTINCT customer_id, site, DATE '2024-01-15' AS sent_date FROM r_customers WHERE segment = 'MACHINERY')
    SELECT customer_id, site, sent_date::VARCHAR AS sent_date FROM old UNION ALL SELECT customer_id, site, sent_date::VARCHAR FROM cu WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.customer_id = cu.customer_id AND old.site = cu.site AND old.sent_date = cu.sent_date)""")
def _(t):
    users = cp.coupon_users(t.wallet, t.coupons, tools(t), date_lit("2024-01-15"))
    old = t.customers.where("segment = 'MACHINERY'").select("customer_id", "site", date_lit("2024-01-15").alias("sent_date"))
    return keyed.append_absent(old, users, ["customer_id", "site", "sent_date"])


_BOUGHT = "bo AS (SELECT DISTINCT buyer_id AS customer_id, site, created FROM r_purchases WHERE status = 'paid' AND closed BETWEEN created AND created + 4)"
_PERS = f"""{_TOOLS}, {_USERS}, {_TRACK}, {_BOUGHT}, ops AS (SELECT DISTINCT c.customer_id, c.site, c.sent_date FROM tr b JOIN tr c ON c.customer_id = b.customer_id AND c.site = b.site WHERE b.push_type = 'open' AND b.sent_date BETWEEN c.sent_date AND c.sent_date + 1),
    co AS (SELECT DISTINCT o.customer_id, o.site, o.sent_date FROM ops o JOIN bo ON bo.customer_id = o.customer_id AND bo.site = o.site AND bo.created BETWEEN o.sent_date AND o.sent_date + 1),
    cs AS (SELECT DISTINCT s.customer_id, s.site, s.sent_date FROM cu JOIN tr s ON s.customer_id = cu.customer_id AND s.site = cu.site AND s.sent_date = cu.sent_date AND s.push_type = 'sent'),
    pe AS (SELECT customer_id, site, sent_date, max(grp) AS grp FROM (SELECT *, 'TG' AS grp FROM co UNION ALL SELECT *, 'TG' FROM cs UNION ALL SELECT customer_id, site, sent_date, 'CG' FROM tr WHERE push_type = 'control') GROUP BY 1, 2, 3)"""


def persuaded(t):
    users = cp.coupon_users(t.wallet, t.coupons, tools(t), date_lit("2024-01-15"))
    return cp.persuaded(campaign(t), t.purchases, users)


@query("fb_persuaded", f"WITH {_PERS} SELECT customer_id, site, sent_date::VARCHAR AS sent_date, grp FROM pe")
def _(t):
    return persuaded(t)


@query("fb_campaign_covariates", f"""
    WITH {_PERS}, oo AS (SELECT buyer_id AS customer_id, site, created, least(amount, 400) AS money FROM r_purchases WHERE status = 'paid' AND closed BETWEEN created AND created + 4),
    r AS (SELECT pe.customer_id, pe.site, pe.sent_date, count(DISTINCT created) AS freq_rfm, min(created) AS first_purchase, max(created) AS last_purchase, sum(money)::DOUBLE / count(*) AS amount_mean FROM pe JOIN oo ON oo.customer_id = pe.customer_id AND oo.site = pe.site AND created BETWEEN sent_date - 365 AND sent_date - 1 GROUP BY 1, 2, 3),
    i AS (SELECT pe.customer_id, pe.site, pe.sent_date, count(DISTINCT created) AS freq_7d, sum(money)::DOUBLE AS amount_7d FROM pe JOIN oo ON oo.customer_id = pe.customer_id AND oo.site = pe.site AND created BETWEEN sent_date AND sent_date + 6 GROUP BY 1, 2, 3),
    v AS (SELECT pe.customer_id, pe.site, pe.sent_date, max(log_date) AS last_visit, count(*) AS active_days FROM pe JOIN r_visits x ON x.customer_id = pe.customer_id AND x.site = pe.site AND log_date BETWEEN sent_date - 90 AND sent_date - 1 GROUP BY 1, 2, 3)
    SELECT pe.customer_id, site, pe.sent_date::VARCHAR AS sent_date, grp, COALESCE(freq_rfm, 0) AS freq_rfm, first_purchase::VARCHAR AS first_purchase, last_purchase::VARCHAR AS last_purchase, round(amount_mean, 6) AS amount_mean,
      COALESCE(freq_7d, 0) AS freq_7d, amount_7d, last_visit::VARCHAR AS last_visit, COALESCE(active_days, 0) AS active_days
    FROM pe LEFT JOIN r USING (customer_id, site, sent_date) LEFT JOIN i USING (customer_id, site, sent_date) LEFT JOIN v USING (customer_id, site, sent_date)""")
def _(t):
    return r6(cp.covariates(persuaded(t), t.purchases, t.visits))


_FC = "fc AS (SELECT customer_id, site, log_date, max_price AS amount_pred, checkout AS freq_pred FROM r_visits WHERE site = 'O' OR log_date < DATE '2024-01-08')"


def forecasts(t):
    rows = t.visits.where("site = 'O' OR log_date < DATE '2024-01-08'")
    return rows.select("customer_id", "site", "log_date", F.col("max_price").alias("amount_pred"), F.col("checkout").alias("freq_pred"))


def _due(n: int) -> str:
    return f"SELECT DISTINCT s.customer_id, s.site, s.sent_date, s.sent_date + {n} AS log_date, amount_pred, freq_pred FROM tr s JOIN fc ON fc.customer_id = s.customer_id AND fc.site = s.site AND fc.log_date = s.sent_date + {n} WHERE push_type IN ('sent', 'control')"


@query("fb_campaign_forecast", f"""
    WITH {_TRACK}, {_FC}, a AS ({_due(7)}), b AS ({_due(6)}), x AS (SELECT * FROM a UNION ALL SELECT * FROM b WHERE site NOT IN (SELECT site FROM a))
    SELECT customer_id, site, sent_date::VARCHAR AS sent_date, log_date::VARCHAR AS log_date, amount_pred::DOUBLE AS amount_pred, freq_pred FROM x""")
def _(t):
    return cp.forecasts_with_fallback(campaign(t), forecasts(t), 7).select("customer_id", "site", "sent_date", "log_date", "amount_pred", "freq_pred")


_GROUPS = "g AS (SELECT customer_id, CASE customer_id % 4 WHEN 0 THEN 'CG' WHEN 1 THEN 'D1' WHEN 2 THEN 'D2' ELSE 'D3' END AS grp FROM r_customers)"


def groups(t):
    n = F.col("customer_id") % 4
    return t.customers.select("customer_id", F.when(n == 0, "CG").when(n == 1, "D1").when(n == 2, "D2").otherwise("D3").alias("grp"))


def daily_buyers(t):
    buyers = t.purchases.where("status = 'paid'").select(F.col("buyer_id").alias("customer_id"), F.col("created").alias("day"))
    return cp.daily_group_buyers(buyers, groups(t), ["CG", "D1", "D2", "D3"])


_DG = f"{_GROUPS}, dg AS (SELECT created AS day, " + ", ".join(f"count(DISTINCT buyer_id) FILTER (grp = '{x}') AS {x}" for x in ["CG", "D1", "D2", "D3"]) + " FROM r_purchases JOIN g ON g.customer_id = buyer_id WHERE status = 'paid' GROUP BY 1)"


@query("fb_daily_group_frequency", f"WITH {_DG} SELECT day::VARCHAR AS day, CG, D1, D2, D3 FROM dg")
def _(t):
    return daily_buyers(t)


@query("xp_funnel", """
    WITH c AS (SELECT sent_date, count(*) FILTER (push_type = 'sent') AS sent, count(*) FILTER (push_type = 'shown') AS shown, count(*) FILTER (push_type = 'open') AS open, count(*) FILTER (push_type = 'control') AS control FROM r_pushes GROUP BY 1)
    SELECT sent_date::VARCHAR AS sent_date, sent, shown, open, control, round(open::DOUBLE / nullif(shown, 0), 6) AS open_rate, round(shown::DOUBLE / nullif(sent, 0), 6) AS exposure FROM c""")
def _(t):
    kinds = ["sent", "shown", "open", "control"]
    wide = t.pushes.groupBy("sent_date").pivot("push_type", kinds).agg(F.count(F.lit(1))).na.fill(0)
    return wide.select("sent_date", *kinds, rounded(ratio("open", "shown")).alias("open_rate"), rounded(ratio("shown", "sent")).alias("exposure"))


@query("xp_scored_conversion", f"""
    WITH {_SENT}, sc AS (SELECT customer_id, log_date, max_price AS score FROM r_visits)
    SELECT s.customer_id, s.sent_date::VARCHAR AS sent_date, s.push_type, max(sc.score)::DOUBLE AS score, max(CASE WHEN o.buyer_id IS NULL THEN 0 ELSE 1 END)::BIGINT AS bought FROM sent s
    LEFT JOIN sc ON sc.customer_id = s.customer_id AND sc.log_date = s.sent_date LEFT JOIN r_purchases o ON o.buyer_id = s.customer_id AND o.site = s.site AND o.status = 'paid' AND o.closed BETWEEN o.created AND o.created + 4 AND o.created = s.sent_date GROUP BY 1, 2, 3""")
def _(t):
    scores = t.visits.groupBy("customer_id", F.col("log_date").alias("sent_date")).agg(F.max("max_price").alias("score"))
    bought = ps.same_day_orders(t.purchases).withColumn("bought", F.lit(1))
    rows = sent(t).join(scores, ["customer_id", "sent_date"], "left").join(bought, ["customer_id", "site", "sent_date"], "left")
    return rows.select("customer_id", "sent_date", "push_type", "score", F.coalesce("bought", F.lit(0)).alias("bought"))


@query("xp_buyers_by_group", f"""
    WITH {_TRACK}, {_BOUGHT} SELECT tr.site, push_type, count(DISTINCT tr.customer_id) AS buyers FROM tr JOIN bo ON bo.customer_id = tr.customer_id AND bo.site = tr.site AND bo.created BETWEEN sent_date AND sent_date + 1
    WHERE push_type IN ('sent', 'control') GROUP BY 1, 2""")
def _(t):
    return cp.buyers_by_group(campaign(t), t.purchases)


_SPEND = f"{_TOOLS}, sp AS (SELECT p.site, p.move_date AS day, sum(coupon_amount) AS amount FROM r_wallet p JOIN r_coupons c USING (payment_id, buyer_id) JOIN tl ON tl.campaign_id = c.campaign_id AND tl.site = p.site WHERE p.status = 'approved' GROUP BY 1, 2)"


@query("xp_spend", f"WITH {_SPEND} SELECT site, sum(amount)::DOUBLE AS amount FROM sp WHERE day BETWEEN {N} AND {N} + 1 GROUP BY 1")
def _(t):
    return cp.spend_by_site(t.wallet, t.coupons, tools(t), date_lit("2024-01-15"), date_lit("2024-01-16"))


_RATES = "fx AS (SELECT site, day, round(avg(value)::DOUBLE, 4) AS rate FROM r_events GROUP BY 1, 2)"


def rates(t):
    mean = F.sum("value").cast("double") / F.count("value")
    return t.events.groupBy("site", "day").agg(rounded(mean, 4).alias("rate"))


@query("xp_fx_rate", f"WITH {_TRACK}, {_RATES} SELECT fx.site, fx.day::VARCHAR AS day, rate FROM fx JOIN (SELECT site, max(sent_date) AS day FROM tr GROUP BY 1) m ON m.site = fx.site AND m.day = fx.day")
def _(t):
    return cp.rate_at_last_send(rates(t), campaign(t))


@query("xp_result_row", f"""
    WITH {_SPEND}, {_TRACK}, {_BOUGHT}, {_RATES}, c AS (SELECT site, sent_date, count(*) FILTER (push_type = 'sent') AS sent, count(*) FILTER (push_type = 'shown') AS shown, count(*) FILTER (push_type = 'open') AS open, count(*) FILTER (push_type = 'control') AS control FROM tr GROUP BY 1, 2),
    b AS (SELECT tr.site, tr.sent_date, count(DISTINCT tr.customer_id) FILTER (push_type = 'sent') AS buyers_sent, count(DISTINCT tr.customer_id) FILTER (push_type = 'control') AS buyers_control FROM tr JOIN bo ON bo.customer_id = tr.customer_id AND bo.site = tr.site AND bo.created BETWEEN sent_date AND sent_date + 1 GROUP BY 1, 2)
    SELECT c.site, c.sent_date::VARCHAR AS sent_date, sent, shown, open, control, COALESCE(buyers_sent, 0) AS buyers_sent, COALESCE(buyers_control, 0) AS buyers_control, amount::DOUBLE AS amount, rate,
      round(open::DOUBLE / nullif(shown, 0), 6) AS open_rate, round(shown::DOUBLE / nullif(sent, 0), 6) AS exposure
    FROM c LEFT JOIN b USING (site, sent_date) LEFT JOIN sp ON sp.site = c.site AND sp.day = c.sent_date LEFT JOIN fx ON fx.site = c.site AND fx.day = c.sent_date""")
def _(t):
    spend = cp.coupon_payments(t.wallet, t.coupons, tools(t)).groupBy("site", F.col("move_date").alias("day")).agg(F.sum("coupon_amount").alias("amount"))
    rows = cp.result_rows(campaign(t), t.purchases, spend, rates(t))
    return rows.withColumns({c: rounded(c) for c in ("open_rate", "exposure")})
