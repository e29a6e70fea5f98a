"""Queries of labels, experiments, causal effects and lifetime value."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions.columns import date_lit, rounded
from tallyloom.operators import causal as ce
from tallyloom.operators import labels as lb
from tallyloom.operators import ltv
from tallyloom.operators import state_space as sp
from tallyloom.operators.history import purchase_days
from tallyloom.operators.moments import collect_moments, ols
from tallyloom.operators.sampling import unit_hash
from tallyloom.plans import campaigns
from tallyloom.plans.common import r6
from tallyloom.plans.features import purchases_of
from tallyloom.plans.registry import query
from tallyloom.plans.segments import hx

# ------------------------------------------------------------ labels

_PF = """pf AS (SELECT c.customer_id, count(DISTINCT o.created) FILTER (o.created BETWEEN DATE '1997-07-01' AND DATE '1998-12-31') AS past, count(DISTINCT o.created) FILTER (o.created BETWEEN DATE '1999-01-01' AND DATE '1999-12-31') AS future
    FROM r_customers c LEFT JOIN r_orders o ON o.buyer_id = c.customer_id AND o.status = 'paid' GROUP BY 1)"""


def past_future(t):
    days = t.orders.where("status = 'paid'").select(F.col("buyer_id").alias("customer_id"), "created").distinct()
    day = F.col("created")
    counts = days.groupBy("customer_id").agg(
        F.count(F.when(day.between("1997-07-01", "1998-12-31"), 1)).alias("past"), F.count(F.when(day.between("1999-01-01", "1999-12-31"), 1)).alias("future"))
    return t.customers.select("customer_id").join(counts, "customer_id", "left").na.fill(0)


@query("lbl_churn_half", f"WITH {_PF} SELECT customer_id, past, future, (future < past // 2)::BIGINT AS label FROM pf")
def _(t):
    return past_future(t).withColumn("label", lb.churn_half("past", "future"))


@query("lbl_churn_band", f"WITH {_PF} SELECT customer_id, CASE WHEN past >= 6 AND future < past / 2.0 THEN 1::BIGINT WHEN past < 6 AND future = 0 THEN 1 ELSE 0 END AS label FROM pf WHERE past >= 2")
def _(t):
    return lb.at_least(past_future(t), "past", 2).select("customer_id", lb.churn_band("past", "future").alias("label"))


@query("lbl_growth", f"WITH {_PF} SELECT customer_id, CASE WHEN past >= 4 AND future >= 2 * past THEN 1::BIGINT WHEN past < 4 AND future >= 8 THEN 1 ELSE 0 END AS label FROM pf")
def _(t):
    return past_future(t).select("customer_id", lb.growth("past", "future").alias("label"))


# ------------------------------------------------------------ experiments

_U = f"""{_PF}, u AS (SELECT c.customer_id AS id, CASE c.customer_id % 4 WHEN 0 THEN 'CG' WHEN 1 THEN '1D_COMP' WHEN 2 THEN '1D_NON_COMP' ELSE '2D_COMP' END AS grp, CASE WHEN c.segment IN ('MACHINERY', 'BUILDING') THEN 1 ELSE 0 END AS w,
    (c.balance::DOUBLE + 1000) / 11000 * 0.8::DOUBLE + 0.1::DOUBLE AS e, CASE WHEN future > 1 THEN 1 ELSE 0 END AS outcome, future AS y, past AS x, CASE WHEN c.customer_id % 3 > 0 THEN 1 ELSE 0 END AS shown FROM r_customers c JOIN pf USING (customer_id)),
    r AS (SELECT *, regexp_replace(regexp_replace(grp, '1D.*', '1D'), '2D.*', '2D') AS g, CASE WHEN grp IN ('1D_COMP', '1D_NON_COMP') THEN 1 ELSE 0 END AS z, CASE WHEN grp = '1D_COMP' THEN 1 ELSE 0 END AS c FROM u)"""


def users(t):
    key = F.col("customer_id")
    n = key % 4
    rows = t.customers.select("customer_id", "segment", "balance").join(past_future(t), "customer_id")
    return rows.select(
        key.alias("id"), F.when(n == 0, "CG").when(n == 1, "1D_COMP").when(n == 2, "1D_NON_COMP").otherwise("2D_COMP").alias("grp"),
        F.col("segment").isin("MACHINERY", "BUILDING").cast("int").alias("w"), ((F.col("balance").cast("double") + 1000) / 11000 * 0.8 + 0.1).alias("e"),
        (F.col("future") > 1).cast("int").alias("outcome"), F.col("future").alias("y"), F.col("past").alias("x"), (key % 3 > 0).cast("int").alias("shown"),
    ).withColumns({
        "g": ce.collapse_groups("grp", ["1D", "2D"]), "z": F.col("grp").isin("1D_COMP", "1D_NON_COMP").cast("int"), "c": (F.col("grp") == "1D_COMP").cast("int"),
    })


@query("ce_group_collapse", f"WITH {_U} SELECT g, count(*) AS n FROM r GROUP BY 1")
def _(t):
    return users(t).groupBy("g").agg(F.count("*").alias("n"))


@query("ce_ate_z", f"""
    WITH {_U}, a AS (SELECT g, count(*) n, sum(outcome) y, sum(shown) s FROM r GROUP BY 1), b AS (SELECT n AS n0, y AS y0 FROM a WHERE g = 'CG'), p AS (SELECT *, y::DOUBLE / n - y0::DOUBLE / n0 AS ate, (y + y0)::DOUBLE / (n + n0) AS pp FROM a, b WHERE g <> 'CG')
    SELECT g AS grp, n AS sent, y::BIGINT AS converted, round(ate, 6) AS ate, round(ate * n, 6) AS incremental, round(ate / (s::DOUBLE / n), 6) AS cace, round(ate / sqrt(pp * (1 - pp) * (1.0::DOUBLE / n + 1.0::DOUBLE / n0)), 6) AS z FROM p""")
def _(t):
    return r6(ce.ab_effects(users(t), "g", "CG", "outcome", "shown"))


@query("ce_bayes_ab", f"""
    WITH {_U}, a AS (SELECT g, (sum(outcome) + 1)::DOUBLE a, (count(*) - sum(outcome) + 1)::DOUBLE b FROM r GROUP BY 1), m AS (SELECT *, a / (a + b) m, a * b / ((a + b) * (a + b) * (a + b + 1)) v FROM a), c AS (SELECT m AS m0, v AS v0 FROM m WHERE g = 'CG')
    SELECT g AS grp, a::BIGINT AS a, b::BIGINT AS b, round(m - m0, 6) AS mean, round(v + v0, 8) AS variance FROM m, c WHERE g <> 'CG'""")
def _(t):
    rows = ce.beta_posterior(users(t), "g", "CG", "outcome")
    return rows.select("grp", "a", "b", rounded("mean").alias("mean"), rounded("variance", 8).alias("variance"))


@query("ce_exp_rate_posterior", "SELECT event_type, count(value) AS n, round((count(value) + 1) / (sum(value)::DOUBLE + 7.1::DOUBLE), 6) AS mean, round((count(value) + 1) / ((sum(value)::DOUBLE + 7.1::DOUBLE) * (sum(value)::DOUBLE + 7.1::DOUBLE)), 10) AS variance FROM r_events GROUP BY 1")
def _(t):
    rows = ce.exponential_rate_posterior(t.events, "event_type", "value")
    return rows.select("event_type", "n", rounded("mean").alias("mean"), rounded("variance", 10).alias("variance"))


@query("ce_cum_increment", f"WITH {campaigns._DG} SELECT day::VARCHAR AS day, " + ", ".join(f"sum({g} - CG) OVER (ORDER BY day)::BIGINT AS increment_{g}" for g in ("D1", "D2", "D3")) + " FROM dg")
def _(t):
    return ce.cumulative_increment(campaigns.daily_buyers(t), "day", "CG", ["D1", "D2", "D3"])


@query("ce_2sls", f"""
    WITH {_U}, m AS (SELECT count(*) n, covar_pop(z, y) zy, covar_pop(z, c) zx, var_pop(z) zz, var_pop(y) yy, var_pop(c) xx, covar_pop(c, y) xy FROM r WHERE g IN ('1D', 'CG')), b AS (SELECT *, zy / zx AS b FROM m),
    s AS (SELECT b, sqrt((yy - 2 * b * xy + b * b * xx) * zz / (zx * zx) / n) AS se FROM b) SELECT round(b, 6) AS estimate, round(se, 6) AS std_error, round(b / se, 6) AS z FROM s""")
def _(t):
    return r6(ce.two_stage(users(t).where(F.col("g").isin("1D", "CG")), "y", "c", "z"))


@query("ce_naive_diff", f"WITH {_U} SELECT round(avg(y) FILTER (w = 1) - avg(y) FILTER (w = 0), 6) AS ate FROM r")
def _(t):
    return r6(ce.naive_difference(users(t), "y", "w"))


# ------------------------------------------------------------ adjustment

_OLS = "ol AS (SELECT (covar_pop(w, y) * var_pop(x) - covar_pop(x, y) * covar_pop(w, x)) / (var_pop(w) * var_pop(x) - covar_pop(w, x) * covar_pop(w, x)) AS b FROM r)"


@query("ce_ols_adjust", f"WITH {_U}, {_OLS} SELECT round(b, 6) AS effect FROM ol")
def _(t):
    effect = ce.ols_effect(users(t), "y", "w", ["x"])["estimate"]
    return r6(t.spark.createDataFrame([(effect,)], "effect double"))


@query("ce_ols_table", f"WITH {_U} SELECT 'intercept' AS term, round(regr_intercept(y, x), 6) AS estimate FROM r UNION ALL SELECT 'x', round(regr_slope(y, x), 6) FROM r")
def _(t):
    fit = ols(collect_moments(users(t), ["x"], "y")[()], ["x"])
    return r6(t.spark.createDataFrame([(k, v["estimate"]) for k, v in fit.items()], "term string, estimate double"))


@query("ce_propensity")
def _(t):
    rows = users(t).withColumn("e2", F.col("e") * F.col("e"))
    return ce.propensity(rows, "w", ["x", "e", "e2"]).select("id", "w", "propensity")


_PSM = "cs AS (SELECT e, avg(y) c FROM r WHERE w = 0 GROUP BY 1), mt AS (SELECT t.id, t.y, cs.c, row_number() OVER (PARTITION BY t.id ORDER BY abs(t.e - cs.e), cs.e) rn FROM r t, cs WHERE t.w = 1), psm AS (SELECT sum(y - c) / count(*) AS v FROM mt WHERE rn = 1)"
_PSS = "nq AS (SELECT *, ntile(50) OVER (ORDER BY e, id) q FROM r), qq AS (SELECT q, count(*) FILTER (w = 1) n1, avg(y) FILTER (w = 1) - avg(y) FILTER (w = 0) d FROM nq GROUP BY 1), pss AS (SELECT sum(d * n1) / sum(n1) AS v FROM qq WHERE d IS NOT NULL)"
_IPW = "ipw AS (SELECT sum(w * y / e) / sum(w / e) - sum((1 - w) * y / (1 - e)) / sum((1 - w) / (1 - e)) AS v FROM r)"


@query("ce_psm", f"WITH {_U}, {_PSM} SELECT round(v, 6) AS att FROM psm")
def _(t):
    return r6(ce.match_nearest(users(t), "y", "w", "e"))


@query("ce_stratify", f"WITH {_U}, {_PSS} SELECT round(v, 6) AS att FROM pss")
def _(t):
    return r6(ce.stratify(users(t), "y", "w", "e", "id"))


@query("ce_ipw", f"WITH {_U}, {_IPW} SELECT round(v, 6) AS ate FROM ipw")
def _(t):
    return r6(ce.weight_inverse(users(t), "y", "w", "e"))


_TL = "tl AS (SELECT (regr_intercept(y, x) FILTER (w = 1) - regr_intercept(y, x) FILTER (w = 0)) + (regr_slope(y, x) FILTER (w = 1) - regr_slope(y, x) FILTER (w = 0)) * avg(x) AS v FROM r)"
_XL = """xb AS (SELECT regr_intercept(y, x) FILTER (w = 1) a1, regr_slope(y, x) FILTER (w = 1) b1, regr_intercept(y, x) FILTER (w = 0) a0, regr_slope(y, x) FILTER (w = 0) b0 FROM r),
    xd AS (SELECT r.*, CASE WHEN w = 1 THEN y - (a0 + b0 * x) ELSE a1 + b1 * x - y END AS d FROM r, xb), xt AS (SELECT regr_intercept(d, x) FILTER (w = 1) a1, regr_slope(d, x) FILTER (w = 1) b1, regr_intercept(d, x) FILTER (w = 0) a0, regr_slope(d, x) FILTER (w = 0) b0 FROM xd),
    xl AS (SELECT avg(e * (a0 + b0 * x) + (1 - e) * (a1 + b1 * x)) AS v FROM r, xt)"""
_RL = f"""rf AS (SELECT *, {hx('id', 'r')} % 5 AS k FROM r), rk AS (SELECT kk, regr_intercept(y, x) a, regr_slope(y, x) b FROM rf, range(5) q(kk) WHERE k <> kk GROUP BY 1),
    rr AS (SELECT x, y - (a + b * x) AS ry, w - e AS rw FROM rf JOIN rk ON kk = k), rs AS (SELECT sum(rw * rw) s0, sum(rw * rw * x) s1, sum(rw * rw * x * x) s2, sum(rw * ry) t0, sum(rw * ry * x) t1, avg(x) mx FROM rr),
    rl AS (SELECT (t0 * s2 - t1 * s1) / (s0 * s2 - s1 * s1) + (s0 * t1 - s1 * t0) / (s0 * s2 - s1 * s1) * mx AS v FROM rs)"""


@query("ce_s_t_x_r", f"WITH {_U}, {_OLS}, {_TL}, {_XL}, {_RL} SELECT 's_learner' AS learner, round(b, 6) AS effect FROM ol UNION ALL SELECT 't_learner', round(v, 6) FROM tl UNION ALL SELECT 'x_learner', round(v, 6) FROM xl UNION ALL SELECT 'r_learner', round(v, 6) FROM rl")
def _(t):
    rows = users(t).persist()
    out = [
        ("s_learner", ce.s_learner(rows, "y", "w", ["x"])), ("t_learner", ce.t_learner(rows, "y", "w", ["x"])),
        ("x_learner", ce.x_learner(rows, "y", "w", ["x"], "e")), ("r_learner", ce.r_learner(rows, "y", "w", ["x"], "e", "id")),
    ]
    rows.unpersist()
    return r6(t.spark.createDataFrame(out, "learner string, effect double"))


@query("ce_compare", f"""
    WITH {_U}, {_OLS}, {_TL}, {_XL}, {_RL}, {_PSM}, {_PSS}, {_IPW} SELECT method, round(v, 6) AS effect FROM (SELECT 'linear' AS method, b AS v FROM ol UNION ALL SELECT 's_learner', b FROM ol UNION ALL SELECT 't_learner', v FROM tl UNION ALL SELECT 'x_learner', v FROM xl UNION ALL SELECT 'r_learner', v FROM rl
    UNION ALL SELECT 'matching', v FROM psm UNION ALL SELECT 'stratification', v FROM pss UNION ALL SELECT 'ipw', v FROM ipw UNION ALL SELECT 'biased', avg(y) FILTER (w = 1) - avg(y) FILTER (w = 0) FROM r)""")
def _(t):
    return r6(ce.compare(users(t), "y", "w", ["x"], "e", "id"))


def _one(t, effect):
    return r6(t.spark.createDataFrame([(float(effect),)], "effect double"))


_SIMPLE = "(covar_pop({w}, {y}) * var_pop(x) - covar_pop(x, {y}) * covar_pop({w}, x)) / (var_pop({w}) * var_pop(x) - covar_pop({w}, x) * covar_pop({w}, x))"


@query("ce_refute_placebo", f"WITH {_U}, q AS (SELECT *, CASE WHEN {hx('id', 'placebo')} / 4294967296.0::DOUBLE < 0.5 THEN 1 ELSE 0 END AS pw FROM r) SELECT round({_SIMPLE.format(w='pw', y='y')}, 6) AS effect FROM q")
def _(t):
    return _one(t, ce.placebo(users(t), "id", "w", lambda df, w: ce.s_learner(df, "y", w, ["x"])))


@query("ce_refute_random_cause")
def _(t):
    return _one(t, ce.random_cause(users(t), "id", ["x"], lambda df, xs: ce.s_learner(df, "y", "w", xs)))


@query("ce_refute_dummy_outcome", f"WITH {_U}, q AS (SELECT *, -ln(1 - {hx('id', 'outcome')} / 4294967296.0::DOUBLE) * (SELECT avg(y) FROM r) AS dy FROM r) SELECT round({_SIMPLE.format(w='w', y='dy')}, 6) AS effect FROM q")
def _(t):
    return _one(t, ce.dummy_outcome(users(t), "id", "y", lambda df, y: ce.s_learner(df, y, "w", ["x"])))


@query("ce_selection_bias", f"""
    WITH {_U}, b AS (SELECT g, x, {hx('id', 'm')} % 2147483648 AS h FROM r) SELECT g, i AS sample, round(avg(x), 6) AS mean, count(*) AS n FROM b, range(1, 201) q(i) WHERE (h * ((1103515245 * (2 * i + 1)) % 2147483648)) % 2147483648 < 214748364 GROUP BY 1, 2""")
def _(t):
    return r6(ce.sample_means(users(t), "g", "x", "id"))


_SER = "se AS (SELECT channel, created AS day, count(*)::DOUBLE AS y, sum(amount)::DOUBLE AS x FROM r_orders GROUP BY 1, 2)"


@query("ce_series_impact", f"""
    WITH {_SER}, f AS (SELECT channel, regr_slope(y, x) b, regr_intercept(y, x) a FROM se WHERE day <= DATE '2000-12-31' GROUP BY 1), p AS (SELECT se.*, a + b * x AS e FROM se JOIN f USING (channel) WHERE day >= DATE '2001-01-15')
    SELECT channel, day::VARCHAR AS day, y, round(e, 6) AS expected, round(y - e, 6) AS effect, round(sum(y - e) OVER (PARTITION BY channel ORDER BY day), 6) AS cumulative FROM p""")
def _(t):
    return r6(ce.series_impact(daily_series(t), "channel", "day", "y", "x", date_lit("2000-12-31"), date_lit("2001-01-15")))


_LEVEL = f"""
    WITH RECURSIVE {_SER}, st AS (SELECT channel, avg(x) AS mx, COALESCE(nullif(stddev_pop(x), 0), 1) AS sx, avg(y) AS my, COALESCE(nullif(stddev_pop(y), 0), 1) AS sy, max(day) AS last_day, count(*) AS n FROM se WHERE day <= DATE '2000-12-31' GROUP BY 1),
    pre AS (SELECT channel, (x - mx) / sx AS z, (y - my) / sy AS v, row_number() OVER (PARTITION BY channel ORDER BY day) AS rn, COALESCE(day - lag(day) OVER (PARTITION BY channel ORDER BY day), 0)::DOUBLE AS gap FROM se JOIN st USING (channel) WHERE day <= DATE '2000-12-31'),
    kf(channel, q, rn, a1, a2, p11, p12, p22, ss, ld) AS (
      SELECT channel, q, 0::BIGINT, 0::DOUBLE, 0::DOUBLE, {sp.PRIOR}::DOUBLE, 0::DOUBLE, {sp.PRIOR}::DOUBLE, 0::DOUBLE, 0::DOUBLE FROM st, unnest([{", ".join(f"{r}::DOUBLE" for r in sp.RATIOS)}]) r(q)
      UNION ALL
      SELECT channel, q, rn, a1 + (r11 + z * p12) / f * e, a2 + (p12 + z * p22) / f * e, r11 - (r11 + z * p12) * (r11 + z * p12) / f, p12 - (r11 + z * p12) * (p12 + z * p22) / f, p22 - (p12 + z * p22) * (p12 + z * p22) / f, ss + e * e / f, ld + ln(f)
      FROM (SELECT *, r11 + 2 * z * p12 + z * z * p22 + 1 AS f, v - a1 - a2 * z AS e FROM (SELECT kf.channel, q, pre.rn, a1, a2, p11 + q * gap AS r11, p12, p22, ss, ld, z, v FROM kf JOIN pre ON pre.channel = kf.channel AND pre.rn = kf.rn + 1))),
    lk AS (SELECT *, ss / n AS noise, -n / 2.0 * ln(ss / n) - ld / 2 AS ll FROM kf JOIN st USING (channel) WHERE rn = n),
    ra AS (SELECT *, exp(ll - max(ll) OVER (PARTITION BY channel)) AS u FROM lk), we AS (SELECT * EXCLUDE (n, rn), u / sum(u) OVER (PARTITION BY channel) AS w FROM ra),
    po AS (SELECT we.*, day, y, (x - mx) / sx AS z, (day - last_day)::DOUBLE AS h, row_number() OVER (PARTITION BY channel, q ORDER BY day)::DOUBLE AS j FROM se JOIN we USING (channel) WHERE day >= DATE '2001-01-15'),
    ef AS (SELECT *, y - (my + sy * (a1 + a2 * z)) AS d, sy * sy * noise * (p11 + q * h + 2 * z * p12 + z * z * p22 + 1) AS dv FROM po),
    cu AS (SELECT *, sum(d) OVER o AS c, sum(z) OVER o AS zs, sum(h) OVER o AS hs, sum(j * h) OVER o AS jhs FROM ef WINDOW o AS (PARTITION BY channel, q ORDER BY day)),
    va AS (SELECT *, sy * sy * noise * (j * j * p11 + q * ((2 * j + 1) * hs - 2 * jhs) + 2 * j * zs * p12 + zs * zs * p22 + j) AS cv FROM cu),
    mi AS (SELECT channel, day, any_value(y) AS y, sum(w * d) AS effect, sqrt(greatest(sum(w * (dv + d * d)) - sum(w * d) ** 2, 0)) * {sp.NORMAL_95}::DOUBLE AS de, sum(w * c) AS cumulative, sqrt(greatest(sum(w * (cv + c * c)) - sum(w * c) ** 2, 0)) * {sp.NORMAL_95}::DOUBLE AS ce FROM va GROUP BY 1, 2)
    SELECT channel, day::VARCHAR AS day, y, round(y - effect, 4) AS expected, round(y - effect - de, 4) AS expected_low, round(y - effect + de, 4) AS expected_high, round(effect, 4) AS effect,
      round(cumulative, 4) AS cumulative, round(cumulative - ce, 4) AS cumulative_low, round(cumulative + ce, 4) AS cumulative_high FROM mi"""


def daily_series(t):
    return t.orders.groupBy("channel", F.col("created").alias("day")).agg(F.count("*").cast("double").alias("y"), F.sum("amount").cast("double").alias("x"))


@query("ce_series_level", _LEVEL)
def _(t):
    return r6(sp.level_impact(daily_series(t), "channel", "day", "y", "x", date_lit("2000-12-31"), date_lit("2001-01-15")), 4)


_INC = "SELECT site, count(*) FILTER (status = 'paid') AS treated, sum(amount)::DOUBLE / count(*) AS a, avg(k) AS p, sum(amount)::DOUBLE AS spend FROM (SELECT site, status, amount, category_id AS k FROM r_purchases) GROUP BY 1"


@query("ce_incremental_value", f"WITH i AS ({_INC}) SELECT site, round(a * treated, 4) AS inc_amount, round(a * treated * CASE site WHEN 'F' THEN 0.12::DOUBLE ELSE 0.1::DOUBLE END - spend / 4.0, 4) AS inc_revenue, round(p * treated, 4) AS inc_purchases FROM i")
def _(t):
    rows = t.purchases.groupBy("site").agg(
        F.count(F.when(F.col("status") == "paid", 1)).alias("treated"), (F.sum("amount").cast("double") / F.count("*")).alias("amount_effect"),
        F.avg("category_id").alias("purchase_effect"), F.sum("amount").cast("double").alias("spend"), F.lit(4.0).alias("rate"))
    return r6(ce.incremental_value(rows, {"F": 0.12, "O": 0.1}), 4)


@query("ce_add_interim", "SELECT customer_id, log_date::VARCHAR AS log_date, round(COALESCE(CASE WHEN bookmark > 0 THEN avg_price END, 0) + COALESCE(CASE WHEN question > 0 THEN checkout END, 0), 6) AS total FROM r_visits")
def _(t):
    rows = t.visits.select("customer_id", "log_date", F.when(F.col("bookmark") > 0, F.col("avg_price")).alias("p"), F.when(F.col("question") > 0, F.col("checkout")).alias("r"))
    return r6(ce.add_interim(rows, "p", "r", "total").drop("p", "r"))


# ------------------------------------------------------------ lifetime value

_E = "DATE '2000-12-31'"
_RFM = f"""wk AS (SELECT buyer_id AS customer_id, date_trunc('week', created)::DATE AS week, sum(amount) AS sales, max(created) AS last_day FROM r_lines WHERE status = 'paid' AND created <= {_E} GROUP BY 1, 2),
    rfm AS (SELECT customer_id, count(*) - 1 AS frequency, ((max(week) - min(week)) // 7)::BIGINT AS recency, ((date_trunc('week', {_E})::DATE - min(week)) // 7)::BIGINT AS age,
      COALESCE((sum(sales) - arg_min(sales, week))::DOUBLE / nullif(count(*) - 1, 0), 0) AS value, (({_E} - max(last_day)) // 7)::BIGINT AS weeks_since FROM wk GROUP BY 1)"""
PURCHASES = ltv.PurchaseModel(1.5, 60.0, 1.8, 4.0)
VALUES = ltv.ValueModel(3.0, 4.0, 5000.0)


def summary(t):
    return ltv.weekly_summary(purchase_days(purchases_of(t)), date_lit("2000-12-31"))


@query("ltv_rfm_summary", f"WITH {_RFM} SELECT customer_id, frequency, recency, age, round(value, 6) AS value, weeks_since FROM rfm")
def _(t):
    return r6(summary(t))


@query("ltv_btyd_fit")
def _(t):
    m = ltv.fit_purchases(summary(t), iterations=15)
    return ltv.parameter_table(t.spark, ["r", "alpha", "a", "b"], m.fit)


_PA = "pa AS (SELECT *, 1 / (1 + 1.8::DOUBLE / (4.0 + frequency) * pow((60.0 + age) / (60.0 + recency), 1.5::DOUBLE + frequency)) AS p_alive FROM rfm)"


@query("ltv_btyd_predict", f"""
    WITH {_RFM}, {_PA}, xs AS (SELECT DISTINCT frequency AS x, age AS t, 52.0::DOUBLE / (60.0 + age + 52) AS z FROM pa),
    tm AS (SELECT x, t, n, lgamma(1.5 + x + n) - lgamma(1.5 + x) + lgamma(5.0 + x + n) - lgamma(5.0 + x) + lgamma(5.8 + x) - lgamma(5.8 + x + n) - lgamma(n + 1.0) + n * ln(z) AS lt FROM xs, range(700) q(n)), hy AS (SELECT x, t, sum(exp(lt)) AS f FROM tm GROUP BY 1, 2)
    SELECT customer_id, round(p_alive, 6) AS p_alive, round(p_alive * (5.8 + frequency) / 0.8 * (1 - pow((60.0 + age) / (112.0 + age), 1.5 + frequency) * f), 6) AS purchases FROM pa JOIN hy ON x = frequency AND t = age""")
def _(t):
    return r6(summary(t).select("customer_id", ltv.p_alive(PURCHASES).alias("p_alive"), ltv.expected_purchases(PURCHASES).alias("purchases")))


@query("ltv_gg_fit")
def _(t):
    m = ltv.fit_values(summary(t), iterations=15)
    return ltv.parameter_table(t.spark, ["p", "q", "v"], m.fit)


_GG = "3.0::DOUBLE * (5000.0 + (frequency + 1) * v2) / (3.0 * (frequency + 1) + 3.0)"
_VAL = f"pv AS (SELECT *, CASE WHEN value > 0 THEN value ELSE (SELECT min(value) FROM rfm WHERE value > 0) END AS v2 FROM rfm), gg AS (SELECT *, {_GG} AS ev FROM pv)"


@query("ltv_gg_predict", f"WITH {_RFM}, {_VAL} SELECT customer_id, round(ev, 6) AS expected_value FROM gg")
def _(t):
    return r6(ltv.positive_values(summary(t)).select("customer_id", ltv.expected_value(VALUES, F.col("frequency") + 1).alias("expected_value")))


def scored(t):
    rows = ltv.positive_values(summary(t)).withColumn("p_alive", ltv.p_alive(PURCHASES))
    rows = rows.withColumns({"purchases": F.col("p_alive") * (F.col("frequency") + 1), "expected": ltv.expected_value(VALUES, F.col("frequency") + 1)})
    return ltv.lifetime_value(rows, "purchases", "expected")


_SC = f"{_RFM}, {_VAL}, sc AS (SELECT *, 1 / (1 + 1.8::DOUBLE / (4.0 + frequency) * pow((60.0 + age) / (60.0 + recency), 1.5::DOUBLE + frequency)) AS p_alive FROM gg), cl AS (SELECT *, p_alive * (frequency + 1) AS purchases, p_alive * (frequency + 1) * ev AS clv FROM sc)"


@query("ltv_clv", f"WITH {_SC} SELECT customer_id, round(clv, 4) AS clv, round(purchases * clv, 4) AS rank_score FROM cl")
def _(t):
    return r6(scored(t).select("customer_id", "clv", "rank_score"), 4)


@query("ltv_churned_year", f"WITH {_RFM} SELECT customer_id, weeks_since FROM rfm WHERE weeks_since > 52")
def _(t):
    return ltv.churned(summary(t)).select("customer_id", "weeks_since")


@query("ltv_output", f"""
    WITH {_SC}, al AS (SELECT *, row_number() OVER (ORDER BY purchases DESC, customer_id) rn, floor(count(*) OVER () * 0.2::DOUBLE) s FROM cl WHERE weeks_since <= 52)
    SELECT customer_id, frequency AS x_days_past_minus_1, age AS time_first_end, round(purchases, 4) AS x_days_pred, recency::DOUBLE AS time_first_last, round(p_alive, 4) AS p_alive_pred, round(v2, 4) AS sales_avg_past, round(clv, 4) AS sales_pred,
      CASE WHEN rn <= s THEN 'q1' WHEN rn <= 2 * s THEN 'q2' WHEN rn <= 3 * s THEN 'q3' WHEN rn <= 4 * s THEN 'q4' ELSE 'q5' END AS quintile, 'O' AS site, '200011' AS photo_id FROM al
    UNION ALL SELECT customer_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '-1', 'O', '200011' FROM cl WHERE weeks_since > 52""")
def _(t):
    rows = scored(t)
    return ltv.output_table(rows, ltv.churned(rows), "O", "200011")


@query("ltv_merge_scores", f"""
    WITH {_SC}, ch AS (SELECT customer_id, {hx('customer_id', 'churn')} / 4294967296.0::DOUBLE AS churn_score FROM r_customers WHERE segment <> 'BUILDING'), gr AS (SELECT customer_id, {hx('customer_id', 'growth')} / 4294967296.0::DOUBLE AS growth_score FROM r_customers WHERE segment = 'BUILDING'),
    m AS (SELECT customer_id, clv, COALESCE(churn_score, 0) AS churn_score, COALESCE(growth_score, 0) AS growth_score FROM cl LEFT JOIN ch USING (customer_id) LEFT JOIN gr USING (customer_id)), k AS (SELECT *, row_number() OVER (ORDER BY clv DESC, customer_id) rn, floor(count(*) OVER () * 0.2::DOUBLE) s FROM m)
    SELECT customer_id, round(churn_score, 6) AS churn_score, round(growth_score, 6) AS growth_score, CASE WHEN rn <= s THEN 'q1' WHEN rn <= 2 * s THEN 'q2' WHEN rn <= 3 * s THEN 'q3' WHEN rn <= 4 * s THEN 'q4' ELSE 'q5' END AS new_segment FROM k""")
def _(t):
    churn = t.customers.where("segment <> 'BUILDING'").select("customer_id", unit_hash("customer_id", "churn").alias("churn_score"))
    growth = t.customers.where("segment = 'BUILDING'").select("customer_id", unit_hash("customer_id", "growth").alias("growth_score"))
    return r6(ltv.merge_scores(scored(t).select("customer_id", "clv"), churn, growth, "clv").drop("clv"))
