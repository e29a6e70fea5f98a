"""Queries of the scalar functions, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyloom.functions import arrays, dates, text
from tallyloom.functions.columns import date_lit, rounded
from tallyloom.plans.registry import query

REF = "1998-12-31"


@query("fn_date_diff", f"SELECT order_id, (DATE '{REF}' - created)::BIGINT AS days FROM r_orders")
def _(t):
    return t.orders.select("order_id", F.datediff(date_lit(REF), "created").alias("days"))


@query("fn_date_add_sub", "SELECT order_id, (created - 30)::VARCHAR AS before, (created + 4)::VARCHAR AS later, (created + INTERVAL 3 MONTH)::DATE::VARCHAR AS quarter FROM r_orders")
def _(t):
    return t.orders.select("order_id", F.date_sub("created", 30).alias("before"), F.date_add("created", 4).alias("later"), F.add_months("created", 3).alias("quarter"))


@query("fn_date_trunc", "SELECT order_id, date_trunc('month', created)::DATE::VARCHAR AS month, (created - dayofweek(created)::INT)::VARCHAR AS week FROM r_orders")
def _(t):
    return t.orders.select("order_id", dates.month_start("created").alias("month"), dates.week_start_sunday("created").alias("week"))


@query("fn_period_week", "SELECT order_id, date_trunc('week', created)::DATE::VARCHAR AS week FROM r_orders")
def _(t):
    return t.orders.select("order_id", dates.week_start_monday("created").alias("week"))


@query("fn_dayofweek", "SELECT order_id, dayofweek(created) + 1 AS dow, CASE WHEN dayofweek(created) IN (0, 5, 6) THEN 1::BIGINT ELSE 0 END AS weekend FROM r_orders")
def _(t):
    return t.orders.select("order_id", F.dayofweek("created").alias("dow"), dates.is_weekend("created").alias("weekend"))


@query("fn_weekday", "SELECT order_id, isodow(created) - 1 AS weekday FROM r_orders")
def _(t):
    return t.orders.select("order_id", F.weekday("created").alias("weekday"))


@query("fn_year_boundary_diff", f"SELECT customer_id, year(DATE '{REF}') - year(registered) AS years FROM r_customers")
def _(t):
    return t.customers.select("customer_id", dates.year_boundaries(date_lit(REF), "registered").alias("years"))


@query("fn_month_key", "SELECT order_id, strftime(created, '%Y%m') AS month FROM r_orders")
def _(t):
    return t.orders.select("order_id", dates.month_key("created").alias("month"))


@query("fn_strip_zone", """
    SELECT event_id, CASE WHEN k >= 90 THEN NULL WHEN k % 2 = 0 THEN strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS naive FROM r_events""")
def _(t):
    zone = F.when(F.col("k") % 2 == 0, "+03:00").otherwise("Z")
    written = F.when(F.col("k") >= 90, "not a time").otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), zone))
    return t.events.select("event_id", dates.naive_timestamp(written).alias("naive"))


@query("fn_weeks_between", f"SELECT order_id, floor((DATE '{REF}' - created) / 7)::BIGINT AS weeks FROM r_orders WHERE created <= DATE '{REF}'")
def _(t):
    return t.orders.where(F.col("created") <= date_lit(REF)).select("order_id", dates.whole_weeks(date_lit(REF), "created").alias("weeks"))


_YEARLY = """
    WITH d AS (SELECT order_id, created, make_date(year(created), 5, 28) a, make_date(year(created), 7, 16) b, make_date(year(created), 12, 20) c FROM r_orders),
    l AS (SELECT order_id, created, CASE WHEN a > created THEN (a - INTERVAL 1 YEAR)::DATE ELSE a END a, CASE WHEN b > created THEN (b - INTERVAL 1 YEAR)::DATE ELSE b END b,
                 CASE WHEN c > created THEN (c - INTERVAL 1 YEAR)::DATE ELSE c END c FROM d)
    SELECT order_id, a::VARCHAR AS last_may, greatest(a, b, c)::VARCHAR AS nearest FROM l"""


@query("fn_last_occurrence", _YEARLY)
def _(t):
    d = F.col("created")
    days = [dates.last_yearly(d, m, n) for m, n in [(5, 28), (7, 16), (12, 20)]]
    return t.orders.select("order_id", days[0].alias("last_may"), dates.nearest_date(days, d).alias("nearest"))


@query("fn_date_range", "SELECT g.d::DATE::VARCHAR AS day, count(o.order_id) AS n FROM generate_series(DATE '1997-12-15', DATE '1998-12-31', INTERVAL 1 DAY) AS g(d) LEFT JOIN r_orders o ON o.created = g.d::DATE GROUP BY 1")
def _(t):
    days = dates.date_range(t.spark, "1997-12-15", "1998-12-31")
    counts = t.orders.groupBy(F.col("created").alias("day")).agg(F.count("*").alias("n"))
    return days.join(counts, "day", "left").na.fill(0)


@query("fn_coalesce_null0", "SELECT shipment_id, COALESCE(free_flag, 0)::BIGINT AS free FROM r_shipments")
def _(t):
    return t.shipments.select("shipment_id", F.coalesce("free_flag", F.lit(0)).alias("free"))


@query("fn_safe_cast", "SELECT payment_id, TRY_CAST(first_digits AS BIGINT) AS digits, TRY_CAST(segment AS DOUBLE) AS none FROM r_payments")
def _(t):
    return t.payments.select("payment_id", F.col("first_digits").try_cast("long").alias("digits"), F.col("segment").try_cast("double").alias("none"))


@query("fn_trim_lower", "SELECT payment_id, trim(site) AS site, lower(method) AS method, upper(segment) AS segment FROM r_payments")
def _(t):
    return t.payments.select("payment_id", F.trim("site").alias("site"), F.lower("method").alias("method"), F.upper("segment").alias("segment"))


@query("fn_replace_regex", r"""SELECT doc_id, replace(source, 'src', 's_') AS source, trim(regexp_replace(text, '[ \t\n\r\f\v]+', ' ', 'g'), ' ') AS squeezed, regexp_replace(lang || '1D_x', '1D.*', '1D') AS grp FROM documents""")
def _(t):
    return t.read("documents").select(
        "doc_id", F.replace(F.col("source"), F.lit("src"), F.lit("s_")).alias("source"), text.squeeze("text").alias("squeezed"),
        F.regexp_replace(F.concat("lang", F.lit("1D_x")), "1D.*", "1D").alias("grp"),
    )


_INCOME = "'De R$ ' || (1000 + customer_id % 5) || '.' || (100 + customer_id % 800) || ',50 a R$ ' || (customer_id % 9) || '.400,00'"


@query("fn_extract_max_number", f"SELECT customer_id, list_max(list_transform(regexp_extract_all(replace(replace({_INCOME}, '.', ''), ',', '.'), '[0-9]+(\\.[0-9]+)?'), lambda x: x::DOUBLE)) AS income FROM r_customers")
def _(t):
    c = F.col("customer_id")
    written = F.concat(F.lit("De R$ "), 1000 + c % 5, F.lit("."), 100 + c % 800, F.lit(",50 a R$ "), c % 9, F.lit(".400,00"))
    return t.customers.select("customer_id", text.max_number(written).alias("income"))


@query("fn_substr_concat_split", "SELECT customer_id, substr(nickname, 10, 9) AS digits, nickname || '|' || segment AS both_names, split_part(nickname, '#', 2) AS part FROM r_customers")
def _(t):
    return t.customers.select(
        "customer_id", F.substring("nickname", 10, 9).alias("digits"), F.concat("nickname", F.lit("|"), "segment").alias("both_names"),
        F.split_part("nickname", F.lit("#"), F.lit(2)).alias("part"),
    )


@query("fn_normalize_casefold", "SELECT doc_id, strip_accents(lower(text)) AS plain FROM documents")
def _(t):
    return t.read("documents").select("doc_id", text.casefold_plain("text").alias("plain"))


@query("fn_json_path", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM r_events")
def _(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("fn_struct_field", "SELECT order_id, buyer_id AS id, amount::DOUBLE AS price FROM r_orders")
def _(t):
    nested = t.orders.select("order_id", F.struct(F.col("buyer_id").alias("id")).alias("buyer"), F.struct(F.col("amount").alias("price")).alias("item"))
    return nested.select("order_id", "buyer.id", "item.price")


@query("fn_log10", "SELECT event_id, round(CASE WHEN k > 0 THEN log10(k) END, 6) AS lg FROM r_events")
def _(t):
    return t.events.select("event_id", rounded(F.log10("k")).alias("lg"))


@query("fn_greatest_least", "SELECT customer_id, log_date::VARCHAR AS log_date, greatest(view_android, view_ios, view_web) AS top, least(view_android, view_ios, view_web) AS low FROM r_visits")
def _(t):
    views = ["view_android", "view_ios", "view_web"]
    return t.visits.select("customer_id", "log_date", F.greatest(*views).alias("top"), F.least(*views).alias("low"))


@query("fn_round", "SELECT order_id, round(amount, 1)::DOUBLE AS half_up, round_even(amount, 0)::DOUBLE AS half_even FROM r_orders")
def _(t):
    return t.orders.select("order_id", F.round("amount", 1).alias("half_up"), F.bround("amount", 0).alias("half_even"))


@query("fn_human_format", "SELECT order_id, CASE WHEN v >= 1000 THEN printf('%.1fK', v / 1000) ELSE printf('%.1f', v) END AS label FROM (SELECT order_id, amount::DOUBLE AS v FROM r_orders)")
def _(t):
    return t.orders.select("order_id", text.human_number("amount").alias("label"))


_WORDS = "SELECT doc_id, string_split(text, ' ') AS w FROM documents"


@query("fn_array_ops", f"""
    WITH d AS ({_WORDS})
    SELECT doc_id, len(w) AS n, array_to_string(list_reverse(w)[1:5], ' ') AS last_words, array_to_string(list_transform(w[1:4], lambda x: lower(x)), ' ') AS first_words,
           len(list_filter(w, lambda x: len(x) > 6)) AS long_words FROM d""")
def _(t):
    w = F.split("text", " ")
    return t.read("documents").select(
        "doc_id", F.size(w).alias("n"), F.array_join(F.slice(F.reverse(w), 1, 5), " ").alias("last_words"),
        F.array_join(F.transform(F.slice(w, 1, 4), F.lower), " ").alias("first_words"), F.size(F.filter(w, lambda x: F.length(x) > 6)).alias("long_words"),
    )


@query("fn_pad_sequence", f"""
    WITH d AS ({_WORDS}), l AS (SELECT doc_id, list_transform(w, lambda x: len(x)) AS v FROM d)
    SELECT doc_id, array_to_string(list_concat(list_transform(range(greatest(50 - len(v), 0)), lambda x: 0::BIGINT), v[greatest(len(v) - 49, 1):]), ',') AS padded FROM l""")
def _(t):
    lengths = F.transform(F.split("text", " "), F.length)
    return t.read("documents").select("doc_id", arrays.pad_left(lengths, 50).alias("padded"))
