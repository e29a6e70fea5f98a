"""SQL twins of the role bindings, for the oracle queries.

`oracle(text)` puts the roles a text refers to in front of it as common table
expressions, so each oracle query is one self-contained SQL statement.
"""

from __future__ import annotations

import re

ROLES = {
    "r_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS buyer_id,
               CASE WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE 'paid' END AS status,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount, CAST(o_orderdate AS DATE) AS created,
               o_orderpriority AS channel, o_orderstatus AS status_code
        FROM orders""",
    "r_lines": """
        SELECT o_custkey AS buyer_id, l_suppkey AS seller_id, o_orderkey AS order_id,
               l_linenumber AS line_no, l_partkey AS item_id,
               CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey // 2 END AS pack_id,
               CASE WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE 'paid' END AS status,
               l_linestatus AS site, CAST(l_extendedprice / 10 AS DECIMAL(18,3)) AS amount,
               CAST(l_quantity AS BIGINT) AS items, CAST(o_orderdate AS DATE) AS created,
               CAST(o_orderdate AS DATE) + (l_linenumber - 1) AS closed,
               l_tax = 0.08 AS auto_offer, l_discount = 0 AS bonus, l_returnflag = 'A' AS grocery,
               CASE l_returnflag WHEN 'N' THEN 'new' WHEN 'R' THEN 'used' ELSE 'unknown' END AS item_condition,
               o_orderpriority AS channel
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "r_valid": """
        SELECT * FROM r_lines
        WHERE status = 'paid' AND site = 'O' AND amount < 10000
          AND closed BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'
          AND created >= closed - 4 AND NOT auto_offer AND NOT bonus""",
    "r_population": "SELECT DISTINCT buyer_id AS customer_id FROM r_valid",
    "r_daily": """
        SELECT buyer_id AS customer_id, created AS day, sum(amount) AS sales,
               CAST(sum(items) AS BIGINT) AS items,
               count(DISTINCT COALESCE(pack_id, order_id)) AS orders
        FROM r_valid GROUP BY 1, 2""",
    "r_devices": """
        SELECT * FROM (VALUES ('1-URGENT','Desktop','web'), ('2-HIGH','Mobile-WEB','web'),
                              ('3-MEDIUM','Mobile-APP','android'), ('4-NOT SPECIFIED','Mobile-APP','iphone'))
             AS t(channel, device_kind, device_app)""",
    "r_shipments": """
        SELECT o_orderkey AS shipment_id, o_orderkey // 2 AS cart_id, CAST(o_orderdate AS DATE) + 1 AS shipped,
               CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'return' ELSE 'forward' END AS kind,
               CASE WHEN o_orderpriority < '3' THEN 1 END AS free_flag, o_orderkey % 2 AS cart_type,
               CASE WHEN o_orderstatus = 'F' THEN 'drop_off' ELSE 'cross_docking' END AS picking,
               CAST(o_orderkey % 25 AS INTEGER) AS address_id
        FROM orders WHERE o_orderpriority <> '5-LOW'""",
    "r_addresses": """
        SELECT n_nationkey AS address_id,
               CASE WHEN n_nationkey % 2 = 0 THEN 'México ' ELSE 'MEXICO ' END || n_name AS state_name,
               CASE WHEN n_nationkey % 4 = 0 THEN 'n/a' ELSE CAST(n_nationkey + 1000 AS VARCHAR) END AS zip_code
        FROM nation WHERE n_regionkey <> 4""",
    "r_payments": """
        SELECT o_orderkey * 8 + l_linenumber AS payment_id, o_custkey AS buyer_id, l_linestatus || ' ' AS site,
               CAST(o_orderdate AS DATE) AS move_date,
               CASE WHEN o_orderstatus = 'P' THEN 'rejected' ELSE 'approved' END AS status,
               CASE o_orderpriority WHEN '1-URGENT' THEN 'Ticket' WHEN '2-HIGH' THEN 'account_money'
                    WHEN '3-MEDIUM' THEN 'debit_card' WHEN '4-NOT SPECIFIED' THEN 'credit_card'
                    WHEN '5-LOW' THEN 'ticket' END AS method,
               l_linenumber AS installments,
               CAST(l_extendedprice / 10 * (1 + l_tax) AS DECIMAL(18,3)) AS total_paid,
               CAST(l_extendedprice / 10 AS DECIMAL(18,3)) AS price,
               CASE WHEN l_returnflag = 'A' THEN 'N ' ELSE 'Y ' END AS marketplace,
               CASE WHEN l_quantity <> 50 THEN o_orderkey END AS order_id,
               CASE WHEN l_returnflag = 'R' THEN 'x' || l_partkey ELSE CAST(l_partkey AS VARCHAR) END AS first_digits,
               CASE l_returnflag WHEN 'A' THEN 'Account Fund' WHEN 'N' THEN 'Wallet' WHEN 'R' THEN 'Aggregator' END AS segment,
               CASE WHEN l_linenumber <> 7 THEN 1 ELSE 0 END AS tpv_flag, l_discount AS discount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "r_order_bonus": """
        SELECT o_orderkey AS order_id, o_orderpriority = '1-URGENT' AS bonus_flag
        FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'""",
    "r_cards": """
        SELECT p_partkey AS bin, p_brand AS country, p_type AS category,
               CASE WHEN p_size <= 25 THEN 'CREDIT' ELSE 'PREPAID' END AS card_type FROM part""",
    "r_customers": """
        SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'O' END AS site,
               DATE '1995-01-01' + CAST(c_custkey % 1500 AS INTEGER) AS registered,
               DATE '2023-11-15' + CAST(c_custkey % 75 AS INTEGER) AS joined,
               CASE WHEN c_acctbal < 0 THEN 'inactive' ELSE 'active' END AS status,
               c_name AS nickname, c_mktsegment AS segment, CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
               c_nationkey AS nation_id
        FROM customer""",
    "r_events": """
        SELECT event_id, user_id AS customer_id, CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'O' END AS site,
               ts, CAST(ts AS DATE) AS day, event_type, CAST(value AS DECIMAL(18,2)) AS value,
               TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, props
        FROM events""",
    "r_visits": """
        SELECT customer_id, site, day AS log_date, count(DISTINCT k) AS category_count,
               count(*) FILTER (event_type = 'view') AS view_android, count(*) FILTER (event_type = 'click') AS view_ios,
               count(*) FILTER (event_type = 'error') AS view_desktop, count(*) FILTER (event_type = 'signup') AS view_web,
               count(*) FILTER (event_type = 'purchase') AS buy_intention, count(*) FILTER (k < 10) AS question,
               count(*) FILTER (value > 30) AS checkout, count(*) FILTER (value BETWEEN 10 AND 30) AS add_to_cart,
               count(*) FILTER (k >= 90) AS bookmark, min(value) AS min_price, max(value) AS max_price,
               CAST(sum(value) AS DOUBLE) / count(value) AS avg_price
        FROM r_events GROUP BY 1, 2, 3""",
    "r_pushes": """
        SELECT customer_id, site, day AS sent_date,
               CASE event_type WHEN 'error' THEN 'sent' WHEN 'signup' THEN 'control'
                    WHEN 'view' THEN 'shown' WHEN 'click' THEN 'open' END AS push_type,
               CASE WHEN k < 50 THEN 'NEWBUYERS_A' ELSE 'OTHER_B' END AS batch_id, event_id
        FROM r_events WHERE event_type <> 'purchase'""",
    "r_purchases": """
        SELECT event_id AS order_id, customer_id AS buyer_id, site, day AS created,
               day + CAST(event_id % 7 AS INTEGER) AS closed,
               CASE WHEN k < 90 THEN 'paid' ELSE 'cancelled' END AS status, value AS amount, k AS category_id
        FROM r_events WHERE event_type = 'purchase'""",
    "r_installs": """
        SELECT customer_id, site, day AS install_date, CASE WHEN k < 50 THEN 'A' ELSE 'B' END AS app,
               CASE WHEN k % 3 = 0 THEN 'ios' ELSE 'android' END AS os_name
        FROM r_events WHERE event_type = 'signup'""",
    "r_app_devices": """
        SELECT customer_id, site, day AS created, CASE WHEN k % 3 = 0 THEN 'ios' ELSE 'android' END AS platform,
               CASE WHEN k < 80 THEN 'ACTIVE' ELSE 'REMOVED' END AS status,
               CASE WHEN k < 50 THEN 'A' ELSE 'B' END AS app
        FROM r_events WHERE event_type = 'click'""",
    "r_wallet": """
        SELECT event_id AS payment_id, customer_id AS buyer_id, site, day AS move_date, value AS amount,
               CASE WHEN k < 25 THEN 'Account Fund' WHEN k < 50 THEN 'Wallet' WHEN k < 75 THEN 'Aggregator'
                    WHEN k < 90 THEN 'Point' ELSE 'Point Device Sale' END AS segment,
               CASE WHEN k < 95 THEN 'approved' ELSE 'rejected' END AS status
        FROM r_events WHERE event_type IN ('purchase', 'click')""",
    "r_coupons": """
        SELECT event_id AS payment_id, customer_id AS buyer_id, k % 8 AS campaign_id,
               CAST((k % 4 + 1) * 5 AS DECIMAL(18,2)) AS coupon_amount
        FROM r_events WHERE event_type = 'purchase' AND k < 60""",
    "r_tools": """
        SELECT CAST(n_nationkey AS VARCHAR) AS tool_id, CASE WHEN n_nationkey % 2 = 0 THEN 'F' ELSE 'O' END AS site,
               CASE WHEN n_nationkey < 6 THEN 'Churn Cupon ' ELSE 'Other ' END || n_name AS name,
               DATE '2023-09-01' + n_nationkey * 5 AS started,
               CAST(n_nationkey * 100 + 500 AS BIGINT) AS budget
        FROM nation""",
}


def _needed(text: str, found: list[str]) -> None:
    for name in ROLES:
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(ROLES[name], found)
            if name not in found:
                found.append(name)


def oracle(text: str) -> str:
    found: list[str] = []
    _needed(text, found)
    text = text.strip()
    if not found:
        return text
    head = ",\n".join(f"{name} AS ({ROLES[name].strip()})" for name in found)
    if re.match(r"(?i)with\s", text):
        recursive = re.match(r"(?i)with\s+recursive\s", text)
        rest = re.sub(r"(?i)^with\s+(recursive\s+)?", "", text)
        return f"WITH {'RECURSIVE ' if recursive else ''}{head},\n{rest}"
    return f"WITH {head}\n{text}"
