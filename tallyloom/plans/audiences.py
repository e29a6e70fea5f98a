"""Queries of look-alike audiences and sequences."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tallyloom.operators import lookalike as lk
from tallyloom.operators import sequences as sq
from tallyloom.plans.common import r6
from tallyloom.plans.registry import query
from tallyloom.plans.segments import hx

# ------------------------------------------------------------ look-alike

_V = """v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e, CASE WHEN label = 3 THEN 1 ELSE 0 END AS target FROM embeddings), s AS (SELECT id AS seed_id, e AS f FROM v WHERE target = 1),
    d AS (SELECT id, seed_id, {distance} AS distance FROM v, s), nn AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, seed_id) AS place FROM d)"""
_COS = _V.format(distance="list_cosine_distance(e, f)")


def vectors(t):
    return lk.as_vectors(t.read("embeddings"), "vec_id", "embedding")


def seeds(t):
    return lk.as_vectors(t.read("embeddings").where("label = 3"), "vec_id", "embedding", "seed_id")


def targets(t):
    return t.read("embeddings").select(F.col("vec_id").alias("id"), (F.col("label") == 3).cast("int").alias("target"))


def near(t, k, metric="cosine"):
    return lk.nearest_seeds(vectors(t), seeds(t), k, metric)


@query("jn_knn", f"WITH {_COS} SELECT id, seed_id, place FROM nn WHERE place <= 5")
def _(t):
    return near(t, 5).select("id", "seed_id", "place")


@query("lk_knn", f"WITH {_COS} SELECT id, seed_id, abs(round(distance, 6)) AS distance, place FROM nn WHERE place <= 10")
def _(t):
    return r6(near(t, 10)).withColumn("distance", F.abs("distance"))


@query("lk_knn_l2", f"WITH {_V.format(distance='list_distance(e, f)')} SELECT id, seed_id, round(distance, 5) AS distance, place FROM nn WHERE place <= 10 AND distance > 0.001")
def _(t):
    return r6(near(t, 10, "l2").where("distance > 0.001"), 5)


@query("lk_knn_l1", f"WITH {_V.format(distance='list_sum(list_transform(list_zip(e, f), lambda x: abs(x[1] - x[2])))')} SELECT id, seed_id, round(distance, 6) AS distance, place FROM nn WHERE place <= 10")
def _(t):
    return r6(near(t, 10, "l1"))


@query("lk_knn_blocks", f"WITH {_COS} SELECT id, seed_id, abs(round(distance, 6)) AS distance, place FROM nn WHERE place <= 10")
def _(t):
    rows = lk.blocked_nearest(vectors(t), seeds(t), 10, block=200)
    return r6(rows).select("id", "seed_id", F.abs("distance").alias("distance"), "place")


@query("lk_mean_distance", f"WITH {_COS} SELECT id, round(avg(distance), 6) AS mean_distance FROM nn WHERE place <= 10 GROUP BY 1")
def _(t):
    return r6(lk.mean_distance(near(t, 10), 10))


@query("lk_frequency", f"WITH {_COS} SELECT seed_id, count(*) AS freq FROM nn WHERE place <= 10 GROUP BY 1")
def _(t):
    return lk.neighbour_frequency(near(t, 10))


_KS = [*range(1, 100, 10), *range(100, 3500, 100)]


@query("lk_k_curve", f"""
    WITH {_COS}, m AS (SELECT id, place AS k, avg(distance) OVER (PARTITION BY id ORDER BY place) AS mean FROM nn), x AS (SELECT * FROM m WHERE k IN ({", ".join(map(str, _KS))})), y AS (SELECT k, target, row_number() OVER (PARTITION BY k ORDER BY round(mean, 9), id) rn, sum(target) OVER (PARTITION BY k ORDER BY round(mean, 9), id ROWS UNBOUNDED PRECEDING) h FROM x JOIN v USING (id))
    SELECT k, round(avg(h::DOUBLE / rn), 6) AS map FROM y WHERE target = 1 GROUP BY 1""")
def _(t):
    return r6(lk.k_grid(vectors(t), seeds(t), targets(t), _KS))


@query("lk_lsh", f"WITH {_COS} SELECT id, seed_id, abs(round(distance, 6)) AS distance, place FROM nn WHERE place <= 10")
def _(t):
    return r6(lk.indexed_nearest(vectors(t), seeds(t), 10)).withColumn("distance", F.abs("distance"))


@query("lk_reduce")
def _(t):
    axes, center = lk.principal_axes(vectors(t), 16)
    rows, picked = lk.project(vectors(t), axes, center), lk.project(seeds(t), axes, center)
    return r6(lk.nearest_seeds(rows, picked, 10))


def drawn_subsets(n: int, dim: int) -> list[list[int]]:
    """Subsets of about half of the features, drawn by a seeded generator."""
    drawn = np.random.default_rng(11).random((n, dim)) < 0.5
    return [np.flatnonzero(row).tolist() or [0] for row in drawn]


@query("lk_feature_search")
def _(t):
    rows = vectors(t).join(targets(t), "id")
    subsets = [list(range(16)), list(range(16, 40)), list(range(0, 64, 2))] + drawn_subsets(997, 64)
    return r6(lk.feature_search(rows, seeds(t), subsets, 10))


@query("lk_seed_recall", f"""
    WITH {_COS}, m AS (SELECT id, target, avg(distance) AS md FROM nn JOIN v USING (id) WHERE place <= 10 GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (ORDER BY md, id) rn FROM m)
    SELECT round(count(*) FILTER (rn <= 100 AND target = 1)::DOUBLE / count(*) FILTER (target = 1), 6) AS recall, round(count(*) FILTER (rn <= 100)::DOUBLE / count(*), 6) AS share FROM r""")
def _(t):
    scored = lk.mean_distance(near(t, 10), 10).join(targets(t), "id")
    return r6(lk.seed_recall(scored, "mean_distance", "target", "id", 100))


@query("lk_sample_profile", "WITH s AS (" + " UNION ALL ".join(f"SELECT segment FROM (SELECT segment, row_number() OVER (ORDER BY {hx('customer_id', f'p{i}')}, customer_id) rn FROM r_customers) WHERE rn <= 500" for i in range(5)) + ") SELECT segment, round(count(*) / 5.0::DOUBLE, 6) AS mean_count FROM s GROUP BY 1")
def _(t):
    return r6(lk.sample_profile(t.customers, "segment", "customer_id", 500, samples=5))


@query("lk_discard_unknown", "SELECT order_id, cart_id, picking FROM r_orders o LEFT JOIN r_shipments s ON s.shipment_id = o.order_id WHERE NOT (cart_id IS NULL AND picking IS NULL AND o.status_code = 'P')")
def _(t):
    rows = t.orders.join(t.shipments, t.orders.order_id == t.shipments.shipment_id, "left").select("order_id", "cart_id", "picking", "status_code")
    return lk.discard_unknown(rows, {"cart_id": None, "picking": None, "status_code": "P"}).drop("status_code")


# ------------------------------------------------------------ sequences

_SEQ = """ev AS (SELECT customer_id, day, 'c' || (k % 40) AS token, count(*) AS views FROM r_events WHERE event_type <> 'purchase' GROUP BY 1, 2, 3), bu AS (SELECT DISTINCT buyer_id AS customer_id, created AS bought, 'c' || (category_id % 40) AS target FROM r_purchases WHERE status = 'paid'),
    pr AS (SELECT DISTINCT customer_id, bought FROM bu), ej AS (SELECT p.customer_id, p.bought, e.day, e.token, CASE WHEN views > 5 THEN 3 WHEN views = 1 THEN 1 ELSE 2 END AS level, row_number() OVER (PARTITION BY p.customer_id, p.bought ORDER BY e.day DESC, e.token DESC) rn FROM pr p JOIN ev e ON e.customer_id = p.customer_id AND e.day BETWEEN p.bought - 60 AND p.bought - 1),
    sq AS (SELECT * FROM ej WHERE rn <= 53)"""


def training(t):
    events = t.events.where("event_type <> 'purchase'").select("customer_id", "day", F.concat(F.lit("c"), (F.col("k") % 40).cast("string")).alias("token"), F.lit(1).alias("views"))
    bought = t.purchases.where("status = 'paid'").select(F.col("buyer_id").alias("customer_id"), F.col("created").alias("day"), F.concat(F.lit("c"), (F.col("category_id") % 40).cast("string")).alias("token"))
    return sq.training_rows(events, bought)


@query("sq_train_rows", f"""
    WITH {_SEQ}, ag AS (SELECT customer_id, bought, string_agg(token, ',' ORDER BY rn DESC) AS tokens, string_agg((bought - day + 1)::VARCHAR, ',' ORDER BY rn DESC) AS days, string_agg(level::VARCHAR, ',' ORDER BY rn DESC) AS levels FROM sq GROUP BY 1, 2)
    SELECT customer_id, bought::VARCHAR AS bought, tokens, days, levels, target FROM ag JOIN bu USING (customer_id, bought)""")
def _(t):
    from tallyloom.functions.arrays import field
    rows = training(t)
    return rows.select("customer_id", "bought", field("events", "token").alias("tokens"), field("events", "days_diff").alias("days"), field("events", "level").alias("levels"), "target")


@query("sq_split_arrays", f"""
    WITH {_SEQ}, tg AS (SELECT DISTINCT customer_id, bought, target FROM bu JOIN sq USING (customer_id, bought)), lc AS (SELECT target, row_number() OVER (ORDER BY target) AS code FROM tg GROUP BY 1 HAVING count(*) >= 30),
    ag AS (SELECT customer_id, bought, string_agg(code::VARCHAR, ',' ORDER BY rn DESC) AS tokens, string_agg((bought - day + 1)::VARCHAR, ',' ORDER BY rn DESC) AS days, string_agg(level::VARCHAR, ',' ORDER BY rn DESC) AS levels FROM sq JOIN lc ON lc.target = token GROUP BY 1, 2 HAVING count(*) > 4)
    SELECT customer_id, bought::VARCHAR AS bought, tokens, days, levels, code AS target_code FROM ag JOIN tg USING (customer_id, bought) JOIN lc USING (target)""")
def _(t):
    rows = training(t)
    return sq.split_arrays(rows, sq.token_codes(rows, "target", 30))


_WORDS = "w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents), vo AS (SELECT word, count(*) AS n FROM w WHERE word <> '' GROUP BY 1), vx AS (SELECT word, n, row_number() OVER (ORDER BY n DESC, word) AS i FROM vo)"


@query("sq_vocab", f'WITH {_WORDS} SELECT word, n, i AS "index" FROM vx WHERE i < 500')
def _(t):
    return sq.vocabulary(t.read("documents"), F.split("text", " "), 500)


@query("sq_encode_pad", f"""
    WITH {_WORDS}, x AS (SELECT doc_id, string_split(text, ' ') AS ws FROM documents), p AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM x), e AS (SELECT doc_id, list(i ORDER BY pos) AS ids FROM p JOIN vx USING (word) WHERE i < 500 GROUP BY 1), l AS (SELECT doc_id, COALESCE(ids, []) AS v FROM documents LEFT JOIN e USING (doc_id))
    SELECT doc_id, array_to_string(list_concat(list_transform(range(greatest(40 - len(v), 0)), lambda x: 0::BIGINT), v[greatest(len(v) - 39, 1):]), ',') AS ids FROM l""")
def _(t):
    docs = t.read("documents")
    words = F.split("text", " ")
    return sq.encode_pad(docs, "doc_id", words, sq.vocabulary(docs, words, 500), 40)


@query("sq_doc_vectors")
def _(t):
    return sq.document_vectors(t.read("documents"), "doc_id", F.split("text", " "), size=16)


_DOT = "q AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings), d AS (SELECT a.id, b.id AS seed_id, list_inner_product(a.e, b.e) AS score FROM q a, q b), nn AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, seed_id) AS place FROM d)"


def candidates(t):
    return lk.as_vectors(t.read("embeddings"), "vec_id", "embedding", "seed_id")


@query("sq_topk_retrieval", f"WITH {_DOT} SELECT id, seed_id AS item_id, place, round(score, 6) AS score FROM nn WHERE place <= 50")
def _(t):
    rows = lk.nearest_seeds(vectors(t), candidates(t), 50, "dot")
    return r6(rows.select("id", F.col("seed_id").alias("item_id"), "place", (-F.col("distance")).alias("score")))


@query("sq_topk_approx", f"WITH {_DOT} SELECT id, seed_id AS item_id, place, round(score, 6) AS score FROM nn WHERE place <= 50")
def _(t):
    rows = lk.indexed_nearest(vectors(t), candidates(t), 50, "dot")
    return r6(rows.select("id", F.col("seed_id").alias("item_id"), "place", (-F.col("distance")).alias("score")))
