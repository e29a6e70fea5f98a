"""Results do not depend on layout, ties or hot keys."""

import hashlib
import os
import random
import subprocess
import sys

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import aggregates as ag
from tallyloom.operators import causal as ce
from tallyloom.operators import loading as ld
from tallyloom.operators import lookalike as lk
from tallyloom.operators import ltv
from tallyloom.operators import prepare as pp
from tallyloom.operators import ranking as rk
from tallyloom.operators import sampling as sm
from tallyloom.operators import segments as sg
from tallyloom.operators.trailing import Trailing, attach_trailing
from tallyloom.plans import audiences, catalog  # noqa: F401  (registers the queries)
from tallyloom.plans.registry import BUILDERS
from tallyloom.sources.tables import Tables


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one score, and one group has most rows."""
    draw = random.Random(5)
    data = []
    for i in range(6000):
        score = 0.5 if draw.random() < 0.4 else round(draw.random(), 3)
        data.append((i, "big" if draw.random() < 0.8 else f"g{i % 3}", score if draw.random() < 0.98 else None, draw.randrange(5)))
    return pd.DataFrame(data, columns=["id", "g", "score", "v"])


def expected_rank(pdf, descending):
    key = pdf["score"].where(pdf["score"].notna(), np.nan)
    pdf = pdf.assign(k=(-key if descending else key).fillna(np.inf))
    return pdf.sort_values(["k", "id"])


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("group", [[], ["g"]])
def test_running_totals_match_pandas(spark, hot, group, descending):
    df = spark.createDataFrame(hot.astype(object).where(hot.notna(), None), "id long, g string, score double, v long").repartition(5)
    out = rk.running_totals(df, "score", "id", {"run": F.col("v")}, group=group, descending=descending, group_totals={"n": "count", "s": "run"}).toPandas()
    base = expected_rank(hot, descending)
    parts = base.groupby("g") if group else base.assign(one=1).groupby("one")
    want = base.assign(rank=parts.cumcount() + 1, run=parts["v"].cumsum(), n=parts["id"].transform("size"), s=parts["v"].transform("sum"))
    both = out.merge(want, on="id", suffixes=("", "_w"))
    assert len(both) == len(hot)
    for c in ("rank", "run", "n", "s"):
        assert (both[c].astype("int64") == both[f"{c}_w"].astype("int64")).all(), c


def test_hot_score_is_cut_into_buckets(spark, hot):
    """All cuts fall on one value: its rows are cut again by the tie-break column."""
    df = spark.createDataFrame(hot[hot.score == 0.5][["id", "score"]])
    cuts = rk._quantile_cuts(df.withColumn("k", F.col("score")), "k", 8)
    assert len(set(cuts)) == 1  # all cuts fall on the hot value
    out = rk.global_rank(df, "score", "id").toPandas().sort_values("id")
    assert out["rank"].tolist() == list(range(1, len(out) + 1))


def test_results_do_not_depend_on_shuffle_partitions(spark, hot):
    df = spark.createDataFrame(hot[["id", "g", "v"]])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    for n in ("1", "3", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        split = sm.named_split(df.repartition(int(n)), "id", [("a", 0.2), ("b", 0.8)], strata=["g"])
        out.append(sorted((r["id"], r["split"]) for r in split.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1] == out[2]


def test_ntile_matches_pandas_sizes(spark):
    df = spark.range(23).select("id", (F.col("id") % 7).cast("double").alias("s"))
    sizes = [r["count"] for r in rk.ntile(df, 5, "s", "id").groupBy("bucket").count().orderBy("bucket").collect()]
    assert sizes == [5, 5, 5, 4, 4]


def test_exact_quantiles(spark, hot):
    df = spark.createDataFrame(hot[["score", "v"]].dropna())
    got = {r["feature"]: r["quantiles"] for r in rk.exact_quantiles(df, ["score", "v"], [0.0, 0.25, 0.95, 1.0]).collect()}
    for c in ("score", "v"):
        assert np.allclose(got[c], hot.dropna()[c].quantile([0.0, 0.25, 0.95, 1.0]))


def test_balance_over_reaches_the_largest_group(spark, hot):
    df = spark.createDataFrame(hot[["id", "g"]])
    sizes = {r["count"] for r in sm.balance_over(df, "g", "id").groupBy("g").count().collect()}
    assert sizes == {int((hot.g == "big").sum())}


def test_bernoulli_keeps_about_n(spark):
    n = sm.bernoulli(spark.range(20000), "id", 5000).count()
    assert abs(n - 5000) < 250


def test_draws_are_repeatable(spark):
    a = sm.fixed_n(spark.range(1000).repartition(7), "id", 20).collect()
    b = sm.fixed_n(spark.range(1000).repartition(2), "id", 20).collect()
    assert a == b


def test_trailing_matches_brute_force(spark):
    draw = random.Random(2)
    facts = sorted({(draw.randrange(4), draw.randrange(120)) for _ in range(160)})
    data = [(k, d, draw.randrange(50) if draw.random() < 0.9 else None) for k, d in facts]
    anchors = sorted({(draw.randrange(5), draw.randrange(120)) for _ in range(60)})
    f = spark.createDataFrame(data, "k long, n int, v long").select("k", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n")).alias("day"), "v")
    a = spark.createDataFrame(anchors, "k long, n int").select("k", F.date_add(F.lit("2024-01-01").cast("date"), F.col("n")).alias("day"), "n")
    measures = {
        "c": Trailing("count", -30, -1), "s": Trailing("sum", -30, -1, "v"), "lo": Trailing("min", -7, 6, "v"), "hi": Trailing("max", -7, 6, "v"),
        "first": Trailing("first", -30, -1), "last": Trailing("last", -30, -1),
    }
    got = {(r["k"], r["n"]): r for r in attach_trailing(a, f, "k", "day", "day", measures).collect()}
    assert len(got) == len(anchors)
    for k, n in anchors:
        near = [(d, v) for kk, d, v in data if kk == k and n - 30 <= d <= n - 1]
        wide = [v for kk, d, v in data if kk == k and n - 7 <= d <= n + 6 and v is not None]
        row = got[(k, n)]
        values = [v for _, v in near if v is not None]
        assert row["c"] == len(near) and row["s"] == (sum(values) if values else None)
        assert row["lo"] == (min(wide) if wide else None) and row["hi"] == (max(wide) if wide else None)
        assert (row["first"] is None) == (not near) == (row["last"] is None)
        if near:
            assert (row["day"] - row["first"]).days == n - min(d for d, _ in near)
            assert (row["day"] - row["last"]).days == n - max(d for d, _ in near)


def test_newest_array_is_oldest_first(spark):
    df = spark.createDataFrame([(1, i, f"t{i}") for i in range(10)], "k int, ts int, token string").repartition(3)
    out = ag.newest_array(df, ["k"], [F.desc("ts")], ["token"], 4, "x").first()["x"]
    assert [r["token"] for r in out] == ["t6", "t7", "t8", "t9"]


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    data = [(i, rng.standard_normal(8).tolist()) for i in range(300)]
    return spark.createDataFrame(data, "id long, vec array<double>"), np.array([v for _, v in data])


@pytest.mark.parametrize("metric", ["cosine", "l2", "l1", "dot"])
def test_nearest_seeds_two_ways(spark, vectors, metric):
    df, matrix = vectors
    seeds = df.where("id < 40").withColumnRenamed("id", "seed_id")
    direct = lk.nearest_seeds(df, seeds, 5, metric).select("id", "place", "seed_id")
    blocks = lk.blocked_nearest(df, seeds, 5, metric, block=37).select("id", "place", "seed_id")
    a, b = sorted(map(tuple, direct.collect())), sorted(map(tuple, blocks.collect()))
    assert len(a) == 1500
    full = np.argsort(lk.distances(matrix, matrix[:40], metric), axis=1, kind="stable")[:, :5]
    want = sorted((i, p + 1, int(full[i, p])) for i in range(300) for p in range(5))
    assert a == b == want


def test_large_seed_sets_are_not_broadcast(spark, vectors):
    df, _ = vectors
    seeds = df.withColumnRenamed("id", "seed_id")
    small = lk.nearest_seeds(df, seeds, 3, limit_bytes=100)
    assert "FlatMapCoGroups" in small._jdf.queryExecution().executedPlan().toString()
    assert small.count() == 900


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_index_gives_the_exact_lists(spark, vectors, metric):
    df, matrix = vectors
    items = df.where("id < 160").withColumnRenamed("id", "seed_id")
    index = lk.ProductIndex(items, metric, most_cells=9)
    got = sorted((r["id"], r["place"], r["seed_id"]) for r in index.nearest(df, 5, block=37).collect())
    full = np.argsort(lk.distances(matrix, matrix[:160], metric), axis=1, kind="stable")[:, :5]
    assert got == sorted((i, p + 1, int(full[i, p])) for i in range(300) for p in range(5))
    assert index.candidates(df, 5).count() < 300 * 160 / 4


def test_index_stops_at_its_bounds(spark):
    """Items in tight clusters: probes leave cells unseen, and a smaller reach sees fewer still."""
    rng = np.random.default_rng(6)
    middle = rng.normal(size=(20, 8)) * 10
    x = np.repeat(middle, 30, axis=0) + rng.normal(size=(600, 8)) * 0.05
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    index = lk.ProductIndex(df.withColumnRenamed("id", "seed_id"), "l2", most_cells=25)
    rows = df.where("id % 10 = 0")
    marks = rows.select("id").withColumn("mark", F.lit(float("-inf")))
    every = index._probes(rows, 5, 0, 1.0, marks).count()
    near = index._bounds(index._probes(rows, 5, 10, 1.0, None), 5, 1000, True).groupBy("id").agg(F.expr("sort_array(collect_list(low), false)[4]").alias("mark"))
    looked = index._probes(rows, 5, 0, 1.0, near).count()
    assert index._probes(rows, 5, 0, 0.5, near).count() < looked < 0.6 * every
    full = np.argsort(lk.distances(x[::10], x, "l2"), axis=1, kind="stable")[:, :5]
    got = {(r["id"], r["seed_id"]) for r in index.nearest(rows, 5).collect()}
    assert got == {(10 * i, int(j)) for i in range(60) for j in full[i]}


def test_index_of_few_items(spark, vectors):
    df, _ = vectors
    items = df.withColumnRenamed("id", "seed_id")
    assert lk.indexed_nearest(df, items.where("seed_id < 3"), 5).count() == 900
    assert lk.indexed_nearest(df, items.limit(0), 5).count() == 0 and lk.indexed_nearest(df.limit(0), items, 5).count() == 0


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
@pytest.mark.parametrize("name,exact,seed,k,metric", [("lk_lsh", "lk_knn", "seed_id", 10, "cosine"), ("sq_topk_approx", "sq_topk_retrieval", "item_id", 50, "dot")])
def test_registered_neighbours_are_complete(spark, name, exact, seed, k, metric, scale):
    """The registered queries themselves: as many rows as the exact lists have, at least 90% of those, and full vectors of less than half of all pairs."""
    folder = f"/root/testdata/{scale}"
    pairs = lambda q: {(r["id"], r[seed]) for r in BUILDERS[q](spark, folder).collect()}
    found, full = pairs(name), pairs(exact)
    assert len(found) == len(full) and len(found & full) / len(full) >= 0.9
    t = Tables(spark, folder)
    items = audiences.seeds(t) if seed == "seed_id" else audiences.candidates(t)
    n_rows, n_items = audiences.vectors(t).count(), items.count()
    assert lk.ProductIndex(items, metric).candidates(audiences.vectors(t), k).count() < n_rows * n_items / 2


def test_hot_bucket_is_split(spark):
    """All vectors fall in one bucket; its blocks stay small and the result stays exact."""
    data = [(i, [1.0, 1.0 + i / 1000]) for i in range(200)]
    df = spark.createDataFrame(data, "id long, vec array<double>").withColumn("bucket", F.lit(1))
    seeds = df.withColumnRenamed("id", "seed_id")
    got = lk.blocked_nearest(df, seeds, 3, "l2", keys=["bucket"], block=30)
    want = lk.nearest_seeds(df, seeds, 3, "l2")
    assert sorted(map(tuple, got.select("id", "place", "seed_id").collect())) == sorted(map(tuple, want.select("id", "place", "seed_id").collect()))


def test_principal_axes_match_numpy(spark, vectors):
    df, matrix = vectors
    axes, center = lk.principal_axes(df, 3)
    _, _, vt = np.linalg.svd(matrix - matrix.mean(0), full_matrices=False)
    assert np.allclose(center, matrix.mean(0)) and np.allclose(np.abs(axes.T @ vt[:3].T), np.eye(3), atol=1e-6)


def test_matching_matches_brute_force(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"id": range(800), "w": rng.integers(0, 2, 800), "e": rng.integers(1, 512, 800) / 512, "y": rng.normal(size=800)})
    got = ce.match_nearest(spark.createDataFrame(pdf), "y", "w", "e").first()["att"]
    control = pdf[pdf.w == 0].groupby("e").y.mean()
    gaps = []
    for _, r in pdf[pdf.w == 1].iterrows():
        d = np.abs(control.index.to_numpy() - r.e)
        best = int(np.argmin(d))  # scores are exact binary fractions; the lower one comes first
        gaps.append(r.y - control.iloc[best])
    assert got == pytest.approx(np.mean(gaps), abs=1e-9)


def test_quota_segments_match_sequential_picks(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"id": range(500), "a": np.round(rng.random(500), 2), "b": np.round(rng.random(500), 2), "z": np.round(rng.random(500), 2)})
    got = sg.quota_by_probability(spark.createDataFrame(pdf), ["a", "b"], "z", "id").toPandas().set_index("id")["segment"]
    free, want = pdf.copy(), {}
    for name, quota in [("a", 50), ("b", 50), ("z", 250)]:
        best = free.sort_values([name, "id"], ascending=[False, True]).head(quota)
        want.update(dict.fromkeys(best["id"], name))
        free = free[~free["id"].isin(best["id"])]
    want.update(dict.fromkeys(free["id"], "q5"))
    assert got.to_dict() == want


@pytest.mark.parametrize("kind", ["plain", "ties", "text keys", "gaps"])
def test_quota_borders_by_narrowing(spark, monkeypatch, kind):
    """Rows beyond the bound: joint histograms of bands, then only the open rows; the same segments as picks in turn."""
    rng = np.random.default_rng(14)
    n = 40_000
    pdf = pd.DataFrame({"id": rng.permutation(n), **{c: rng.random(n) for c in "abcdz"}})
    if kind == "ties":  # half of all rows share one value in every column
        for c in "abcdz":
            pdf.loc[rng.random(n) < 0.5, c] = 0.95
    if kind == "text keys":
        pdf["id"] = pdf["id"].map(lambda i: f"k{i}")
    if kind == "gaps":
        pdf.loc[rng.random(n) < 0.3, "b"] = None
    sizes = []
    solve = sg._in_turn
    monkeypatch.setattr(sg, "_in_turn", lambda rows, *rest: sizes.append(len(rows)) or solve(rows, *rest))
    rows = spark.createDataFrame(pdf).withColumn("b", F.nanvl("b", F.lit(None)))
    got = sg.quota_by_probability(rows, list("abcd"), "z", "id", held=6000).toPandas().set_index("id")["segment"]
    free, want = pdf.fillna(-np.inf), {}
    for name in "abcdz":
        best = free.sort_values([name, "id"], ascending=[False, True]).head(n // 2 if name == "z" else n // 10)
        want.update(dict.fromkeys(best["id"], name))
        free = free[~free["id"].isin(best["id"])]
    want.update(dict.fromkeys(free["id"], "q5"))
    assert got.to_dict() == want
    assert len(sizes) == 1 and sizes[0] <= 6000


def test_sample_profile_draws_all_samples_at_once(spark):
    pdf = pd.DataFrame({"id": range(3000), "c": ["hot" if i % 3 else f"c{i % 4}" for i in range(3000)]})
    df = spark.createDataFrame(pdf)
    for n in (40, 5000):  # more than there are: all rows in every sample
        got = {r["c"]: r["mean_count"] for r in lk.sample_profile(df, "c", "id", n, samples=6).collect()}
        want = {}
        for i in range(6):
            drawn = sorted((int(hashlib.md5(f"p{i}|{k}".encode()).hexdigest()[:8], 16), k) for k in pdf["id"])[:n]
            for _, k in drawn:
                want[pdf["c"][k]] = want.get(pdf["c"][k], 0) + 1 / 6
        assert got == pytest.approx(want)


@pytest.mark.parametrize("chunk", [50, 10_000])
def test_packing_keeps_its_constraints(spark, chunk):
    rng = np.random.default_rng(8)
    n = 900
    goods = pd.DataFrame({
        "city": np.where(rng.random(n) < 0.7, "hot", "cold"), "item_id": range(n), "day": pd.to_datetime("2024-01-01").date(),
        "weight": rng.integers(1, 40, n).astype(float), "volume": rng.integers(1, 20, n) / 10, "value": rng.integers(50, 400, n).astype(float)})
    goods["day"] = [pd.Timestamp("2024-01-01").date() + pd.Timedelta(days=int(d)) for d in rng.integers(0, 12, n)]
    fleet = spark.createDataFrame([(c, v, w, x, r) for c in ("hot", "cold") for v, w, x, r in [("small", 150.0, 10.0, 60.0), ("large", 400.0, 25.0, 150.0)]],
                                  "city string, vehicle string, capacity_weight double, capacity_volume double, rate double")
    packed = ld.pack(spark.createDataFrame(goods), fleet, chunk=chunk)
    out = packed.toPandas()
    assert sorted(out["item_id"]) == list(range(n))  # every item once
    loads = ld.totals(packed, fleet).toPandas()
    assert len(loads) > 5
    assert (loads.weight_share <= 1 + 1e-9).all() and (loads.volume_share <= 1 + 1e-9).all()
    assert ((loads.weight_share >= 0.8 - 1e-9) | (loads.volume_share >= 0.8 - 1e-9)).all()
    assert (loads["value"] * 0.1 >= loads["rate"] - 1e-9).all()
    assert ld.load_delay(packed).agg(F.min("delay")).first()[0] >= 0


def test_tasks_need_no_copy_of_the_package(tmp_path):
    """Python workers started elsewhere must be able to run the functions of this package."""
    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "import __spark_entry__ as e\n"
        "from tallyloom.session import local_session\n"
        "spark = local_session(2, 2)\n"
        "print('rows', e.queries()['lk_knn'](spark, '/root/testdata/sf0.001').count())\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code, root], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows" in out.stdout, out.stderr[-2000:]


def test_trailing_with_two_sites_and_bad_values(spark):
    """Keys of several columns; what lies outside a window neither costs digits nor spreads."""
    import datetime as dt

    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(n)
    facts = [(1, "a", day(0), 1e16), (1, "a", day(50), 5.3), (1, "b", day(51), 7.0), (2, "a", day(0), float("nan")), (2, "a", day(55), 2.5), (2, "b", day(58), None)]
    anchors = [(1, "a", day(60)), (1, "b", day(60)), (2, "a", day(60)), (2, "b", day(60))]
    f = spark.createDataFrame(facts, "id long, site string, day date, v double")
    a = spark.createDataFrame(anchors, "id long, site string, at date")
    measures = {"s": Trailing("sum", -20, -1, "v"), "n": Trailing("count", -20, -1), "last": Trailing("last", -20, -1)}
    got = {(r["id"], r["site"]): (r["s"], r["n"], r["last"]) for r in attach_trailing(a, f, ["id", "site"], "at", "day", measures).collect()}
    assert got == {(1, "a"): (5.3, 1, day(50)), (1, "b"): (7.0, 1, day(51)), (2, "a"): (2.5, 1, day(55)), (2, "b"): (None, 1, day(58))}


def test_many_categories(spark):
    """100,000 labels: codes by name, and draws that follow the running shares."""
    df = spark.range(200_000).select("id", F.format_string("v%06d", F.col("id") % 100_000).alias("c"))
    codes = pp.code_table(df, "c", 2)
    assert codes.count() == 100_000 and codes.filter("code <> cast(substring(c, 2) as int) + 1").count() == 0
    holes = df.withColumn("c", F.when(F.col("id") % 10 != 0, F.col("c")))
    filled = pp.draw_missing(holes, "c", "id")
    assert filled.count() == 200_000 and filled.filter("c is null").count() == 0
    assert filled.join(holes.withColumnRenamed("c", "old"), "id").filter("old is not null and old <> c").count() == 0


def test_unbounded_likelihood_is_never_best(spark):
    df = spark.createDataFrame([(1.0, 1), (-1.0, 1)], "x double, __n long")
    value = ltv._batched(df, ["x"], lambda p, x: np.log(x * p[0]))([np.array([1.0])])
    assert value == [-float("inf")]


def test_large_amounts(spark, tmp_path):
    from tallyloom.sources.tables import Tables

    for name, row in {
        "orders": "1L AS o_orderkey, 1L AS o_custkey, 'O' AS o_orderstatus, 2500000.25D AS o_totalprice, DATE'1998-02-02' AS o_orderdate, '1-URGENT' AS o_orderpriority",
        "events": "1L AS event_id, 4L AS user_id, TIMESTAMP'2024-01-01 00:00:00' AS ts, 'view' AS event_type, 3000000.5D AS value, '{\"k\": 1000}' AS props",
    }.items():
        spark.sql(f"SELECT {row}").write.parquet(str(tmp_path / f"{name}.parquet"))
    t = Tables(spark, str(tmp_path))
    assert float(t.orders.first()["amount"]) == 2500000.25
    assert (float(t.events.first()["value"]), t.events.first()["k"]) == (3000000.5, 1000)


def test_narrowed_quantiles(spark):
    """Cells are cut again until few values are held; ties, infinities, nulls, empty columns and a hot value keep their place."""
    rng = np.random.default_rng(12)
    n = 3000
    cols = {"normal": rng.normal(size=n), "steep": 10.0 ** rng.uniform(-200, 200, n), "hot": np.where(rng.random(n) < 0.6, 7.0, rng.integers(0, 20, n)),
            "same": np.full(n, 3.5), "far": np.where(rng.random(n) < 0.01, -np.inf, np.where(rng.random(n) < 0.01, np.inf, rng.normal(size=n)))}
    frame = pd.DataFrame(cols)
    frame["gaps"] = np.where(rng.random(n) < 0.7, None, frame["normal"])
    frame["none"] = None
    schema = ", ".join(f"{c} double" for c in frame.columns)
    df = spark.createDataFrame([tuple(None if v is None or v != v else float(v) for v in r) for r in frame.itertuples(index=False)], schema).repartition(6)
    shares = [0.0, 0.1, 0.25, 0.5, 0.9, 0.95, 1.0]
    for fine, held in ((8, 20), (1000, 50_000)):
        got = {r["feature"]: r["quantiles"] for r in rk.exact_quantiles(df, list(frame.columns), shares, fine, held).collect()}
        assert got.pop("none") == [None] * len(shares)
        for c, values in got.items():
            known = np.sort(np.array([v for v in frame[c] if v is not None], dtype=float))
            for q, value in zip(shares, values, strict=True):
                h = q * (len(known) - 1)
                low, high = known[int(np.floor(h))], known[int(np.ceil(h))]
                assert (value == low == high) or abs(value - (low + (high - low) * (h - np.floor(h)))) <= 1e-12 * max(abs(low), abs(high))


def test_quantiles_move_few_values(spark):
    """Only the cells that hold a quantile leave their tasks: under 5% of the distinct values."""
    df = spark.range(200_000).select(F.xxhash64("id").cast("double").alias("v"))
    before = _shuffled(spark)
    rk.exact_quantiles(df, ["v"], [0.25, 0.5, 0.95], held=2000).collect()
    assert 0 < _shuffled(spark) - before < 0.05 * 200_000


def _shuffled(spark):
    """Records written to shuffles so far."""
    context = spark.sparkContext
    context._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    nothing = context._gateway.new_array(context._jvm.double, 0)
    stages = context._jsc.sc().statusStore().stageList(None, False, False, nothing, None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_k_grid_equals_the_curve_over_neighbours(spark, vectors):
    df, _ = vectors
    seeds = df.where("id % 3 = 0").withColumnRenamed("id", "seed_id")
    targets = df.select("id", (F.col("id") % 3 == 0).cast("int").alias("target"))
    ks = [1, 7, 40, 100, 5000]
    got = {r["k"]: round(r["map"], 9) for r in lk.k_grid(df, seeds, targets, ks, block=33).collect()}
    near = lk.nearest_seeds(df, seeds, 100).withColumn("distance", F.round("distance", 12))
    want = {r["k"]: round(r["map"], 9) for r in lk.k_curve(near, targets, ks).collect()}
    assert got.keys() == want.keys() == {1, 7, 40, 100} and all(abs(got[k] - want[k]) < 1e-3 for k in got)


@pytest.mark.parametrize("metric", ["cosine", "l2", "l1"])
def test_feature_subsets_equal_single_searches(spark, vectors, metric):
    df, matrix = vectors
    dim = matrix.shape[1]
    rng = np.random.default_rng(3)
    subsets = [sorted(rng.choice(dim, rng.integers(1, dim), replace=False).tolist()) for _ in range(7)] + [list(range(dim))]
    seeds = df.where("id < 90").withColumnRenamed("id", "seed_id")
    target = (np.arange(300) % 3 == 0).astype(int)
    rows = df.withColumn("target", (F.col("id") % 3 == 0).cast("int"))
    got = {r["subset"]: r["map"] for r in lk.feature_search(rows, seeds, subsets, 5, metric, block=70).collect()}
    for i, subset in enumerate(subsets):
        d = np.sort(lk.distances(matrix[:, subset], matrix[:90][:, subset], metric), axis=1)[:, :5].mean(1).round(9)
        hits = target[np.lexsort((np.arange(300), d))]
        want = (np.cumsum(hits) / np.arange(1, 301))[hits == 1].mean()
        assert abs(got[i] - want) < 1e-2
    assert len(got) == len(subsets)


def test_forest_fills_better_than_the_median(spark):
    rng = np.random.default_rng(8)
    x, z = rng.normal(size=1500), rng.normal(size=1500)
    y = 3 * x + np.sin(z * 2) + rng.normal(size=1500) * 0.1
    gone_y, gone_x = rng.random(1500) < 0.2, rng.random(1500) < 0.1
    rows = [(i, None if gone_x[i] else float(x[i]), None if gone_y[i] else float(y[i]), float(z[i]), None, f"t{i}") for i in range(1500)]
    df = spark.createDataFrame(rows, "key long, x double, y double, z double, e double, other string")
    out = pp.forest_impute(df, ["x", "y", "z", "e"], "key").toPandas().sort_values("key")
    again = pp.forest_impute(df, ["x", "y", "z", "e"], "key").toPandas().sort_values("key")
    assert out.equals(again) and list(out.columns) == df.columns and out["e"].isna().all() and (out["other"] == [f"t{i}" for i in range(1500)]).all()
    assert np.array_equal(out["y"][~gone_y], y[~gone_y]) and not out["x"].isna().any()
    for c, truth, gone in (("y", y, gone_y), ("x", x, gone_x)):
        error = np.abs(out[c].to_numpy() - truth)[gone].mean()
        assert error < 0.6 * np.abs(np.median(truth[~gone]) - truth)[gone].mean()
    assert pp.forest_impute(df.limit(0), ["x", "y"], "key").count() == 0


def test_both_ways_to_the_nearest_seeds_agree_on_repeated_ids(spark):
    draw = random.Random(2)
    rows = spark.createDataFrame([(i % 30, [draw.random(), draw.random()]) for i in range(40)], "id long, vec array<double>")
    seeds = spark.createDataFrame([(i, [draw.random(), draw.random()]) for i in range(12)], "seed_id long, vec array<double>")
    sent = sorted(map(tuple, lk.nearest_seeds(rows, seeds, 3, "l2").collect()))
    met = sorted(map(tuple, lk.nearest_seeds(rows, seeds, 3, "l2", limit_bytes=0).collect()))
    assert len(sent) == 90 and [r[:2] + r[3:] for r in sent] == [r[:2] + r[3:] for r in met]
    assert all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(sent, met, strict=True))
    with pytest.raises(ValueError):
        lk.nearest_seeds(rows, seeds.unionAll(seeds), 3)
