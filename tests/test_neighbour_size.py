"""What neighbour searches move and hold does not grow with the number of cells, blocks or seeds."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_scale import _shuffled

from tallyloom.operators import evaluate as ev
from tallyloom.operators import lookalike as lk


@pytest.fixture(scope="module")
def noise(spark):
    """Vectors without clusters: no bound of a cell leaves any of them out."""
    rng = np.random.default_rng(4)
    return spark.createDataFrame([(i, rng.standard_normal(32).tolist()) for i in range(600)], "id long, vec array<double>").cache()


def test_index_ships_rows_by_groups_of_cells(spark, noise):
    """A row that must look at all cells moves once for each group of them; shipped to each cell, it would move over 60 times."""
    index = lk.ProductIndex(noise.withColumnRenamed("id", "seed_id"), "dot")
    before = _shuffled(spark)
    assert index.nearest(noise, 5).count() == 3000
    moved = _shuffled(spark) - before
    assert len(index.cells) > 50 and moved < 40 * 600


def test_index_is_whole_with_several_groups_and_hot_cells(spark, monkeypatch):
    """Copies fill a cell larger than a group; ties go to the smaller id."""
    monkeypatch.setattr(lk, "GROUP_BYTES", 4000)
    rng = np.random.default_rng(5)
    x = np.vstack([rng.standard_normal((150, 4)), np.repeat(rng.standard_normal((1, 4)), 150, axis=0)])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    for metric in ("dot", "l2", "cosine"):
        got = {(r["id"], r["place"]): r["distance"] for r in lk.indexed_nearest(df, df.withColumnRenamed("id", "seed_id"), 7, metric).collect()}
        want = np.sort(lk.distances(x, x, metric), axis=1)[:, :7]
        assert len(got) == 2100 and all(abs(got[i, p + 1] - want[i, p]) < 1e-6 for i in range(300) for p in range(7))
        copies = lk.indexed_nearest(df.where("id = 299"), df.where("id >= 150").withColumnRenamed("id", "seed_id"), 7, metric).orderBy("place").collect()
        assert [r["seed_id"] for r in copies] == list(range(150, 157))


def test_small_blocks_move_no_more_candidates(spark, noise):
    seeds = noise.withColumnRenamed("id", "seed_id")
    before = _shuffled(spark)
    assert lk.blocked_nearest(noise, seeds, 5, "l2", block=10).count() == 3000
    assert _shuffled(spark) - before < 60 * 600


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2", "l1"])
def test_memory_of_a_search_is_that_of_a_tile(metric):
    rng = np.random.default_rng(6)
    x, y = rng.standard_normal((1500, 16)), rng.standard_normal((30_000, 16))
    tracemalloc.start()
    found = lk._nearest(np.arange(1500), x, np.arange(30_000), y, 10, metric)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = np.sort(lk.distances(x[:50], y, metric), axis=1)[:, :10]
    assert np.allclose(found["distance"].to_numpy().reshape(-1, 10)[:50], want, atol=1e-9) and peak < 60e6


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2", "l1"])
@pytest.mark.parametrize("scale", [1e-30, 1e-6, 1.0, 1e20])
def test_screening_loses_nothing(metric, scale):
    """Lengths that single precision cannot hold, near ties and copies."""
    rng = np.random.default_rng(7)
    y = rng.standard_normal((3000, 6)) * scale
    y[1500:] = y[:1500] * (1 + 1e-9 * rng.standard_normal((1500, 1)))
    y[2990:] = y[0]
    distance, place = lk._best(y[::30], y, 6, metric, tile=64)
    full = np.stack([lk._pair_distances(lk._prepared(y, metric), lk._prepared(y, metric), np.full(3000, i), np.arange(3000), metric) for i in range(0, 3000, 30)])
    assert np.array_equal(place, np.argsort(full, axis=1, kind="stable")[:, :6])


def test_curves_keep_distances_in_their_tasks(spark, noise):
    """A row's means leave a task, not its distances to the seeds; more seeds than may be sent give the same curve."""
    seeds, targets = noise.where("id % 3 = 0").withColumnRenamed("id", "seed_id"), noise.select("id", (F.col("id") % 3 == 0).cast("int").alias("target"))
    before = _shuffled(spark)
    sent = {r["k"]: r["map"] for r in lk.k_grid(noise, seeds, targets, [1, 50, 200, 300], block=20).collect()}
    assert _shuffled(spark) - before < 600 * 3 * 6
    met = {r["k"]: r["map"] for r in lk.k_grid(noise, seeds, targets, [1, 50, 200, 300], block=100, limit_bytes=0).collect()}
    assert sent.keys() == met.keys() == {1, 50, 200} and all(abs(sent[k] - met[k]) < 1e-9 for k in sent)


def test_feature_search_is_the_same_with_many_seeds(spark, noise):
    seeds, rows = noise.where("id < 250").withColumnRenamed("id", "seed_id"), noise.withColumn("target", (F.col("id") % 7 == 0).cast("int"))
    subsets = [[0], [3, 1], list(range(0, 32, 2)), list(range(32))]
    sent, met = ({r["subset"]: r["map"] for r in lk.feature_search(rows, seeds, subsets, 5, "cosine", 100, n).collect()} for n in (1 << 20, 0))
    assert sent.keys() == met.keys() == {0, 1, 2, 3} and all(abs(sent[k] - met[k]) < 1e-9 for k in sent)


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2", "l1"])
@pytest.mark.parametrize("scale", [1e-30, 1.0, 1e20])
def test_least_distances_are_those_of_the_lists(metric, scale, monkeypatch):
    """Parts of a step, several blocks of seeds, copies, near ties, vectors of zeros and what is not a number."""
    rng = np.random.default_rng(8)
    for held, n in ((1 << 14, 640), (1 << 14, 1025), (2048, 5000)):
        monkeypatch.setattr(lk, "HELD", held)
        y = rng.standard_normal((n, 6)) * scale
        y[n // 2 :] = y[: n - n // 2] * (1 + 1e-9 * rng.standard_normal((n - n // 2, 1)))
        y[-10:], y[5] = y[0], 0
        x = np.vstack([y[::7], rng.standard_normal((300, 6)) * scale])
        assert np.array_equal(lk._least(x, y, 9, metric), lk._best(x, y, 9, metric)[0])
        y[3, 1] = np.nan
        assert np.array_equal(lk._least(x, y, 9, metric), lk._best(x, y, 9, metric)[0])


def test_feature_search_deals_its_rows_out(spark, noise):
    """Rows of one file are searched in several tasks; copies of an id meet each of its targets, as in a join after the search."""
    rows = noise.withColumn("target", (F.col("id") % 7 == 0).cast("int"))
    twice = rows.unionAll(rows.where("id < 9")).coalesce(1)
    seeds = noise.where("id < 250").withColumnRenamed("id", "seed_id")
    means = lk._means_of_nearest(twice, seeds, twice.select("id", "target"), [5], 100, lambda x, y: [(0, lk._least(x, y, 5, "cosine"))], 1 << 20, many=True)
    ids = [i for r in means.collect() for i in r["id"]]
    assert means.rdd.getNumPartitions() > 1 and len(ids) == 591 + 9 * 4


def test_feature_search_moves_no_row_for_each_subset(spark, noise):
    """A task's means of a subset move together, not one by one."""
    rows, seeds = noise.withColumn("target", (F.col("id") % 7 == 0).cast("int")), noise.where("id < 250").withColumnRenamed("id", "seed_id")
    subsets = [[i, j] for i in range(8) for j in range(8, 16)]
    before = _shuffled(spark)
    assert lk.feature_search(rows, seeds, subsets, 5).count() == 64
    assert _shuffled(spark) - before < 0.2 * 64 * 600


def test_packed_precision_is_that_of_rows(spark, monkeypatch):
    """Ties, groups without a positive, several arrays a group; groups above the limit are taken apart."""
    draw = np.random.default_rng(9)
    rows = [(g, float(draw.integers(0, 12)), int(g < 4 and draw.random() < 0.3), int(i)) for g in range(5) for i in range(90)]
    df = spark.createDataFrame(rows, "g int, s double, y int, id long")
    arrays = df.groupBy("g", (F.col("id") % 4).alias("part")).agg(*[F.collect_list(c).alias(c) for c in ("s", "y", "id")])
    for descending in (True, False):
        want = {r["g"]: r["map"] for r in ev.mean_average_precision(df, "s", "y", "id", descending, ["g"]).collect()}
        for most in (4_000_000, 10):
            monkeypatch.setattr(ev, "PACKED_ROWS", most)
            got = {r["g"]: r["map"] for r in ev.mean_average_precision(arrays, "s", "y", "id", descending, ["g"]).collect()}
            assert got.keys() == want.keys() == {0, 1, 2, 3} and all(abs(got[g] - want[g]) < 1e-12 for g in got)
    assert ev.mean_average_precision(arrays.limit(0), "s", "y", "id", group=["g"]).count() == 0
