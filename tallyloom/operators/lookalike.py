"""Look-alike audiences: nearest seeds, scores from them, approximate neighbours, reductions.

Distances come from block matrix products inside tasks; each block of rows meets a block
of seeds and only k candidates per row leave the task, never all pairs. What moves between
tasks are groups of many blocks, of a bounded size, also when one hash bucket holds a large
part of the rows; a task goes through its blocks with one running list for each row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.columns import ratio
from tallyloom.operators.evaluate import mean_average_precision
from tallyloom.operators.ranking import bucket_count, global_rank
from tallyloom.operators.sampling import HASH_RANGE, key_hash
from tallyloom.session import cut_lineage

BROADCAST_BYTES = 64 * 1024 * 1024
GROUP_BYTES = 32 * 1024 * 1024
BLOCK_ROWS = 20_000
#: Rows and seeds compared at once inside a task, and pairs compared in full at once.
TILE, PAIRS = 1024, 65_536
#: Of the search for distances alone: rows and seeds of a step, seeds that share a minimum and seeds whose products are held.
ROWS, STEP, FOLD, HELD = 128, 1024, 16, 16_384
#: Seeds of one product; small ones are multiplied without being copied first.
SMALL = 128
#: Means in a frame that leaves a task.
FRAME_ROWS = 500_000
NONE = np.iinfo(np.int64).max


def distances(rows: np.ndarray, seeds: np.ndarray, metric: str) -> np.ndarray:
    """Distance matrix; `dot` is the negative inner product, so that small is near for all metrics."""
    return _between(_prepared(rows, metric), _prepared(seeds, metric), metric)


def _between(rows: np.ndarray, seeds: np.ndarray, metric: str) -> np.ndarray:
    """Distance matrix of prepared vectors."""
    if metric == "cosine":
        return 1 - rows @ seeds.T
    if metric == "dot":
        return -(rows @ seeds.T)
    if metric == "l2":
        square = (rows**2).sum(1)[:, None] + (seeds**2).sum(1)[None, :] - 2 * rows @ seeds.T
        return np.sqrt(np.maximum(square, 0))
    if metric == "l1":
        return _l1(rows, seeds)
    raise ValueError(f"unknown metric {metric}")


def _prepared(x: np.ndarray, metric: str) -> np.ndarray:
    """Vectors of length one for `cosine`, as they are for the other metrics."""
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) if metric == "cosine" else x


def _pair_distances(x: np.ndarray, y: np.ndarray, row: np.ndarray, item: np.ndarray, metric: str) -> np.ndarray:
    """Distances of single pairs of prepared vectors: the same numbers wherever a pair is met."""
    out = np.empty(len(row))
    for start in range(0, len(row), PAIRS):
        a, b = x[row[start : start + PAIRS]], y[item[start : start + PAIRS]]
        if metric in ("cosine", "dot"):
            product = np.einsum("ij,ij->i", a, b)
            out[start : start + PAIRS] = 1 - product if metric == "cosine" else -product
        else:
            out[start : start + PAIRS] = np.abs(a - b).sum(1) if metric == "l1" else np.linalg.norm(a - b, axis=1)
    return np.where(np.isnan(out), np.inf, out)


class _Lists:
    """The k nearest items of some rows so far, by distance and then id."""

    def __init__(self, n: int, k: int):
        self.distance, self.item = np.full((n, k), np.inf), np.full((n, k), NONE)

    def add(self, row: np.ndarray, item: np.ndarray, distance: np.ndarray) -> None:
        last, k = self.distance[row, -1], self.distance.shape[1]
        better = (distance < last) | ((distance == last) & (item < self.item[row, -1]))
        row, item, distance = row[better], item[better], distance[better]
        touched = np.unique(row)
        rows = np.concatenate([np.repeat(touched, k), row])
        items, values = np.concatenate([self.item[touched].ravel(), item]), np.concatenate([self.distance[touched].ravel(), distance])
        order = np.lexsort((items, values, rows))
        best = order[np.searchsorted(rows[order], touched)[:, None] + np.arange(k)]
        self.item[touched], self.distance[touched] = items[best], values[best]


def _l1(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sums of absolute differences, in pieces that stay in the processor's cache."""
    out, turned = np.empty((len(x), len(y)), x.dtype), np.ascontiguousarray(y.T)
    part = np.empty((64, len(y)), x.dtype)
    for start in range(0, len(x), 64):
        some = x[start : start + 64]
        for at in range(0, len(y), 1024):
            p, t, columns = part[: len(some), at : at + 1024], out[start : start + 64, at : at + 1024], turned[:, at : at + 1024]
            t[:] = 0
            for j in range(x.shape[1]):
                np.subtract(some[:, j, None], columns[j], out=p)
                np.abs(p, out=p)
                t += p
    return out


def _narrow(*arrays: np.ndarray) -> bool:
    """Whether products of these vectors can be screened in single precision without overflow or underflow."""
    for x in arrays:
        size = np.abs(x).max(axis=1, initial=0)
        size = size[size > 0]
        if not (np.isfinite(size).all() and size.max(initial=1) < 1e15 and size.min(initial=1) > 1e-15):
            return False
    return True


def _best(x: np.ndarray, y: np.ndarray, k: int, metric: str, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """k nearest y of each x, distances and places in y (n x k), by distance and then place.

    Tiles of products are screened against each row's k-th distance so far; the error of the screening is bounded, and pairs that
    pass are compared by themselves. Memory is that of a tile, whatever the number of vectors.
    """
    x, y = _prepared(x, metric), _prepared(y, metric)
    first, wide = max(tile, 4 * k), max(4 * tile, 4 * k)  # a narrow tile gives the first marks
    distance, place = np.empty((len(x), k)), np.empty((len(x), k), dtype=np.int64)
    kind = np.float32 if _narrow(x, y) else np.float64
    long_x, long_y = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    u, v, half = x.astype(kind, copy=False), y.astype(kind, copy=False), (long_y**2 / 2).astype(kind, copy=False)
    unit_error = 4 * (x.shape[1] + 8) * np.finfo(kind).eps
    for start in range(0, len(x), tile):
        rows = slice(start, start + tile)
        lists, length = _Lists(len(x[rows]), k), long_x[rows]
        for s in (0, *range(first, len(y), wide)):
            items = slice(s, s + (wide if s else first))
            most = long_y[items].max()
            if metric == "l1":
                value, slack = _l1(u[rows], v[items]), unit_error * np.sqrt(x.shape[1]) * (length + most)
            else:
                value = u[rows] @ -v[items].T
                slack = unit_error * length * most
                if metric == "l2":
                    value += half[items]
                    slack = slack + unit_error * most**2 + 1e-12 * length**2
            last = lists.distance[:, -1]
            mark = last - 1 if metric == "cosine" else (last**2 - length**2) / 2 if metric == "l2" else last
            if value.shape[1] >= k and np.isinf(last).any():
                mark = np.minimum(mark, np.partition(value, k - 1, axis=1)[:, k - 1])
            mark = mark + 2 * slack
            # The mark is rounded up, and what is not a number passes.
            row, item = np.divmod(np.flatnonzero(~(value > np.nextafter(mark.astype(kind), kind(np.inf))[:, None])), value.shape[1])
            lists.add(row, item + s, _pair_distances(x[rows], y[items], row, item, metric))
        distance[rows], place[rows] = lists.distance, lists.item
    return distance, place


def _least(x: np.ndarray, y: np.ndarray, k: int, metric: str) -> np.ndarray:
    """Distances of the k nearest y of each x (n x k), ascending: those of `_best`, without their places.

    Products of a block are folded into minima of `FOLD` seeds each, with one pass over them. The k-th smallest of these minima
    bounds a row's k-th distance, so only pairs of the few groups below it are looked at, and those within the screening's error
    of it are compared in full. Memory is that of a block of `ROWS` rows and `HELD` seeds.
    """
    if metric not in ("cosine", "dot", "l2") or len(y) < 4 * k * FOLD:
        return _best(x, y, k, metric)[0]
    a, b = _prepared(x, metric), _prepared(y, metric)
    if not (np.isfinite(a).all() and np.isfinite(b).all() and _narrow(a, b)):
        return _best(x, y, k, metric)[0]
    long_a, long_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    u, v, half = a.astype(np.float32), -b.astype(np.float32), (long_b**2 / 2).astype(np.float32)[:, None]
    unit_error, most = 4 * (x.shape[1] + 8) * np.finfo(np.float32).eps, long_b.max()
    part, room = STEP // FOLD, -(-min(len(b), HELD) // STEP) * STEP
    products, minima = np.empty(room * ROWS, np.float32), np.empty(room // FOLD * ROWS, np.float32)
    out = np.full((len(a), k), np.inf)
    for start in range(0, len(a), ROWS):
        own, turned, length = a[start : start + ROWS], np.ascontiguousarray(u[start : start + ROWS].T), long_a[start : start + ROWS]
        n, best = len(own), out[start : start + ROWS]
        slack = unit_error * length * most
        if metric == "l2":
            slack = slack + unit_error * most**2 + 1e-12 * length**2
        for begin in range(0, len(b), HELD):
            end = min(begin + HELD, len(b))
            steps = -(-(end - begin) // STEP)
            value, low = products[: steps * STEP * n].reshape(-1, n), minima[: steps * part * n].reshape(steps, part * n)
            value[end - begin :] = np.inf
            for i in range(steps):
                at = begin + i * STEP
                to = min(at + STEP, end)
                here = value[i * STEP : i * STEP + to - at]
                if len(here) == STEP:
                    np.matmul(v[at:to].reshape(-1, SMALL, v.shape[1]), turned, out=here.reshape(-1, SMALL, n))
                else:
                    np.matmul(v[at:to], turned, out=here)
                if metric == "l2":
                    here += half[at:to]
                # A group is every part-th seed of a step.
                np.minimum.reduce(value[i * STEP : (i + 1) * STEP].reshape(FOLD, part * n), axis=0, out=low[i])
            last = best[:, -1]
            mark = last - 1 if metric == "cosine" else (last**2 - length**2) / 2 if metric == "l2" else last
            low = low.reshape(-1, n)
            few = max(1, len(low) // max(4 * k, 64))  # minima of some groups at a time are enough for a mark
            wide = np.minimum.reduce(low[: len(low) // few * few].reshape(few, -1, n), axis=0).T
            if wide.shape[1] >= k:
                mark = np.minimum(mark, np.partition(wide, k - 1, axis=1)[:, k - 1])
            mark = np.nextafter((mark + 2 * slack).astype(np.float32), np.float32(np.inf))
            group, row = np.divmod(np.flatnonzero(low <= mark), n)
            order = np.argsort(row.astype(np.uint16), kind="stable")
            group, row = group[order], row[order]
            first = group // part * STEP + group % part
            near = np.flatnonzero(value.reshape(-1).take((first * n + row)[:, None] + np.arange(FOLD) * (part * n)) <= mark[row, None])
            row, item = row[near // FOLD], begin + first[near // FOLD] + near % FOLD * part
            known = item < end
            row, item = row[known], item[known]
            place = np.arange(len(row)) - np.searchsorted(row, np.arange(n))[row]
            found = np.full((n, k + place.max(initial=-1) + 1), np.inf)
            found[:, :k], found[row, k + place] = best, _pair_distances(own, b, row, item, metric)
            found.sort(axis=1)
            best[:] = found[:, :k]
    return out


def _nearest(ids, rows: np.ndarray, seed_ids, seeds: np.ndarray, k: int, metric: str, tile: int = TILE) -> pd.DataFrame:
    """k nearest seeds of each row; equal distances go to the smaller seed id (seeds come sorted by id)."""
    k = min(k, len(seeds))
    if not k or not len(rows):
        return pd.DataFrame({"id": [], "seed_id": [], "distance": []}).astype({"id": "int64", "seed_id": "int64", "distance": "float64"})
    distance, place = _best(rows, seeds, k, metric, tile)
    return pd.DataFrame({"id": np.repeat(ids, k), "seed_id": seed_ids[place.ravel()], "distance": distance.ravel()})


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float)


_OUT = "id long, seed_id long, distance double"


def _merge(candidates: DataFrame, k: int) -> DataFrame:
    """k best of each row's candidates; a row has k of them per seed block."""
    # Laid out by id, the candidates move once for both the copies and the places.
    once = candidates.repartition("id").groupBy("id", "seed_id").agg(F.min("distance").alias("distance"))
    place = Window.partitionBy("id").orderBy("distance", "seed_id")
    return once.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k)


def group_rows(df: DataFrame, vector: str = "vec") -> int:
    """Vectors that make a group of about `GROUP_BYTES`."""
    first = df.select(F.size(vector).alias("d")).first()
    return max(1, GROUP_BYTES // (8 * (first["d"] + 2))) if first else 1


def _spread(df: DataFrame, rows: int, seed_groups: int, group: int) -> int:
    """Groups of `rows` rows: none larger than `group`, and together with the seeds' enough for all cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-rows // group), min(rows, -(-2 * cores // seed_groups)))


def blocked_nearest(
    rows: DataFrame, seeds: DataFrame, k: int, metric: str = "cosine", keys: Sequence[str] = (), block: int = BLOCK_ROWS
) -> DataFrame:
    """Nearest seeds among those with the same keys, for any number of rows and seeds.

    `rows`: id, vec, keys; `seeds`: seed_id, vec, keys. Each key is cut into groups of bounded bytes by a hash; every row group
    meets every seed group of its key in one task, block by block of at most `block` rows and seeds. A row has k candidates
    for each seed group, not for each block.
    """
    keys = list(keys)
    group = max(block, group_rows(seeds))
    if keys:

        def groups(df: DataFrame, name: str) -> DataFrame:
            return df.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / group).cast("int").alias(name))

        sizes = groups(rows, "rb").join(groups(seeds, "sb"), keys)
        rows, seeds = rows.join(sizes, keys), seeds.join(sizes, keys)
    else:
        sb = max(1, -(-seeds.count() // group))
        rb = _spread(rows, rows.count(), sb, group)
        rows, seeds = (df.withColumns({"rb": F.lit(rb), "sb": F.lit(sb)}) for df in (rows, seeds))
    left = rows.select(
        "id", "vec", *keys, F.pmod(F.xxhash64("id"), F.col("rb").cast("long")).alias("__r"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("sb").cast("long") - 1)).alias("__s")
    )
    # The seeds often come from the same frame as the rows: new names keep the two sides apart.
    right = seeds.select(
        F.col("seed_id").alias("__seed"), F.col("vec").alias("__seed_vec"), *[F.col(c).alias(f"__k_{c}") for c in keys],
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("rb").cast("long") - 1)).alias("__seed_r"),
        F.pmod(F.xxhash64("seed_id"), F.col("sb").cast("long")).alias("__seed_s"),
    )

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame({"id": pd.Series(dtype="int64"), "seed_id": pd.Series(dtype="int64"), "distance": pd.Series(dtype="float64")})
        b = b.sort_values("__seed")
        return _nearest(a["id"].to_numpy(), _matrix(a["vec"]), b["__seed"].to_numpy(), _matrix(b["__seed_vec"]), k, metric, min(block, TILE))

    by_rows = left.groupBy(*keys, "__r", "__s")
    by_seeds = right.groupBy(*[f"__k_{c}" for c in keys], "__seed_r", "__seed_s")
    candidates = by_rows.cogroup(by_seeds).applyInPandas(meet, _OUT)
    return _merge(candidates, k)


def nearest_seeds(rows: DataFrame, seeds: DataFrame, k: int, metric: str = "cosine", limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """k nearest seeds of every row: id, seed_id, distance, place. Exact.

    Seeds are sent to all tasks when their measured size is below `limit_bytes`; above it
    rows and seeds meet block by block. Both ways give the same rows: copies of a row's id share one list, and a
    repeated seed id is an error.
    """
    size = seeds.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d"), F.count_distinct("seed_id").alias("ids")).first()
    if size["ids"] != size["n"]:
        raise ValueError("seed_id is not unique")
    if not size["n"]:
        return rows.sparkSession.createDataFrame([], _OUT + ", place int")
    if size["n"] * (size["d"] + 1) * 8 > limit_bytes:
        return blocked_nearest(rows, seeds, k, metric)
    local = seeds.select("seed_id", "vec").orderBy("seed_id").toPandas()
    shared = rows.sparkSession.sparkContext.broadcast((local["seed_id"].to_numpy(), _matrix(local["vec"])))

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seed_ids, matrix = shared.value
        for batch in batches:
            if len(batch):
                yield _nearest(batch["id"].to_numpy(), _matrix(batch["vec"]), seed_ids, matrix, k, metric)

    return _merge(rows.select("id", "vec").mapInPandas(part, _OUT), k)


def mean_distance(neighbours: DataFrame, k: int) -> DataFrame:
    """Mean distance to the first k seeds: the look-alike score, small is similar."""
    return neighbours.where(F.col("place") <= k).groupBy("id").agg(F.avg("distance").alias("mean_distance"))


def neighbour_frequency(neighbours: DataFrame) -> DataFrame:
    """How often each seed occurs in the neighbour lists."""
    return neighbours.groupBy("seed_id").agg(F.count(F.lit(1)).alias("freq"))


def k_curve(neighbours: DataFrame, targets: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Mean average precision of the mean-distance score for several k, from one neighbour table."""
    upto = Window.partitionBy("id").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    means = neighbours.withColumn("mean", F.avg("distance").over(upto)).where(F.col("place").isin(list(ks)))
    rows = cut_lineage(means.select("id", F.col("place").alias("k"), "mean").join(targets, "id"))
    return mean_average_precision(rows, "mean", "target", "id", descending=False, group=["k"])


def _as_products(x: np.ndarray, metric: str, query: bool) -> np.ndarray:
    """Vectors whose inner products order as the metric does, large for near."""
    if metric == "cosine":
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    if metric == "dot":
        return x
    if metric == "l2":
        more = np.ones((len(x), 1)) if query else -(x**2).sum(1, keepdims=True) / 2
        return np.hstack([x, more])
    raise ValueError(f"no index for metric {metric}")


def _meet(rows: DataFrame, items: DataFrame, key: str, block: int, function, schema: str, item_block: int | None = None) -> DataFrame:
    """`function` on every block of rows and block of items of a key; blocks have about `block` rows, however hot the key is."""

    def sized(df: DataFrame, name: str, n: int) -> DataFrame:
        return df.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / n).cast("long").alias(name))

    sizes = sized(rows, "__rb", block).join(sized(items, "__sb", item_block or block), key)
    left = rows.join(sizes, key).select("*", F.pmod(F.xxhash64("id"), "__rb").alias("__r"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("__sb") - 1)).alias("__s"))
    right = items.join(sizes, key).select("*", F.pmod(F.xxhash64("seed_id"), "__sb").alias("__s"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("__rb") - 1)).alias("__r"))
    names = [key, "__r", "__s"]
    right = right.toDF(*[f"__i_{c}" for c in right.columns])
    return left.groupBy(*names).cogroup(right.groupBy(*[f"__i_{c}" for c in names])).applyInPandas(function, schema)


class ProductIndex:
    """Exact nearest items by inner product without comparing most pairs of full vectors.

    Items lie in cells, ranges of their lengths cut into neighbourhoods of drawn centres. A cell has a radius r around its centre
    c, so no item in it has a product with q above q.c + |q| r (Cauchy-Schwarz). An item is its centre and a residual, coded with
    one byte for each axis; the length e of what the code leaves out bounds the error of a product by |q| e.

    A row first looks at the cells of the largest bounds until they hold `pool` items; the k-th largest lower bound there is its
    mark. It then meets the items in groups of whole cells and looks at every cell whose bound reaches the mark, so a probe stops
    only when no better item can follow. Items whose upper bound reaches the k-th largest lower bound are compared by their full
    vectors, in the same task, and raise the mark. A row moves once for each group of items, not for each cell. `reach` below 1
    takes that share of the radius: fewer cells, and a list that may miss items.

    The driver holds the centres, radii and counts of at most `most_cells` cells.
    """

    def __init__(self, items: DataFrame, metric: str = "dot", most_cells: int = 4096, ranges: int = 4, draw: str = "cells"):
        self.metric, self.items = metric, items
        length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda t, x: t + x * x))
        n = items.count()
        self.size = n
        if not n:
            return
        cuts = items.select(F.percentile_approx(length, [i / ranges for i in range(1, ranges)], 1000).alias("c")).first()["c"]
        wanted = max(1, min(most_cells, round(n**0.5)))
        drawn = items.select("vec").orderBy(F.xxhash64("seed_id", F.lit(draw)), "seed_id").limit(wanted).collect()
        points = _as_products(np.array([r["vec"] for r in drawn], dtype=float), metric, False)
        edges = np.array(sorted(set(cuts)))
        n_points = len(points)

        def coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if not len(batch):
                    continue
                raw = _matrix(batch["vec"])
                x = _as_products(raw, metric, False)
                band = np.searchsorted(edges, np.linalg.norm(raw, axis=1), side="right")
                near = distances(x, points, "l2").argmin(1)
                rest = x - points[near]
                scale = np.maximum(np.abs(rest).max(axis=1, keepdims=True) / 127, 1e-300)
                code = np.rint(rest / scale).astype(np.int8)
                left = np.linalg.norm(rest - scale * code, axis=1)
                yield pd.DataFrame(
                    {"seed_id": batch["seed_id"], "vec": batch["vec"], "cell": band * n_points + near, "code": [c.tobytes() for c in code], "scale": scale[:, 0], "left": left,
                     "far": np.linalg.norm(rest, axis=1)}
                )

        codes = items.select("seed_id", "vec").mapInPandas(coded, "seed_id long, vec array<double>, cell long, code binary, scale double, left double, far double")
        self.codes = cut_lineage(codes)
        cells = self.codes.groupBy("cell").agg(F.max("far").alias("radius"), F.count(F.lit(1)).alias("n")).orderBy("cell").toPandas()
        self.cells = cells["cell"].to_numpy()
        self.centres = points[self.cells % n_points]
        self.radius, self.held = cells["radius"].to_numpy(), cells["n"].to_numpy()

    def _probes(self, rows: DataFrame, k: int, pool: int, reach: float, marks: DataFrame | None) -> DataFrame:
        """(id, vec, cell, mark) of the cells that rows look at: the first ones, or those that reach the rows' marks."""
        cells, centres, radius, held, metric = self.cells, self.centres, self.radius, self.held, self.metric

        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for start in range(0, len(batch), 1024):
                    some = batch.iloc[start : start + 1024]
                    q = _as_products(_matrix(some["vec"]), metric, True)
                    bound = q @ centres.T + np.linalg.norm(q, axis=1)[:, None] * radius * reach
                    if "mark" in some:
                        row, cell = np.nonzero(bound + 1e-9 * (1 + np.abs(bound)) >= some["mark"].to_numpy()[:, None])
                        mark = some["mark"].to_numpy()[row]
                    else:
                        order = np.argsort(-bound, axis=1, kind="stable")
                        first = np.cumsum(held[order], axis=1) - held[order] < pool
                        row, nth = np.nonzero(first)
                        cell, mark = order[row, nth], np.full(len(row), -np.inf)
                    yield pd.DataFrame({"id": some["id"].to_numpy()[row], "vec": some["vec"].to_numpy()[row], "cell": cells[cell], "mark": mark})

        rows = rows.select("id", "vec") if marks is None else rows.select("id", "vec").join(marks, "id")
        return rows.mapInPandas(part, "id long, vec array<double>, cell long, mark double")

    def _bounds(self, probes: DataFrame, k: int, block: int, only_low: bool) -> DataFrame:
        """(id, seed_id, low, high): items of the probed cells whose upper bound reaches the mark and the k-th lower bound here."""
        metric, centre = self.metric, {int(c): x for c, x in zip(self.cells, self.centres)}

        def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if a.empty or b.empty:
                return pd.DataFrame({"id": [], "seed_id": [], "low": [], "high": []}).astype({"id": "int64", "seed_id": "int64"})
            x = np.frombuffer(b"".join(b["__i_code"]), np.int8).reshape(len(b), -1) * b["__i_scale"].to_numpy()[:, None] + centre[int(a["cell"].iloc[0])]
            out = []
            for start in range(0, len(a), max(1, 4_000_000 // len(b))):
                some = a.iloc[start : start + max(1, 4_000_000 // len(b))]
                q = _as_products(_matrix(some["vec"]), metric, True)
                length = np.linalg.norm(q, axis=1)[:, None]
                value, error = q @ x.T, length * b["__i_left"].to_numpy() + 1e-9 * length
                low, high = value - error, value + error
                mark = some["mark"].to_numpy()
                if len(b) > k:
                    mark = np.maximum(mark, np.partition(low, -k, axis=1)[:, -k])
                row, item = np.nonzero((low if only_low else high) >= mark[:, None])
                out.append(pd.DataFrame({"id": some["id"].to_numpy()[row], "seed_id": b["__i_seed_id"].to_numpy()[item], "low": low[row, item], "high": high[row, item]}))
            return pd.concat(out)

        return _meet(probes, self.codes.select("seed_id", "cell", "code", "scale", "left"), "cell", block, meet, "id long, seed_id long, low double, high double")

    def _marks(self, rows: DataFrame, k: int, pool: int | None, reach: float, block: int) -> DataFrame:
        """(id, mark): a lower bound of every row's k-th largest product, from its first cells."""
        best_low = Window.partitionBy("id").orderBy(F.desc("low"), "seed_id")
        first = self._bounds(self._probes(rows, k, max(k, pool or 2 * k), reach, None), k, block, True)
        kth = first.withColumn("nth", F.row_number().over(best_low)).where(F.col("nth") <= k).groupBy("id")
        return kth.agg(F.when(F.count(F.lit(1)) == k, F.min("low")).otherwise(F.lit(float("-inf"))).alias("mark"))

    def _search(self, rows: DataFrame, k: int, pool: int | None, reach: float, block: int, compared: bool) -> DataFrame:
        """(id, seed_id, distance): every row's k nearest items of each group of cells, or all pairs compared by their full vectors."""
        cells, centres, radius, held, metric = self.cells, self.centres, self.radius, self.held, self.metric
        group = group_rows(self.items)
        n_groups = max(1, -(-int(held.sum()) // group))
        rb = _spread(rows, rows.count(), n_groups, group)
        # Whole cells lie in one group, unless a cell is larger than a group.
        begin = np.cumsum(held) - held
        places = rows.sparkSession.createDataFrame(
            [(int(c), int(b) // group, -(-int(n) // group)) for c, b, n in zip(cells, begin, held)], "cell long, __first long, __parts long"
        )
        last = max(int(b) // group + -(-int(n) // group) for b, n in zip(begin, held))
        left = rows.select("id", "vec").join(self._marks(rows, k, pool, reach, block), "id", "left").select(
            "id", "vec", F.coalesce("mark", F.lit(float("-inf"))).alias("mark"), F.pmod(F.xxhash64("id"), F.lit(rb)).alias("__r"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last - 1).cast("long"))).alias("__s"),
        )
        right = self.codes.join(F.broadcast(places), "cell").select(
            F.col("seed_id").alias("__seed"), F.col("vec").alias("__seed_vec"), "cell", "code", "scale", F.col("left").alias("rest"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rb - 1).cast("long"))).alias("__seed_r"),
            (F.col("__first") + F.pmod(F.xxhash64("seed_id"), "__parts")).alias("__seed_s"),
        )
        step = min(block, TILE)

        def products(distance: np.ndarray, length: np.ndarray) -> np.ndarray:
            """The inner products of distances, a little less for their rounding."""
            out = 1 - distance if metric == "cosine" else -distance if metric == "dot" else (length**2 - 1 - distance**2) / 2
            return out - 1e-9 * length

        def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            out = [pd.DataFrame({"id": [], "seed_id": [], "distance": []}).astype({"id": "int64", "seed_id": "int64", "distance": "float64"})]
            if a.empty or b.empty:
                return out[0]
            b = b.sort_values(["cell", "__seed"])
            here, starts = np.unique(b["cell"].to_numpy(), return_index=True)
            ends, at = [*starts[1:], len(b)], np.searchsorted(cells, here)
            seed, full, left_out = b["__seed"].to_numpy(), _prepared(_matrix(b["__seed_vec"]), metric), b["rest"].to_numpy()
            x = np.frombuffer(b"".join(b["code"]), np.int8).reshape(len(b), -1) * b["scale"].to_numpy()[:, None] + np.repeat(centres[at], np.diff([*starts, len(b)]), axis=0)
            ids, vectors, first_mark = a["id"].to_numpy(), _matrix(a["vec"]), a["mark"].to_numpy()
            for start in range(0, len(a), step):
                raw, mark, name = vectors[start : start + step], first_mark[start : start + step].copy(), ids[start : start + step]
                q, own = _as_products(raw, metric, True), _prepared(raw, metric)
                length, every = np.linalg.norm(q, axis=1), np.arange(len(q))
                bound = q @ centres[at].T + length[:, None] * radius[at] * reach
                bound += 1e-9 * (1 + np.abs(bound))
                lists, waiting, n_waiting = _Lists(len(q), k), [], 0

                def compare(waiting=waiting, lists=lists, mark=mark, name=name, own=own, length=length, every=every) -> None:
                    row, item, low, high = (np.concatenate(w) for w in zip(*waiting))
                    waiting.clear()
                    known = products(lists.distance, length[:, None])
                    rows_, values = np.concatenate([np.repeat(every, k), row]), np.concatenate([known.ravel(), low])
                    order = np.lexsort((-values, rows_))
                    np.maximum(mark, values[order][np.searchsorted(rows_[order], every) + k - 1], out=mark)
                    near = high >= mark[row]
                    row, item = row[near], item[near]
                    distance = _pair_distances(own, full, row, item, metric)
                    lists.add(row, seed[item], distance)
                    np.maximum(mark, products(lists.distance[:, -1], length), out=mark)
                    if compared:
                        out.append(pd.DataFrame({"id": name[row], "seed_id": seed[item], "distance": distance}))

                for c in np.argsort(-bound.max(axis=0), kind="stable"):
                    some = np.flatnonzero(bound[:, c] >= mark)
                    for s in range(starts[c], ends[c], 4 * TILE) if len(some) else ():
                        e = min(s + 4 * TILE, ends[c])
                        value = q[some] @ x[s:e].T
                        error = length[some, None] * (left_out[s:e] + 1e-9)
                        row, item = np.divmod(np.flatnonzero(value + error >= mark[some, None]), value.shape[1])
                        value, error = value[row, item], error[row, item]
                        waiting.append((some[row], item + s, value - error, value + error))
                        n_waiting += len(row)
                        if n_waiting >= 4 * PAIRS:
                            compare()
                            n_waiting = 0
                if n_waiting:
                    compare()
                if not compared:
                    row, nth = np.nonzero(lists.item != NONE)
                    out.append(pd.DataFrame({"id": name[row], "seed_id": lists.item[row, nth], "distance": lists.distance[row, nth]}))
            return pd.concat(out)

        return left.groupBy("__r", "__s").cogroup(right.groupBy("__seed_r", "__seed_s")).applyInPandas(meet, _OUT)

    def candidates(self, rows: DataFrame, k: int, pool: int | None = None, reach: float = 1.0, block: int = BLOCK_ROWS) -> DataFrame:
        """(id, seed_id): the pairs whose full vectors are compared. With `reach` 1 they hold every row's k nearest items."""
        return self._search(rows, k, pool, reach, block, True).select("id", "seed_id")

    def nearest(self, rows: DataFrame, k: int, pool: int | None = None, reach: float = 1.0, block: int = BLOCK_ROWS) -> DataFrame:
        """k nearest items of every row: id, seed_id, distance, place. Rows and items have one row for each id."""
        if not self.size:
            return rows.sparkSession.createDataFrame([], _OUT + ", place int")
        place = Window.partitionBy("id").orderBy("distance", "seed_id")
        found = self._search(rows, k, pool, reach, block, False)
        return found.withColumn("place", F.row_number().over(place)).where(F.col("place") <= k)


def indexed_nearest(rows: DataFrame, seeds: DataFrame, k: int, metric: str = "cosine", pool: int | None = None, reach: float = 1.0, most_cells: int = 4096) -> DataFrame:
    """k nearest seeds of every row from a `ProductIndex`: id, seed_id, distance, place."""
    return ProductIndex(seeds, metric, most_cells).nearest(rows, k, pool, reach)


def gram(df: DataFrame, vector: str = "vec") -> tuple[np.ndarray, np.ndarray, int]:
    """Sums of x x' and x over all rows: one small matrix per task, added up by cell."""
    dim = df.select(F.size(vector).alias("d")).first()["d"]

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((dim + 1, dim + 1))
        for batch in batches:
            if len(batch):
                x = np.hstack([np.ones((len(batch), 1)), _matrix(batch[vector])])
                total += x.T @ x
        yield pd.DataFrame({"i": np.arange(total.size), "v": total.ravel()})

    cells = df.select(vector).mapInPandas(part, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((dim + 1) ** 2)
    for c in cells:
        out[c["i"]] = c["v"]
    full = out.reshape(dim + 1, dim + 1)
    return full[1:, 1:], full[0, 1:], int(round(full[0, 0]))


def principal_axes(df: DataFrame, n: int, centered: bool = True, vector: str = "vec") -> tuple[np.ndarray, np.ndarray]:
    """Leading axes (PCA when centred, truncated SVD when not) and the centre."""
    xx, x, count = gram(df, vector)
    center = x / count if centered else np.zeros_like(x)
    values, vectors = np.linalg.eigh(xx / count - np.outer(center, center))
    axes = vectors[:, np.argsort(values)[::-1][:n]]
    return axes * np.where(axes[np.abs(axes).argmax(0), range(n)] < 0, -1, 1), center


def project(df: DataFrame, axes: np.ndarray, center: np.ndarray | None = None, vector: str = "vec") -> DataFrame:
    """Replace the vectors by their coordinates on the axes."""
    shift = np.zeros(axes.shape[0]) if center is None else center

    @F.pandas_udf("array<double>")
    def coordinates(vec: pd.Series) -> pd.Series:
        return pd.Series(list((_matrix(vec) - shift) @ axes))

    return df.withColumn(vector, coordinates(vector))


def random_axes(dim: int, n: int, seed: int = 1) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, n)) / np.sqrt(n)


def _means_of_nearest(
    rows: DataFrame, seeds: DataFrame, targets: DataFrame, ks: Sequence[int], block: int, shortest, limit_bytes: int, many: bool = False
) -> DataFrame:
    """(id, subset, k, mean, target): mean distance to the k nearest seeds for every k of a grid that the seeds can fill.

    Seeds of at most `limit_bytes` are sent to all tasks: a row's distances never leave its task, only its means do. More seeds
    meet blocks of rows in groups of bounded bytes; of each pair a row keeps its smallest distances, one array for each subset,
    and the arrays of its groups are merged and summed up once. `shortest(rows, seeds)` yields (subset, sorted distances by row).
    With `many` subsets a row is much work and few bytes: rows are dealt out to all cores, meet their targets before the search
    and not as many times after it, and go through a subset together. What leaves a task is then packed: a row for each subset and
    k, with arrays of id, target and mean.
    """
    grid = sorted(set(ks))
    size = seeds.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("d")).first()
    if size["n"] * ((size["d"] or 0) + 1) * 8 <= limit_bytes:
        context = rows.sparkSession.sparkContext
        shared = context.broadcast(_matrix(seeds.select("vec").toPandas()["vec"]))
        plain, at_once = rows.select("id", "vec"), BLOCK_ROWS if many else TILE
        if many:
            plain = plain.join(targets, "id")
            plain = plain.repartition(max(1, min(2 * context.defaultParallelism, -(-rows.count() // ROWS))))
        kept = {c: kind for c, kind in plain.dtypes if c not in ("id", "vec")}

        def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            y = shared.value
            usable = [k for k in grid if k <= len(y)]
            at = np.array(usable, dtype=int) - 1
            for batch in batches:
                for start in range(0, len(batch) if usable else 0, at_once):
                    some = batch.iloc[start : start + at_once]
                    found, most = [], max(1, FRAME_ROWS // (len(some) * len(usable)))

                    def frame(some=some, found=found) -> pd.DataFrame:
                        n = len(found) * len(usable)
                        if many:
                            out = {c: [some[c].to_numpy()] * n for c in ("id", *kept)}
                            return pd.DataFrame(out | {"subset": np.repeat([s for s, _ in found], len(usable)), "k": usable * len(found), "mean": [c for _, m in found for c in m.T]})
                        return pd.DataFrame(
                            {"id": np.tile(np.repeat(some["id"].to_numpy(), len(usable)), len(found)), "subset": np.repeat([s for s, _ in found], len(some) * len(usable)),
                             "k": np.tile(usable, len(some) * n // len(usable)), "mean": np.concatenate([m.ravel() for _, m in found])}
                        )

                    for subset, near in shortest(_matrix(some["vec"]), y):
                        found.append((subset, np.cumsum(near, axis=1)[:, at] / (at + 1)))
                        if len(found) == most:
                            yield frame()
                            found.clear()
                    if found:
                        yield frame()

        if not many:
            return plain.mapInPandas(part, "id long, subset int, k int, mean double").join(targets, "id")
        arrays = ["id array<bigint>", *[f"{c} array<{kind}>" for c, kind in kept.items()], "mean array<double>"]
        return plain.mapInPandas(part, ", ".join([*arrays, "subset int, k int"]))
    left = rows.select("id", "vec").withColumn("cell", F.lit(0).cast("long"))
    right = seeds.select("seed_id", "vec").withColumn("cell", F.lit(0).cast("long"))
    # Rows meet in small blocks: the arrays of many subsets are larger than what they come from.

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        ids, subsets, found = [], [], []
        if len(a) and len(b):
            x, y, names = _matrix(a["vec"]), _matrix(b["__i_vec"]), a["id"].to_numpy()
            for start in range(0, len(x), TILE):
                for subset, near in shortest(x[start : start + TILE], y):
                    ids.append(names[start : start + TILE])
                    subsets.append(np.full(len(near), subset))
                    found.extend(near)
        ids, subsets = (np.concatenate(c) if c else [] for c in (ids, subsets))
        return pd.DataFrame({"id": pd.Series(ids, dtype="int64"), "subset": pd.Series(subsets, dtype="int32"), "distances": found})

    parts = _meet(left, right, "cell", block, meet, "id long, subset int, distances array<double>", max(block, group_rows(seeds)))
    merged = parts.groupBy("id", "subset").agg(F.flatten(F.collect_list("distances")).alias("distances"))

    @F.pandas_udf("array<struct<k:int,mean:double>>")
    def means(distances: pd.Series) -> pd.Series:
        out = []
        for values in distances:
            upto = np.cumsum(np.sort(values)[: grid[-1]])
            out.append([{"k": k, "mean": upto[k - 1] / k} for k in grid if k <= len(upto)])
        return pd.Series(out)

    return merged.select("id", "subset", F.inline(means("distances"))).join(targets, "id")


def k_grid(
    rows: DataFrame, seeds: DataFrame, targets: DataFrame, ks: Sequence[int], metric: str = "cosine", block: int = 2000, limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Mean average precision of the mean-distance score for every k of a grid that the seeds can fill, up to thousands.

    One row for each (id, k) leaves the tasks, not one for each neighbour.
    """
    most = max(ks)

    def shortest(x: np.ndarray, y: np.ndarray):
        k = min(most, len(y))
        a, b, out, step = _prepared(x, metric), _prepared(y, metric), np.empty((len(x), k)), max(1, 2_000_000 // len(y))
        for start in range(0, len(x), step):
            d = _between(a[start : start + step], b, metric)
            d.partition(k - 1, axis=1)
            out[start : start + step] = np.sort(d[:, :k], axis=1)
        yield 0, out

    means = _means_of_nearest(rows, seeds, targets, ks, block, shortest, limit_bytes)
    return mean_average_precision(cut_lineage(means.select("id", "k", F.round("mean", 9).alias("mean"), "target")), "mean", "target", "id", descending=False, group=["k"])


def feature_search(
    rows: DataFrame, seeds: DataFrame, subsets: Sequence[Sequence[int]], k: int, metric: str = "cosine", block: int = 2000, limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Mean average precision of the look-alike score for any number of feature subsets: subset, map.

    `rows`: id, vec, target. Rows and seeds are read once for all subsets; a subset's distances are products of its own features
    only, screened in single precision against a bound of each row's k-th distance.
    """
    chosen = [np.array(sorted(set(s)), dtype=int) for s in subsets]

    def shortest(x: np.ndarray, y: np.ndarray):
        n = min(k, len(y))
        for i, features in enumerate(chosen):
            yield i, _least(np.ascontiguousarray(x[:, features]), np.ascontiguousarray(y[:, features]), n, metric)

    targets = rows.select("id", F.coalesce(F.col("target") == 1, F.lit(False)).cast("tinyint").alias("target"))
    means = _means_of_nearest(rows, seeds, targets, [k], block, shortest, limit_bytes, many=True)
    packed = dict(means.dtypes)["mean"].startswith("array")
    mean = F.transform("mean", lambda x: F.round(x, 9)) if packed else F.round("mean", 9)
    scored = cut_lineage(means.select("id", "subset", mean.alias("mean"), "target"))
    return mean_average_precision(scored, "mean", "target", "id", descending=False, group=["subset"])


def seed_recall(scored: DataFrame, score: str, target: str, tie: str, n: int, descending: bool = False) -> DataFrame:
    """Recall of the positives and share of the population among the n best rows."""
    # The ranking reads its input several times, and here that is a neighbour search.
    ranked = global_rank(cut_lineage(scored), score, tie, descending=descending, rank="__rank")
    best = F.col("__rank") <= n
    positive = F.col(target) == 1
    return ranked.agg(
        ratio(F.count(F.when(best & positive, 1)), F.count(F.when(positive, 1))).alias("recall"),
        ratio(F.count(F.when(best, 1)), F.count(F.lit(1))).alias("share"),
    )


def sample_profile(df: DataFrame, category: str, key: str, n: int, samples: int = 30, seed: str = "p") -> DataFrame:
    """Mean count of each category over repeated samples of n rows without replacement.

    Every row is drawn for all samples at once. Hashes are uniform, so only those below a bound that n rows
    reach with near certainty are kept and ranked; if a sample falls short, the bound is raised.
    """
    rows = df.select(category, key)
    size = rows.count()
    wanted = min(n, size)
    reach = wanted + 6 * math.sqrt(wanted) + 10
    while True:
        bound = min(HASH_RANGE, math.ceil(HASH_RANGE * reach / max(size, 1)))
        drawn = rows.select(category, key, F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("__sample"))
        drawn = drawn.withColumn("__hash", key_hash(key, F.concat(F.lit(seed), F.col("__sample").cast("string"))))
        drawn = cut_lineage(drawn.where(F.col("__hash") < bound))
        found = drawn.groupBy("__sample").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("n")).first()
        if bound == HASH_RANGE or (found["k"] == samples and found["n"] >= wanted):
            break
        reach *= 2
    parts = bucket_count(drawn)
    ranked = global_rank(drawn, "__hash", key, ["__sample"], rank="__rank", cuts=[bound * i / parts for i in range(1, parts)])
    return ranked.where(F.col("__rank") <= n).groupBy(category).agg((F.count(F.lit(1)) / F.lit(samples)).alias("mean_count"))


def discard_unknown(df: DataFrame, missing: dict[str, object]) -> DataFrame:
    """Drop rows in which every named column has its 'no signal' value."""
    none = F.lit(True)
    for c, value in missing.items():
        none = none & (F.col(c).isNull() if value is None else F.col(c).eqNullSafe(F.lit(value)))
    return df.where(~none)


def as_vectors(df: DataFrame, key: str, vector: str, name: str = "id") -> DataFrame:
    return df.select(F.col(key).cast("long").alias(name), F.col(vector).cast("array<double>").alias("vec"))


def unit(column: Column) -> Column:
    """Vector of length one."""
    norm = F.sqrt(F.aggregate(column, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(column, lambda x: x / norm)
