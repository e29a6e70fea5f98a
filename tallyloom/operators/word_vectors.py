"""Word vectors by skip-gram with negative samples, trained in blocks by many tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words a task learns from at least; words of the first round, which gives all tasks the same directions.
LEARNER_WORDS, CORE_WORDS = 2_000_000, 4_000_000
#: Words of a block, words of a tile inside it, negative words of a block, negatives that a pair counts for.
BLOCK, TILE, NEGATIVES, PER_PAIR = 1024, 32, 32, 2
#: Step lengths of the first round, of the later ones and at the end of each; squared gradient that every word starts with.
CORE_STEP, STEP, LAST_STEP, DAMP = 1.0, 0.25, 0.02, 100.0
#: Words that a task learns from and sums up at once.
HELD, SUMMED = 1 << 18, 1 << 14


def _uniform(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Start vectors of words: hashed, so every task has the same ones."""
    x = (words.astype(np.uint64)[:, None] * np.uint64(size) + np.arange(size, dtype=np.uint64)) ^ (np.uint64(seed) << np.uint64(40))
    x = (x + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return (((x >> np.uint64(40)).astype(np.float32) / np.float32(1 << 24)) - np.float32(0.5)) / np.float32(size)


class Learner:
    """The model of one task: rows for the words it has met, row 0 for the gaps between documents."""

    def __init__(self, counts: np.ndarray, size: int, window: int, seed: int, start: tuple[np.ndarray, np.ndarray] | None, draw: tuple[int, ...]):
        self.size, self.window, self.seed, self.start = size, window, seed, start
        self.tile = max(TILE, 2 * window)
        self.rng = np.random.default_rng((seed, *draw))
        self.drawn = np.cumsum(counts.astype(np.float64) ** 0.75)
        self.row = np.full(len(counts), -1, dtype=np.int32)
        self.words = np.zeros(0, dtype=np.int32)
        # A row: vector as input, vector as output; squared sums of both.
        self.model = np.zeros((1, 2 * size), np.float32)
        self.grown = np.zeros((1, 2), np.float32)
        self.seen = np.zeros(1, dtype=np.int64)
        shift = np.arange(self.tile + 2 * window)[None, :] - window - np.arange(self.tile)[:, None]
        # A pair d words apart counts as often as a window drawn from 1 to `window` holds it.
        self.weights = np.where(shift == 0, 0, np.maximum(window + 1 - np.abs(shift), 0) / window).astype(np.float32)
        self.done = 0

    def rows_of(self, words: np.ndarray) -> np.ndarray:
        found = self.row[words]
        new = np.unique(words[found < 0])
        if len(new):
            used = len(self.words) + 1
            need = used + len(new)
            if need > len(self.model):
                more = max(need, 2 * len(self.model)) - len(self.model)
                grow = lambda x: np.concatenate([x, np.zeros((more, *x.shape[1:]), x.dtype)])
                self.model, self.grown, self.seen = grow(self.model), grow(self.grown), grow(self.seen)
            self.model[used:need, : self.size] = _uniform(new, self.size, self.seed)
            if self.start is not None:
                ids, values = self.start
                at = np.minimum(np.searchsorted(ids, new), len(ids) - 1)
                known = np.flatnonzero(ids[at] == new)
                values = values[at[known]]
                self.model[used + known], self.grown[used + known] = values[:, :-2], values[:, -2:]
            self.row[new] = np.arange(used, need, dtype=np.int32)
            self.words = np.concatenate([self.words, new.astype(np.int32)])
            found = self.row[words]
        return found

    def learn(self, words: np.ndarray, sizes: np.ndarray, step: Callable[[int], float]) -> None:
        """One pass over documents that follow one another in `words`; pairs never span documents."""
        w, tile = self.window, self.tile
        rows = self.rows_of(words)
        self.seen[: len(self.words) + 1] += np.bincount(rows, minlength=len(self.words) + 1)
        block = BLOCK // tile * tile
        long = len(words) + w * len(sizes)
        stream = np.zeros(w + -(-long // tile) * tile + w, dtype=np.int32)
        stream[w + np.arange(len(words)) + np.repeat(np.arange(len(sizes)) * w, sizes)] = rows
        firsts = range(0, len(stream) - 2 * w, block)
        drawn = np.searchsorted(self.drawn, self.rng.random((len(firsts), NEGATIVES)) * self.drawn[-1], side="right")
        others = self.rows_of(drawn.ravel()).reshape(drawn.shape)
        for i, first in enumerate(firsts):
            near = stream[first : first + block + 2 * w]
            self._block(near, others[i], np.float32(step(self.done)))
            self.done += int(np.count_nonzero(near[w:-w]))

    def _block(self, near: np.ndarray, others: np.ndarray, step: np.float32) -> None:
        w, tile, size = self.window, self.tile, self.size
        n, tiles = len(near) - 2 * w, (len(near) - 2 * w) // tile
        held = self.model[near]
        x, y = np.ascontiguousarray(held[w:-w, :size]), np.ascontiguousarray(held[:, size:])
        xs = x.reshape(tiles, tile, size)
        ys = np.lib.stride_tricks.as_strided(y, (tiles, tile + 2 * w, size), (tile * y.strides[0], *y.strides))
        real = (near != 0).astype(np.float32)
        pairs = np.zeros(n, np.float32)
        for d in range(1, w + 1):
            pairs += (real[w - d : w - d + n] + real[w + d : w + d + n]) * np.float32((w + 1 - d) / w)
        pairs *= real[w:-w]
        far = self.model[others, size:]
        # Gaps are zero vectors, so pairs with them add nothing.
        pull, push = xs @ np.ascontiguousarray(ys.transpose(0, 2, 1)), x @ np.ascontiguousarray(-far.T)
        for scores, weights in ((pull, self.weights), (push, (pairs * np.float32(PER_PAIR / NEGATIVES))[:, None])):
            np.minimum(scores, 80, out=scores)
            np.exp(scores, out=scores)
            scores += 1
            np.divide(weights, scores, out=scores)
        by = np.zeros((len(near) + NEGATIVES, 2 * size), np.float32)
        by[w : w + n, :size] = (pull @ ys).reshape(n, size) - push @ far
        parts = pull.transpose(0, 2, 1) @ xs
        to_y = np.zeros((tiles + 1, tile, size), np.float32)
        to_y[:-1] += parts[:, :tile]
        to_y[1:, : 2 * w] += parts[:, tile:]
        by[: len(near), size:] = to_y.reshape(-1, size)[: len(near)]
        by[len(near) :, size:] = -(push.T @ x)
        self._move(np.concatenate([near, others]), by, step)

    def _move(self, rows: np.ndarray, by: np.ndarray, step: np.float32) -> None:
        """Sum of a block for each word, shortened by the word's squared sums so far: frequent words do not overshoot."""
        order = np.argsort(rows, kind="stable")
        ordered = rows[order]
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        total, at = np.add.reduceat(by[order], first, axis=0).reshape(len(first), 2, self.size), ordered[first]
        grown = self.grown[at] + np.einsum("ijk,ijk->ij", total, total) / np.float32(self.size)
        self.grown[at] = grown
        total *= (step / np.sqrt(grown + np.float32(DAMP)))[:, :, None]
        self.model[at] += total.reshape(len(first), -1)
        self.model[0] = 0

    def result(self, whole: bool) -> Iterator[pa.RecordBatch]:
        n = len(self.words) + 1
        values = np.hstack([self.model[:n], self.grown[:n]]) if whole else self.model[:n, : self.size]
        met = np.flatnonzero(self.seen[:n] > 0)
        for i in range(0, len(met), 10_000):
            at = met[i : i + 10_000]
            lists = pa.ListArray.from_arrays(np.arange(len(at) + 1, dtype=np.int32) * values.shape[1], values[at].ravel())
            yield pa.RecordBatch.from_arrays([pa.array(self.words[at - 1]), pa.array(self.seen[at]), lists], ["__word", "__n", "__values"])


def _lists(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, sizes) of an array column without nulls."""
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _encode(shared):
    def run(batches):
        known = shared.value
        for batch in batches:
            hashes, sizes = _lists(batch, "__hashes")
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = known[at] == hashes
            ends = np.concatenate([[0], np.cumsum(hit)])[np.concatenate([[0], np.cumsum(sizes)])].astype(np.int32)
            ids = pa.ListArray.from_arrays(ends, at[hit].astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes.astype(np.int32)), ids], [batch.schema.names[0], "__size", "__ids"])

    return run


def _learn(shared, size: int, window: int, seed: int, turn: int, expected: float, step: float, at_most: int, whole: bool):
    def run(batches):
        counts, start = shared.value
        learner = Learner(counts, size, window, seed, start, (turn, TaskContext.get().partitionId()))
        at = lambda done: step + (LAST_STEP - step) * min(1.0, done / expected)
        for batch in batches:
            words, sizes = _lists(batch, "__ids")
            ends = np.cumsum(sizes)
            first = 0
            while first < len(sizes) and learner.done < at_most:
                begin = int(ends[first - 1]) if first else 0
                last = max(first + 1, int(np.searchsorted(ends, begin + HELD, side="right")))
                learner.learn(words[begin : int(ends[last - 1])], sizes[first:last], at)
                first = last
        yield from learner.result(whole)

    return run


def _means(shared, size: int):
    def run(batches):
        vectors = shared.value
        for batch in batches:
            words, sizes = _lists(batch, "__ids")
            rows = np.repeat(np.arange(len(sizes)), sizes)
            sums = np.zeros((len(sizes), size))
            for i in range(0, len(words), SUMMED):
                at = rows[i : i + SUMMED]
                first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
                sums[at[first]] += np.add.reduceat(vectors[words[i : i + SUMMED]].astype(np.float64), first, axis=0)
            sums /= np.maximum(batch.column("__size").to_numpy(), 1)[:, None]
            lists = pa.ListArray.from_arrays(np.arange(len(sizes) + 1, dtype=np.int32) * size, sums.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], [batch.schema.names[0], "vec"])

    return run


def vocabulary_counts(hashed: DataFrame, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, counts) of the words that occur often enough."""
    counts = hashed.select(F.explode("__hashes").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count).toArrow()
    hashes = counts["h"].to_numpy()
    order = np.argsort(hashes)
    return hashes[order], counts["n"].to_numpy()[order]


def encoded(hashed: DataFrame, key: str, hashes: np.ndarray) -> DataFrame:
    """Per row its number of words and the places of the known ones in the vocabulary, in order."""
    shared = hashed.sparkSession.sparkContext.broadcast(hashes)
    kind = hashed.schema[key].dataType.simpleString()
    return hashed.mapInArrow(_encode(shared), f"`{key}` {kind}, __size int, __ids array<int>")


def _round(rows: DataFrame, shared, width: int, **how) -> tuple[np.ndarray, np.ndarray]:
    """(words in order, values): every task learns from its rows; a word's values are averaged by its occurrences in the tasks.

    The sums are of whole numbers, so the order in which tasks end does not matter.
    """
    learnt = rows.mapInArrow(_learn(shared, **how), "__word int, __n long, __values array<float>")
    fixed = [F.sum(F.round(F.get("__values", F.lit(i)).cast("double") * (1 << 20)).cast("long") * F.col("__n")).alias(f"s{i}") for i in range(width)]
    found = learnt.groupBy("__word").agg(F.sum("__n").alias("__n"), *fixed)
    mean = F.array(*[(F.col(f"s{i}") / F.col("__n") / (1 << 20)).cast("float") for i in range(width)])
    table = found.select("__word", mean.alias("__values")).toArrow()
    words = table["__word"].to_numpy()
    values = table["__values"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    order = np.argsort(words)
    return words[order], values[order]


def train(rows: DataFrame, key: str, counts: np.ndarray, size: int, window: int, iterations: int, seed: int) -> np.ndarray:
    """Vector of every word of the vocabulary; each iteration learns from all rows.

    With several tasks a first round in one task, over a bounded hashed part of the rows, gives them a common start.
    """
    context = rows.sparkSession.sparkContext
    total, parts = int(counts.sum()), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(parts, total // LEARNER_WORDS))
    start, step = None, CORE_STEP
    if tasks > 1:
        draw = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 20)) < int(min(1.0, CORE_WORDS / total) * (1 << 20))
        core = rows.where(draw).repartition(1).sortWithinPartitions(key)
        start = _round(
            core, context.broadcast((counts, None)), 2 * size + 2, size=size, window=window, seed=seed, turn=0,
            expected=min(total, CORE_WORDS), step=CORE_STEP, at_most=CORE_WORDS, whole=True,
        )
        step = STEP
    dealt = rows.repartition(tasks, key).sortWithinPartitions(key)
    for turn in range(1, iterations + 1):
        last = turn == iterations
        start = _round(
            dealt, context.broadcast((counts, start if start is not None and len(start[0]) else None)), size if last else 2 * size + 2, size=size, window=window,
            seed=seed, turn=turn, expected=total / tasks, step=step, at_most=1 << 62, whole=not last,
        )
        step = STEP
    words, values = start
    vectors = np.zeros((len(counts), size), np.float32)
    # Multiples of 2 ** -20, whose sums are exact in any order.
    vectors[words] = np.round(values.astype(np.float64) * (1 << 20)) / (1 << 20)
    return vectors


def mean_vectors(rows: DataFrame, key: str, vectors: np.ndarray) -> DataFrame:
    """Sum of the known words' vectors over the number of all words of a row."""
    shared = rows.sparkSession.sparkContext.broadcast(vectors)
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(_means(shared, vectors.shape[1]), f"`{key}` {kind}, vec array<double>")
