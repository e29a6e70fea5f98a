"""Document fingerprints by locally consistent parsing.

Runs of equal symbols become one symbol. Deterministic coin tossing then gives every symbol a small label that depends on
a few symbols to its left only, and a phrase begins wherever a label is a local minimum. Phrases are named by a hash of
their content and parsed again, level by level. Equal substrings have equal phrases inside, wherever they stand. The
fingerprint keeps, for each of a fixed number of bins, the smallest phrase name that falls into it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.batches import BASE, BASE_INVERSE, BYTE_VALUES, mix64, powers
from tallyloom.session import cut_lineage

LEVELS = 4
FIRST_LEVEL = 2
BINS = 64
EMPTY = 0xFFFF
PIECE_CHARS = 2 << 20
LOWEST_BIT = np.array([0] + [(v & -v).bit_length() - 1 for v in range(1, 256)], dtype=np.uint8)


def _tossed(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """2 * place of the lowest bit in which a symbol differs from the one before, plus that bit; rows begin with their bit 0."""
    place = np.zeros(len(x), dtype=x.dtype)
    differ = x[1:] ^ x[:-1]
    if x.dtype == np.uint8:
        place[1:] = LOWEST_BIT[differ]
    else:
        low = (differ & (~differ + np.uint64(1))).astype(np.float64)
        place[1:] = np.where(differ == 0, 0, (low.view(np.uint64) >> np.uint64(52)).astype(np.int64) - 1023).astype(np.uint64)
    place[first] = 0
    one = x.dtype.type(1)
    return ((place << one) | ((x >> place) & one)).astype(np.uint8)


def _phrases(names: np.ndarray, coins: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names and rows of the phrases of one level; `coins` differ between neighbours of a row."""
    first = np.ones(len(row), dtype=bool)
    first[1:] = row[1:] != row[:-1]
    heads = np.flatnonzero(first)
    labels = _tossed(coins, heads)
    for _ in range(3 if coins.dtype == np.uint64 else 2):
        labels = _tossed(labels, heads)
    begin = first.copy()
    if len(labels) > 2:
        begin[1:-1] |= (labels[1:-1] < labels[:-2]) & (labels[1:-1] < labels[2:]) & ~first[2:]
    starts = np.flatnonzero(begin)
    sums = np.zeros(len(names) + 1, dtype=np.uint64)
    np.cumsum(names * powers(BASE, len(names)), dtype=np.uint64, out=sums[1:])
    stops = np.append(starts[1:], len(names))
    size = (stops - starts).astype(np.uint64)
    return mix64((sums[stops] - sums[starts]) * powers(BASE_INVERSE, len(names) + 1)[starts] + size), row[starts]


def _runs(x: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbol, length and row of the runs of equal symbols."""
    keep = np.ones(len(x), dtype=bool)
    keep[1:] = (x[1:] != x[:-1]) | (row[1:] != row[:-1])
    heads = np.flatnonzero(keep)
    return x[heads], np.diff(np.append(heads, len(x))).astype(np.uint64), row[heads]


def sketches(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """BINS 16-bit values for each text of a concatenation; EMPTY where no phrase falls into a bin."""
    rows = len(sizes)
    least = np.full(rows * BINS, np.iinfo(np.uint64).max, dtype=np.uint64)
    if len(data):
        row = np.repeat(np.arange(rows), sizes)
        symbols, length, row = _runs(data, row)
        names, row = _phrases(mix64(BYTE_VALUES[symbols] + length), symbols, row)
        for level in range(1, LEVELS + 1):
            if level >= FIRST_LEVEL:
                salted = mix64(names + np.uint64(level))
                np.minimum.at(least, row * BINS + (salted % np.uint64(BINS)).astype(np.int64), salted // np.uint64(BINS))
            if level < LEVELS:
                symbols, length, row = _runs(names, row)
                names, row = _phrases(mix64(symbols + length), symbols, row)
    none = least == np.iinfo(np.uint64).max
    return np.where(none, EMPTY, mix64(least) % np.uint64(EMPTY)).astype(np.uint16).reshape(rows, BINS)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bins among those that either side fills: an estimate of the likeness of phrase sets; 1 if both are empty."""
    used = (a != EMPTY) | (b != EMPTY)
    total = used.sum(axis=1)
    return np.where(total == 0, 1.0, ((a == b) & used).sum(axis=1) / np.maximum(total, 1))


def _joined(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    body = [t.encode() for t in texts]
    return np.frombuffer(b"".join(body), np.uint8), np.array([len(b) for b in body], np.int64), body


def _results(ids: pa.Array, texts: list[str], following: list[str]) -> pa.RecordBatch:
    cut = [len(t) - len(t) // 3 for t in texts]
    edited = [t[:c] + n[: len(t) - c] for t, c, n in zip(texts, cut, following)]
    own = sketches(*_joined([*texts, following[-1]])[:2])
    data, sizes, body = _joined(edited)
    changed = sketches(data, sizes)
    hexed = lambda s: pa.array([r.astype(">u2").tobytes().hex() for r in s])
    return pa.record_batch(
        [ids, pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(b).hexdigest() for b in body]), hexed(own[:-1]), hexed(changed),
         pa.array(likeness(own[:-1], changed)), pa.array(likeness(own[:-1], own[1:]))],
        names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of rows that arrive in order; a row whose `last` is set only serves the row before it."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        at, size, rows = 0, 0, table.num_rows
        lengths = [len(t.as_buffer()) for t in table["text"].combine_chunks()] if rows else []
        for i in range(rows):
            size += lengths[i]
            # keep the last row for the next batch: its follower is not known yet
            if i and (size >= PIECE_CHARS or i == rows - 1):
                part = table.slice(at, i - at + 1)
                texts, last = part["text"].to_pylist(), part["last"].to_numpy()
                mine = [k for k in range(len(texts) - 1) if not last[k]]
                # followers are taken in row order; `_results` needs them consecutive, so each stretch between heads is one call
                start = 0
                while start < len(mine):
                    stop = start
                    while stop + 1 < len(mine) and mine[stop + 1] == mine[stop] + 1:
                        stop += 1
                    a, b = mine[start], mine[stop] + 1
                    yield _results(part["doc_id"].combine_chunks()[a:b], texts[a:b], texts[a + 1 : b + 1])
                    start = stop + 1
                at, size = i, lengths[i]
        held = table.slice(rows - 1, 1).combine_chunks().to_batches()[0] if rows else held


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every document and of its edited text, with doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.

    The next document is the one with the next smaller id (null ids last, equal ids in the order of their texts); the first
    one follows the last. Ids are dealt into ranges; each range is read in order and ends with a copy of the next range's
    first document, so texts are shuffled once and no task sees more than its range. Null text is empty; an empty text has
    the fingerprint of 64 empty bins. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = sorted({0.0} | set(rows.select(F.col("doc_id").cast("double").alias("d")).approxQuantile("d", [i / ranges for i in range(1, ranges)], 1 / (4 * ranges))))  # one bound at least, for an empty table
    splits = [-float("inf"), *bounds, float("inf")]
    slot = Bucketizer(splits=splits, inputCol="__d", outputCol="__slot", handleInvalid="keep")
    dealt = slot.transform(rows.withColumn("__d", F.coalesce(F.col("doc_id").cast("double"), F.lit(float("nan")))))
    nth = F.when(F.col("doc_id").isNull(), len(splits)).otherwise(len(splits) - F.col("__slot")).cast("int")
    dealt = dealt.select(nth.alias("nth"), "doc_id", "text")
    # one row for each range, at most as many as shuffle partitions and one
    tops = F.broadcast(cut_lineage(dealt.groupBy("nth").agg(F.max("doc_id").alias("top"))))
    heads = dealt.join(tops, "nth").filter(F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("nth").agg(F.first("top").alias("doc_id"), F.min("text").alias("text"))
    heads = cut_lineage(heads)
    order = Window.orderBy("nth")
    before = F.coalesce(F.lag("nth").over(order), F.max("nth").over(Window.partitionBy()))
    ends = heads.select(before.alias("nth"), "doc_id", "text", F.lit(True).alias("last"))
    stream = dealt.withColumn("last", F.lit(False)).unionByName(ends).repartition(ranges, "nth").sortWithinPartitions("nth", "last", F.col("doc_id").desc_nulls_last(), "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return stream.select("doc_id", "text", "last").mapInArrow(_in_order, schema)
