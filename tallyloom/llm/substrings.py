"""Suffix-array dedup: every byte of a window that is repeated somewhere, found by a depth-limited radix sort.

Windows of `WINDOW` bytes are the suffixes cut at the threshold. They are sorted by digits, the most significant first, and
a pass goes on only with groups of two or more. The first digit of a window is the gram of GRAM bytes with the smallest
hash in it: equal windows have equal grams at equal places, and neighbouring windows share theirs, so one row, an anchor,
stands for a stretch of windows. Stretches with equal bytes around equal grams are equal windows altogether. What is left
of a gram's group, where repeats begin and end, is sorted by the whole windows in the last pass.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import BASE, Prefix, mix64, pieces, utf8_of
from tallyloom.llm.common import KEY, key_columns, release
from tallyloom.session import cut_lineage

WINDOW = 200
GRAM = 100
PIECE = 1 << 20
PLACE_BITS = 26
PLACE_MASK = np.uint64((1 << PLACE_BITS) - 1)
RUN_ROWS = 100_000
SPAN, OPEN = 0, 1


def _sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every `width` consecutive values, by doubling."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return x if done == width else np.minimum(x[: done - width], x[width - done :])


def anchors(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(row, low, high, digit, around): windows low..high of a row share the gram `digit`; `around` is the hash of all their
    bytes and of the gram's place. Ties of grams go to the right, which depends on the window alone."""
    n = len(data)
    if n < window:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    prefix = Prefix(data)
    grams = (prefix.sums[gram:] - prefix.sums[: n - gram + 1]) * prefix.back[: n - gram + 1]
    grams = (grams ^ (grams >> np.uint64(32))) * np.uint64(BASE)
    grams ^= grams >> np.uint64(29)
    place = np.arange(len(grams), dtype=np.uint64)
    least = _sliding_least((grams & ~PLACE_MASK) | (PLACE_MASK - (place & PLACE_MASK)), window - gram + 1)
    valid = np.ones(n, dtype=bool)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        valid[max(a, b - window + 1) : b] = False
    at = np.flatnonzero(valid[: len(least)])
    if not len(at):
        return anchors(data[:0], offsets[:1], window, gram)
    chosen = at + (((PLACE_MASK - (least[at] & PLACE_MASK)).astype(np.int64) - at) & int(PLACE_MASK))
    heads = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    low, high, chosen = at[heads], at[np.append(heads[1:], len(at)) - 1], chosen[heads]
    row = np.searchsorted(offsets, low, side="right") - 1
    shape = ((chosen - low) * (2 * window) + (high - low)).astype(np.uint64)
    around = mix64(prefix.of(low, high + window) + shape * np.uint64(BASE))
    start = offsets[row]
    return row, low - start, high - start, grams[chosen], around


def _anchor_rows(window: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(digit, around, keys, low, high, kind). Of equal texts a task sends one; for the others, and then for that one too,
        it sends a span of the whole text."""
        seen: dict[bytes, tuple[int, int] | None] = {}
        for batch in batches:
            data, offsets = utf8_of(batch.column("text"))
            k1, k2 = (batch.column(k).to_numpy() for k in KEY)
            fresh, whole = np.ones(len(k1), dtype=bool), []
            for r in np.flatnonzero(np.diff(offsets) >= window).tolist():
                name = hashlib.blake2b(data[offsets[r] : offsets[r + 1]], digest_size=16).digest()
                if name in seen:
                    fresh[r] = False
                    whole.append((int(k1[r]), int(k2[r]), int(offsets[r + 1] - offsets[r])))
                    if seen[name]:
                        whole.append((*seen[name], int(offsets[r + 1] - offsets[r])))
                        seen[name] = None
                else:
                    seen[name] = (int(k1[r]), int(k2[r]))
            for i, j in pieces(offsets, PIECE):
                row, low, high, digit, around = anchors(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], window, gram)
                row = row + i
                use = fresh[row]
                row, columns = row[use], [c[use] for c in (digit.view(np.int64), around.view(np.int64))]
                yield pa.record_batch(
                    [*map(pa.array, columns), pa.array(k1[row]), pa.array(k2[row]), pa.array(low[use].astype(np.int32)), pa.array(high[use].astype(np.int32)), pa.array(np.full(len(row), OPEN, np.int32))],
                    names=["digit", "around", *KEY, "low", "high", "kind"],
                )
            if whole:
                a, b, n = map(np.array, zip(*whole))
                yield pa.record_batch(
                    [pa.array(a), pa.array(a), pa.array(a), pa.array(b.astype(np.int32)), pa.array(np.zeros(len(a), np.int32)), pa.array(n.astype(np.int32)), pa.array(np.full(len(a), SPAN, np.int32))],
                    names=["digit", "around", *KEY, "low", "high", "kind"],
                )

    return rows


def _runs_of(*columns: np.ndarray) -> np.ndarray:
    """First places of the runs of equal rows."""
    new = np.zeros(len(columns[0]), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _split_groups(window: int):
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchors in the order of (digit, around) to (keys, low, high, kind).

        Equal stretches are spans. In a digit's group with different stretches, one of each is open: its windows go to the
        last pass. A very large group is handled in parts that share its first and last rows, so memory stays bounded; rows
        sent twice are told apart by their place later.
        """
        names = ["digit", "around", *KEY, "low", "high", "kind"]
        held = None

        def decided(rows: list[np.ndarray]) -> pa.RecordBatch:
            digit, around, k1, k2, low, high, kind = rows
            whole = kind == SPAN
            out = [(k1[whole], k2[whole], low[whole], high[whole], np.full(int(whole.sum()), SPAN))]
            digit, around, k1, k2, low, high = (c[~whole] for c in (digit, around, k1, k2, low, high))
            heads = _runs_of(digit, around)
            sizes = np.diff(np.append(heads, len(digit)))
            groups = _runs_of(digit[heads])
            variants = np.repeat(np.diff(np.append(groups, len(heads))), np.diff(np.append(groups, len(heads))))
            same = np.repeat(sizes > 1, sizes)
            out.append((k1[same], k2[same], low[same], high[same] + window, np.full(int(same.sum()), SPAN)))
            one = heads[variants > 1]
            out.append((k1[one], k2[one], low[one], high[one], np.full(len(one), OPEN)))
            a, b, c, d, e = (np.concatenate(x) for x in zip(*out))
            return pa.record_batch([pa.array(a), pa.array(b.astype(np.int32)), pa.array(c.astype(np.int32)), pa.array(d.astype(np.int32)), pa.array(e.astype(np.int32))], names=[*KEY, "low", "high", "kind"])

        for batch in batches:
            rows = [batch.column(k).to_numpy() for k in names]
            held = rows if held is None else [np.concatenate([a, b]) for a, b in zip(held, rows)]
            if not len(held[0]):
                continue
            last = int(np.flatnonzero(np.append(True, held[0][1:] != held[0][:-1]))[-1])
            if last:
                yield decided([c[:last] for c in held])
                held = [c[last:] for c in held]
            elif len(held[0]) > RUN_ROWS:
                yield decided(held)
                end = held[1] == held[1][-1]
                some = np.unique(np.concatenate([[0], np.flatnonzero(end)[:2]]))
                held = [c[some] for c in held]
        if held is not None and len(held[0]):
            yield decided(held)

    return split


def _window_rows(window: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(digest, keys, at) of all windows of the open stretches."""
        for batch in batches:
            data, offsets = utf8_of(batch.column("text"))
            k1, k2 = (batch.column(k).to_numpy() for k in KEY)
            stretches = batch.column("open")
            bounds, flat = stretches.offsets.to_numpy(), stretches.values
            low, high = (flat.field(f).to_numpy().astype(np.int64) for f in ("low", "high"))
            for i, j in pieces(offsets, PIECE):
                prefix = Prefix(data[offsets[i] : offsets[j]])
                s, e = bounds[i], bounds[j]
                of = np.repeat(np.arange(i, j), np.diff(bounds[i : j + 1]))
                sizes = high[s:e] - low[s:e] + 1
                row = np.repeat(of, sizes)
                at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low[s:e], sizes)
                start = offsets[row] - offsets[i] + at
                digest = prefix.of(start, start + window).view(np.int64)
                yield pa.record_batch([pa.array(digest), pa.array(k1[row]), pa.array(k2[row]), pa.array(at.astype(np.int32))], names=["digest", *KEY, "at"])

    return rows


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows in the order of (digest, keys, at) to those whose digest stands at two places or more."""
    names, held = ["digest", *KEY, "at"], None

    def decided(rows: list[np.ndarray]) -> pa.RecordBatch:
        digest, k1, k2, at = rows
        heads = _runs_of(digest)
        tails = np.append(heads[1:], len(digest)) - 1
        many = (k1[heads] != k1[tails]) | (k2[heads] != k2[tails]) | (at[heads] != at[tails])
        keep = np.repeat(many, tails - heads + 1)
        return pa.record_batch([pa.array(k1[keep]), pa.array(k2[keep]), pa.array(at[keep])], names=[*KEY, "at"])

    for batch in batches:
        rows = [batch.column(k).to_numpy() for k in names]
        held = rows if held is None else [np.concatenate([a, b]) for a, b in zip(held, rows)]
        if not len(held[0]):
            continue
        last = int(np.flatnonzero(np.append(True, held[0][1:] != held[0][:-1]))[-1])
        if last:
            yield decided([c[:last] for c in held])
            held = [c[last:] for c in held]
        elif len(held[0]) > RUN_ROWS:
            yield decided(held)
            held = [c[[0, -1]] for c in held]
    if held is not None and len(held[0]):
        yield decided(held)


def _merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by [low, high)."""
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.append(True, low[1:] > high[:-1])
    return low[new], high[np.append(np.flatnonzero(new)[1:] - 1, len(high) - 1)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, found = batch.column("text"), batch.column("spans")
        sizes, removed, runs, kept = [], [], [], []
        for text, spans in zip(texts, found):
            body = (text.as_py() or "").encode()
            low = high = np.zeros(0, np.int64)
            if spans.is_valid and len(spans):
                low, high = _merged(*(spans.values.field(f).to_numpy().astype(np.int64) for f in ("low", "high")))
            digest, at = hashlib.sha256(), 0
            for a, b in zip(low.tolist(), high.tolist()):
                digest.update(body[at:a])
                at = b
            digest.update(body[at:])
            sizes.append(len(body))
            removed.append(int((high - low).sum()))
            runs.append(len(low))
            kept.append(digest.hexdigest())
        yield pa.record_batch([batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (sizes, removed, runs)), pa.array(kept, pa.string())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(keys, low, high): byte ranges whose union is what repeated windows cover, for every row with any. Materialised."""
    spark = docs.sparkSession
    keyed = docs.select(*key_columns(doc_id, text), F.col(text).alias("text"))
    sent = keyed.mapInArrow(_anchor_rows(window, gram), "digit long, around long, __k1 long, __k2 int, low int, high int, kind int")
    sent = sent.repartition("digit").sortWithinPartitions("digit", "around")
    parts = cut_lineage(sent.mapInArrow(_split_groups(window), "__k1 long, __k2 int, low int, high int, kind int"))
    del sent
    release(spark)
    # The hash partitioning of texts and of their stretches is the same, so each text moves once.
    stretches = parts.filter(f"kind = {OPEN}").groupBy(*KEY).agg(F.collect_set(F.struct("low", "high")).alias("open"))
    texts = keyed.join(stretches, KEY).select(*KEY, "text", "open")
    windows = texts.mapInArrow(_window_rows(window), "digest long, __k1 long, __k2 int, at int")
    windows = windows.repartition("digest").sortWithinPartitions("digest", *KEY, "at")
    again = cut_lineage(windows.mapInArrow(_repeated, "__k1 long, __k2 int, at int"))
    del stretches, texts, windows
    release(spark)
    last = again.select(*KEY, F.col("at").alias("low"), (F.col("at") + window).alias("high"))
    spans = parts.filter(f"kind = {SPAN}").select(*KEY, "low", "high").unionByName(last)
    spans = cut_lineage(spans.groupBy(*KEY).agg(F.collect_list(F.struct("low", "high")).alias("spans")))
    release(spark)
    return spans


def remove_repeated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document without the bytes of repeated windows.

    Null text is empty; a text shorter than the window loses nothing; equal texts of at least its length lose everything,
    rows that repeat id and text as well. Other columns are ignored.
    """
    if not 0 < gram < window:
        raise ValueError("the gram must be shorter than the window")
    spans = repeated_spans(docs, window, gram, doc_id, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), *key_columns(doc_id, text), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    joined = rows.join(spans, KEY, "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
