"""Line operators: cross-site boilerplate by merged sketches, and repeated sentences by digests.

A unit is a line of a text, or a sentence of a line. Its normal form is its words, A-Z lower-cased, with one space between; two
64-bit hashes of the normal form are its digest. Offsets count characters (code points) of the original text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import LOWER, NOT_SPACE, mix64, pieces, stretch_hashes, utf8_of, word_bounds
from tallyloom.llm.common import KEY, key_columns, materialised
from tallyloom.session import cut_lineage

MIN_SITES = 10
MIN_RUN = 16
LG_NOMINAL = 12
BAND = 0.1
LINE_FEED = 10
# Fixed value: marks that end a sentence when white space follows.
SENTENCE_END = np.isin(np.arange(256), np.frombuffer(b".!?", np.uint8))


def units_of(data: np.ndarray, offsets: np.ndarray, sentences: bool = False) -> tuple[np.ndarray, ...]:
    """(row, start, stop, words, d1, d2, nth) of the units with words, in order; start and stop count characters within the row.

    Units are lines without their line feeds. With `sentences` a unit also ends at white space after one of . ! ? and holds the
    character that ends it, so that all units together are the text. nth counts the units with words of a row from 0.
    """
    text = LOWER[data]
    ends_here = data == LINE_FEED
    if sentences:
        ends_here[1:] |= ~NOT_SPACE[data[1:]] & SENTENCE_END[data[:-1]]
        ends_here[offsets[:-1][offsets[:-1] < len(data)]] &= data[offsets[:-1][offsets[:-1] < len(data)]] == LINE_FEED
    breaks = np.flatnonzero(ends_here)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    row = np.searchsorted(offsets, starts, side="right") - 1
    ends = np.minimum(np.append(starts[1:], len(data)), offsets[row + 1])
    if not sentences:
        ends = np.where((ends > starts) & (data[ends - 1] == LINE_FEED), ends - 1, ends)
    a, b, _ = word_bounds(text, offsets, NOT_SPACE)
    words = stretch_hashes(text, a, b, np.zeros(len(a), np.uint64))
    at = np.searchsorted(a, starts)
    n = np.append(at[1:], len(a)) - at
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    place = np.arange(len(a)) - np.repeat(at, n)
    digests = []
    for salt in (1, 2):
        sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(mix64(words ^ mix64((place << 2 | salt).astype(np.uint64))), dtype=np.uint64, out=sums[1:])
        digests.append(mix64(sums[at + n] - sums[at] + n.astype(np.uint64)).view(np.int64))
    some = n > 0
    base = chars[offsets[row]]
    first = np.searchsorted(row[some], row[some])
    return row[some], (chars[starts] - base)[some], (chars[ends] - base)[some], n[some], digests[0][some], digests[1][some], np.arange(some.sum()) - first


def _units(sentences: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_of(batch.column("text"))
            rest = [k for k in batch.schema.names if k != "text"]
            for i, j in pieces(offsets):
                row, *found = units_of(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], sentences)
                of = pa.array(row + i)
                columns = [pa.array(x if x.dtype != np.int64 or k in (3, 4) else x.astype(np.int32)) for k, x in enumerate(found)]
                yield pa.record_batch([*[batch.column(k).take(of) for k in rest], *columns], names=[*rest, "start", "stop", "n", "d1", "d2", "nth"])

    return run


def line_units(docs: DataFrame, *keep: str, doc_id: str = "doc_id", text: str = "text", sentences: bool = False) -> DataFrame:
    """One narrow row per unit with words: keys of the document row, `keep`, start, stop, n (words), d1, d2, nth. Materialised."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), *[F.col(k).cast("string").alias(k) for k in keep], *key_columns(doc_id, text), F.col(text).alias("text"))
    kinds = ", ".join(f"{k} {t}" for k, t in rows.dtypes if k != "text")
    return materialised(rows.mapInArrow(_units(sentences), f"{kinds}, start int, stop int, n int, d1 long, d2 long, nth int"), "line-units")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each text without its removed lines; what is left are whole lines, joined by line feeds."""
    for batch in batches:
        kept, shown, counts = [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            text, out, at = text or "", [], 0
            spans = sorted((s["start"], s["stop"]) for s in spans or [])
            for start, stop in spans:
                out.append(text[at:start])
                at = min(stop + 1, len(text))  # the line feed goes with its line
            out.append(text[at:])
            rest = "".join(out)
            if spans and spans[-1][1] >= len(text) and rest.endswith("\n"):
                rest = rest[:-1]  # the last line is gone: so is the line feed before it
            kept.append(hashlib.sha256(rest.encode()).hexdigest())
            shown.append(",".join(f"{a}-{b}" for a, b in spans))
            counts.append(len(spans))
        yield pa.record_batch([*batch.select(["doc_id", "n_lines"]).columns, pa.array(counts, pa.int64()), pa.array(shown, pa.string()), pa.array(kept, pa.string())], names=["doc_id", "n_lines", "n_removed", "removed_spans", "kept_sha256"])


def without_lines(docs: DataFrame, units: DataFrame, removed: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed, removed_spans, kept_sha256 of every document; `removed` has rows of `units`."""
    spans = removed.groupBy(*KEY).agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    totals = units.groupBy(*KEY).agg(F.countDistinct("start").alias("n_lines"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), *key_columns(doc_id, text), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.join(totals.join(spans, KEY, "left"), KEY, "left").select("doc_id", "text", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), "spans")
    return found.mapInArrow(_cut, f"doc_id {kind}, n_lines long, n_removed long, removed_spans string, kept_sha256 string")


def boilerplate(units: DataFrame, min_sites: int = MIN_SITES, site: str = "source", lg_nominal: int = LG_NOMINAL, band: float = BAND) -> DataFrame:
    """(d1, d2) of the lines that stand on at least `min_sites` sites.

    Lines with fewer occurrences than that are out by their counts. The others have one sketch each, merged over tasks and
    of bounded size however often a line occurs. An estimate within `band` of the bound, six standard errors of a sketch of
    2 ** 12 registers, is replaced by an exact distinct count. A null site is one site.
    """
    if not 6 * 1.04 / 2 ** (lg_nominal / 2) <= band:
        raise ValueError("the band must hold six standard errors of the sketch")
    often = units.groupBy("d1", "d2").agg(F.count("*").alias("times")).filter(F.col("times") >= min_sites).select("d1", "d2")
    named = F.coalesce(F.concat(F.lit("s"), F.col(site)), F.lit("z"))
    common = cut_lineage(units.join(often, ["d1", "d2"]).select("d1", "d2", named.alias("site")))
    spread = common.groupBy("d1", "d2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(lg_nominal))).alias("sites"))
    spread = cut_lineage(spread)
    sure = spread.filter(F.col("sites") > min_sites * (1 + band)).select("d1", "d2")
    close = spread.filter(F.col("sites").between(min_sites * (1 - band) - 1, min_sites * (1 + band))).select("d1", "d2")
    exact = common.join(close, ["d1", "d2"]).distinct().groupBy("d1", "d2").agg(F.count("*").alias("sites")).filter(F.col("sites") >= min_sites)
    return sure.unionByName(exact.select("d1", "d2"))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, doc_id: str = "doc_id", text: str = "text", site: str = "source") -> DataFrame:
    """Every document without the lines that stand on `min_sites` sites or more: doc_id, n_lines, n_removed, removed_spans,
    kept_sha256.

    n_lines counts lines with words; spans are "start-stop" in characters. Null text is empty and a null site is one site.
    Rows that repeat id and text give equal results. Other columns are ignored.
    """
    units = line_units(docs, site, doc_id=doc_id, text=text)
    removed = units.join(boilerplate(units, min_sites, site), ["d1", "d2"]).select(*KEY, "start", "stop")
    return without_lines(docs, units, removed, doc_id, text)


def _cut_runs(min_run: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, shown, kept = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                text, out, at, gone = text or "", [], 0, []
                group: list[dict] = []
                for unit in [*sorted(spans or [], key=lambda u: u["nth"]), None]:
                    if group and (unit is None or unit["nth"] != group[-1]["nth"] + 1):
                        if sum(u["n"] for u in group) >= min_run:
                            gone += [(u["start"], u["stop"]) for u in group]
                        group = []
                    group.append(unit)
                for start, stop in gone:
                    out.append(text[at:start])
                    at = stop
                out.append(text[at:])
                counts.append(len(gone))
                shown.append(",".join(f"{a}-{b}" for a, b in gone))
                kept.append(hashlib.sha256("".join(out).encode()).hexdigest())
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), batch.column("n_units"), pa.array(shown, pa.string()), pa.array(kept, pa.string())],
                names=["doc_id", "n_removed", "n_units", "removed_spans", "kept_sha256"],
            )

    return run


def remove_repeats(docs: DataFrame, min_run: int = MIN_RUN, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document without the passages that stand earlier in the corpus: doc_id, n_removed, n_units, removed_spans, kept_sha256.

    Units are sentences: they end at line feeds and at white space after . ! ?, and together they are the text. The order is by id,
    null last, then by text hash and place; a unit's first occurrence stays, and any other is repeated. Repeated units that
    follow one another are removed when they have `min_run` words together, so that the short sentences of a passage go with it and
    a short line that stands by itself in many documents stays. Units without words are no units and interrupt nothing; they stay.
    n_units counts units with words, n_removed the removed ones; spans are "start-stop" in characters of the original text.

    A digest's first occurrence is a grouped minimum and is joined back, so a line of very many documents is split like any skewed
    join. Rows that repeat id and text are one document and give equal results. Null text is empty; a text of any length is taken
    whole; other columns are ignored; an empty table has no rows.
    """
    units = line_units(docs, doc_id=doc_id, text=text, sentences=True)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", KEY[0], "start")
    first = units.groupBy("d1", "d2").agg(F.min(rank).alias("first"), F.count("*").alias("times")).filter("times > 1").select("d1", "d2", "first")
    first = materialised(first, "line-firsts")  # a join of two plain tables is split where a digest is hot
    repeated = units.join(first, ["d1", "d2"]).filter(rank != F.col("first"))
    spans = repeated.groupBy(*KEY).agg(F.collect_set(F.struct("nth", "n", "start", "stop")).alias("spans"))
    totals = units.groupBy(*KEY).agg((F.max("nth") + 1).alias("n_units"))
    rows = docs.select(F.col(doc_id).alias("doc_id"), *key_columns(doc_id, text), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.join(totals.join(spans, KEY, "left"), KEY, "left").select("doc_id", "text", F.coalesce("n_units", F.lit(0)).cast("long").alias("n_units"), "spans")
    return found.mapInArrow(_cut_runs(min_run), f"doc_id {kind}, n_removed long, n_units long, removed_spans string, kept_sha256 string")
