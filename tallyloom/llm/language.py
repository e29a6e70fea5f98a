"""Language identification by cross-parsing entropy.

A suffix automaton of labelled text per language accepts exactly the substrings of that text. A document is cut, from left
to right, into the longest phrases that a language's automaton accepts; phrases times the bits of naming a place in the
training text, over the length, is the cross entropy. The language with the lowest one wins.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import pieces, utf8_of

TRAIN_BYTES = 24_576
TRAIN_ROWS = 96
ROW_BYTES = 2_048
PIECE = 256
CHUNK = 2_048
CLASSES = 64
PAD, BREAK, OTHER = CLASSES - 1, 0, 27
UNKNOWN = "und"


def symbol_classes(texts: list[bytes]) -> np.ndarray:
    """Class of every byte: letters without case, one class for all other ASCII, the commonest further bytes, the rest."""
    table = np.full(256, BREAK, dtype=np.uint8)
    table[97:123] = table[65:91] = np.arange(1, 27)
    table[128:] = OTHER
    counts = Counter(b for text in texts for b in text if b >= 128)
    for i, (byte, _) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: PAD - OTHER - 1]):
        table[byte] = OTHER + 1 + i
    return table


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts the substrings of `symbols`; state 0 is the start."""
    step, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        new, p = len(step), last
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step


@dataclass
class Model:
    """`moves[state * CLASSES + class]` is twice the next state, plus one where a phrase ends; `starts` has each language's
    first state and `bits` the cost of a phrase."""

    languages: list[str]
    classes: np.ndarray
    moves: np.ndarray
    starts: np.ndarray
    bits: np.ndarray

    def phrases(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases of each text in each language: (languages, texts). Long texts are parsed in chunks, side by side."""
        rows = len(offsets) - 1
        sizes = np.diff(offsets)
        parts = -(-sizes // CHUNK)
        row = np.repeat(np.arange(rows), parts)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        begin = offsets[row] + nth * CHUNK
        length = np.minimum(CHUNK, offsets[row + 1] - begin)
        order = np.argsort(-length, kind="stable")
        begin, length, row = begin[order], length[order], row[order]
        symbols = self.classes[data].astype(np.int64)
        counts = np.zeros((len(self.languages), len(row)), dtype=np.int64)
        state = np.repeat(self.starts[:, None], len(row), axis=1)
        active = np.searchsorted(-length, -np.arange(int(length.max(initial=0))), side="left")
        for t, n in enumerate(active):
            move = self.moves[state[:, :n] * CLASSES + symbols[begin[:n] + t]]
            counts[:, :n] += move & 1
            state[:, :n] = move >> 1
        out = np.zeros((len(self.languages), rows), dtype=np.int64)
        for k in range(len(self.languages)):
            out[k] = np.bincount(row, weights=counts[k], minlength=rows).astype(np.int64)
        return out + parts  # the last phrase of each chunk

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the best language, its share of confidence) of each text."""
        entropy = self.phrases(data, offsets) * self.bits[:, None] / np.maximum(np.diff(offsets), 1)
        best = entropy.argmin(axis=0)
        share = np.exp2(entropy.min(axis=0) - entropy).sum(axis=0)
        return best, 1.0 / share


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, train_bytes: int = TRAIN_BYTES, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Automata from at most `train_bytes` of text per language, of about TRAIN_ROWS labelled rows that are not held out.

    Rows are drawn by a hash of the id with the chance TRAIN_ROWS / rows of the language and give at most ROW_BYTES
    characters each, from a place that a hash of the id draws, so that common openings do not stand for the texts. The bytes are
    filled by turns, PIECE characters of every row before any gives more. Languages are few. None without labelled text.
    """
    rows = docs.filter(F.col(doc_id).isNotNull() & F.col(lang).isNotNull() & (F.length(text) > 0) & ~held_out(doc_id))
    counts = rows.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n"))
    draw = F.pmod(F.xxhash64(F.col(doc_id), F.lit("draw")), F.lit(1_000_000)) / 1e6
    place = F.pmod(F.xxhash64(F.col(doc_id), F.lit("place")), F.greatest(F.length(text) - ROW_BYTES, F.lit(0)) + 1) + 1
    picked = (
        rows.select(F.col(lang).alias("lang"), draw.alias("draw"), F.substring(F.col(text), place.cast("int"), F.lit(ROW_BYTES)).alias("text"))
        .join(counts, "lang")
        .filter(F.col("draw") < F.lit(float(TRAIN_ROWS)) / F.col("n"))
        .select("lang", "draw", "text")
        .collect()
    )
    samples: dict[str, bytes] = {}
    turns = [(r[0], at, r[1], r[2][at : at + PIECE]) for r in picked for at in range(0, len(r[2]), PIECE)]
    for name, _, _, part in sorted(turns):
        samples[name] = (samples.get(name, b"") + b" " + part.encode())[:train_bytes]
    if not samples:
        return None
    languages = sorted(samples)
    classes = symbol_classes([samples[k] for k in languages])
    tables, starts, bits, at = [], [], [], 0
    for k in languages:
        automaton = suffix_automaton(classes[np.frombuffer(samples[k], np.uint8)].tolist())
        table = np.zeros((len(automaton), CLASSES), dtype=np.int64)
        first = np.full(CLASSES, 2 * at + 1, dtype=np.int64)  # no such symbol: it is a phrase of its own
        for c, s in automaton[0].items():
            first[c] = 2 * (at + s) + 1
        table[:] = first
        for s, moves in enumerate(automaton):
            for c, target in moves.items():
                table[s, c] = 2 * (at + target)
        tables.append(table)
        starts.append(at)
        bits.append(np.log2(len(samples[k]) + 1))
        at += len(automaton)
    return Model(languages, classes, np.concatenate(tables).reshape(-1).astype(np.int32), np.array(starts, np.int64), np.array(bits))


def identify(docs: DataFrame, train_bytes: int = TRAIN_BYTES, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row: one pass over the texts, no shuffle.

    A null text, one without a letter, or any text where no row is labelled has `und` and score 0. Ties go to the first
    language by name. The label of a row is never looked at for its prediction; other columns are ignored.
    """
    model = train(docs, train_bytes, doc_id, text, lang)
    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), letters.alias("letters"), F.col(text).alias("text"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain arrays, at most 2 * TRAIN_BYTES * CLASSES numbers per language

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = Model(**sent.value)
        names = np.array([*automata.languages, UNKNOWN], dtype=object)
        for batch in batches:
            data, offsets = utf8_of(batch.column("text"))
            for i, j in pieces(offsets):
                best, share = automata.predict(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                known = batch.column("letters")[i:j].to_numpy(zero_copy_only=False)
                found = pa.array(names[np.where(known, best, -1)], pa.string())
                yield pa.record_batch([*batch.slice(i, j - i).select(["doc_id", "held_out"]).columns, found, pa.array(np.where(known, share, 0.0))], names=["doc_id", "held_out", "lang_pred", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predicted, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
