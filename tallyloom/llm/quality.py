"""Quality classifier by nearest-neighbour voting.

Texts become weighted counts of shape terms: pairs of character classes, words that repeat a word a few places back and
the share of words seen before. A singular value decomposition of a bounded labelled sample gives latent-semantic
vectors; the labelled ones are broadcast. Each document is compared with all of them, block by block, and its nearest
neighbours vote with weights that grow with their cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.batches import NOT_SPACE, Prefix, pieces, utf8_of, word_bounds
from tallyloom.llm.common import free_names

SAMPLE_ROWS = 4096
DIMENSIONS = 48
NEIGHBOURS = 25
SHARPNESS = 8
CLASSES = 24
LAGS = 8
BLOCK = 512
THRESHOLD = 0.3


def _byte_classes() -> np.ndarray:
    """Letters, digits, spaces and line ends have one class each, other characters share the rest by code."""
    code = 8 + np.arange(256) % (CLASSES - 8)
    for low, high, kind in ((97, 122, 0), (65, 90, 1), (48, 57, 2), (32, 32, 3), (10, 10, 4), (128, 255, 5), (46, 46, 6), (44, 44, 7)):
        code[low : high + 1] = kind
    return code.astype(np.int64)


BYTE_CLASSES = _byte_classes()
TERMS = CLASSES * CLASSES + LAGS + 1


def shape_terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of relative term counts, one row of TERMS values per text; zeros for an empty text."""
    rows, sizes = len(offsets) - 1, np.diff(offsets)
    of = np.repeat(np.arange(rows), sizes)
    classes = BYTE_CLASSES[data]
    same = of[1:] == of[:-1]
    codes = of[1:] * (CLASSES * CLASSES) + classes[:-1] * CLASSES + classes[1:]
    pairs = np.bincount(codes[same], minlength=rows * CLASSES * CLASSES).reshape(rows, -1)
    out = np.zeros((rows, TERMS), dtype=np.float32)
    out[:, : CLASSES * CLASSES] = pairs / np.maximum(sizes - 1, 1)[:, None]

    starts, stops, row = word_bounds(data, offsets, NOT_SPACE)
    if len(starts):
        words = Prefix(data).of(starts, stops)
        n = np.maximum(np.bincount(row, minlength=rows), 1)
        for lag in range(1, LAGS + 1):
            again = (words[lag:] == words[:-lag]) & (row[lag:] == row[:-lag])
            out[:, CLASSES * CLASSES + lag - 1] = np.bincount(row[lag:][again], minlength=rows) / n
        order = np.lexsort((words, row))
        seen = (words[order][1:] == words[order][:-1]) & (row[order][1:] == row[order][:-1])
        out[:, -1] = np.bincount(row[order][1:][seen], minlength=rows) / n
    return np.sqrt(out)


@dataclass
class Model:
    """Term weights, projection, labelled vectors (unit length) and their labels; `base` is the share of label 1."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    base: float

    def project(self, terms: np.ndarray) -> np.ndarray:
        latent = (terms * self.weights) @ self.axes
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def score(self, terms: np.ndarray) -> np.ndarray:
        """Weighted vote of the nearest labelled vectors; what has no likeness to any gets the base share."""
        if not len(self.labels):
            return np.full(len(terms), self.base)
        out = np.empty(len(terms))
        latent, k = self.project(terms), min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(terms), BLOCK):
            close = latent[at : at + BLOCK] @ self.vectors.T
            best = np.argpartition(-close, k - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(close, best, axis=1), 0.0).astype(np.float64) ** SHARPNESS
            out[at : at + BLOCK] = ((votes * self.labels[best]).sum(axis=1) + 1e-3 * self.base) / (votes.sum(axis=1) + 1e-3)
        return np.clip(out, 0.0, 1.0)


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8_of(batch.column("text"))
        for i, j in pieces(offsets):
            terms = shape_terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            yield pa.record_batch([batch.column("label")[i:j], pa.array([t.tobytes() for t in terms], pa.binary())], names=["label", "terms"])


def held_out(doc_id: str = "doc_id", parts: int = 5) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_ROWS, label: str = "quality", doc_id: str = "doc_id", text: str = "text") -> Model:
    """Model from at most `sample` labelled documents that are not held out, those with the smallest hash of the id.

    Several labels of an id count by majority, ties as 1; several texts of an id give the first in order. Without any
    labelled document every score is 0.5.
    """
    named = labels.filter(F.col(doc_id).isNotNull() & F.col(label).isNotNull() & ~held_out(doc_id))
    chosen = (
        named.groupBy(F.col(doc_id).alias("doc_id")).agg((F.avg(F.col(label)) >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    )
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # at most `sample` narrow rows are broadcast
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    got = rows.select("text", "label").mapInArrow(_terms_of, "label int, terms binary").collect()
    if not got:
        empty = np.zeros((0, DIMENSIONS), np.float32)
        return Model(np.ones(TERMS, np.float32), np.zeros((TERMS, DIMENSIONS), np.float32), empty, np.zeros(0), 0.5)
    got.sort(key=lambda r: (bytes(r[1]), r[0]))
    terms = np.stack([np.frombuffer(r[1], np.float32) for r in got])
    truth = np.array([r[0] for r in got], dtype=np.float64)
    weights = (0.1 + np.log((1 + len(terms)) / (1 + (terms > 0).sum(axis=0)))).astype(np.float32)
    weights[CLASSES * CLASSES :] = 1.0
    weighted = (terms * weights).astype(np.float64)
    values, axes = np.linalg.eigh(weighted.T @ weighted)
    model = Model(weights, axes[:, np.argsort(-values)[:DIMENSIONS]].astype(np.float32), np.zeros(0), truth, float(truth.mean()))
    model.vectors = model.project(terms).astype(np.float32)
    return model


def with_score(docs: DataFrame, model: Model, name: str = "score", text: str = "text") -> DataFrame:
    """The documents with a column `name`, the score of the whole text (null text: as empty). One pass, no shuffle."""
    if name in docs.columns:
        raise ValueError(f"the documents have a column {name} already")
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))  # plain arrays, at most SAMPLE_ROWS vectors

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Model(**sent.value)
        for batch in batches:
            data, offsets = utf8_of(batch.column(text))
            for i, j in pieces(offsets):
                score = voters.score(shape_terms(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
                yield pa.record_batch([*batch.slice(i, j - i).columns, pa.array(score, pa.float64())], names=[*batch.schema.names, name])

    return docs.mapInArrow(scored, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def score_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row; a null id is not held out; an empty table gives no rows."""
    model = train(docs, labels, doc_id=doc_id, text=text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), held_out(doc_id).alias("held_out"))
    return with_score(rows, model).select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents whose score reaches THRESHOLD, with the input's columns, whatever their names. Texts are scored whole, null as
    empty; repeated rows all stay or all go; an empty table gives no rows."""
    model = train(docs, labels, doc_id=doc_id, text=text)
    name = free_names(docs, "__score")[0]
    return with_score(docs, model, name, text).filter(F.col(name) >= THRESHOLD).drop(name)
