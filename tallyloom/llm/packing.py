"""Packing: documents in the order of a space-filling curve, cut into sequences of a fixed number of tokens.

Every document is tokenised once and written as a table of token ids. Its hashed vector (one dimension for each hash of a
token, weighted by frequency and rarity over all documents) is projected to four dimensions; the place of that point on a
Hilbert curve orders the documents, so neighbours in the stream are alike. The stream is cut every `limit` tokens. What is
left at its end is cut at powers of two, which need no padding, so no sequence holds padding at all.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import mix64, pieces, table_of, utf8_of
from tallyloom.operators.ranking import running_totals
from tallyloom.session import shared_folder

LIMIT = 4096
END_ID = 2
DIMENSIONS = 4
BITS = 13  # 4 x 13 bits: a curve place is exact as a double
HASHED = 1 << 16
CACHE_ENTRIES = 1 << 19

# Classes of bytes at which a text may be cut without changing its tokens. The pre-tokeniser drops white space,
# takes each digit alone, and never joins a letter with these marks; marks of contractions and special tokens are not among them.
SPACE = table_of((0x20, 0x20), (0x09, 0x0D))
DIGIT = table_of((0x30, 0x39))
LETTER = table_of((0x41, 0x5A), (0x61, 0x7A))
MARK = np.isin(np.arange(256), np.frombuffer(b'.,;:!?()"[]{}/=+*&%$#@', np.uint8))
LATIN = re.compile("[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+")
# Rule of byte-level vocabularies: a byte that prints is its own letter, the others are counted up from U+0100.
_UNSEEN = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE)]
BYTE_LETTERS = {b: 256 + k for k, b in enumerate(_UNSEEN)}


def cut_before(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Marks of the bytes before which a text may be cut, of which every row's first byte is one."""
    letter = LETTER[data]
    letter[1:] |= (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)  # U+00C0 to U+00FF
    lead = LETTER[data] | (data == 0xC3)
    space, digit, mark, plain = SPACE[data], DIGIT[data], MARK[data], data < 0x80
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[1:-1] = (space[:-1] != space[1:]) | ((digit[:-1] | digit[1:]) & plain[:-1] & plain[1:]) | (letter[:-1] & mark[1:]) | (mark[:-1] & lead[1:])
    cut[offsets] = True
    return cut


@cache
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class TokenStore:
    """Token ids of text parts seen so far in this worker; a full store is started anew."""

    def __init__(self, path: str, width: str):
        self.path, self.width = path, width
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.large_binary())
        self.flat = np.zeros(0, self.width)
        self.starts = np.zeros(1, np.int64)

    def learn(self, parts: pa.Array) -> None:
        """Tokenise parts that the store does not hold. Words of Latin letters go to the model as they are, lower-cased."""
        tokenizer = _tokenizer(self.path)
        words, rest, at = [], [], []
        for k, part in enumerate(parts.to_pylist()):
            text = part.decode()
            if LATIN.fullmatch(text):
                words.append(text)
            else:
                rest.append(text)
                at.append(k)
        tokens = tokenizer.model.tokenize
        found = iter([[t.id for t in tokens(w.lower() if w.isascii() else w.lower().encode().decode("latin-1").translate(BYTE_LETTERS))] for w in words])
        other = dict(zip(at, (e.ids for e in tokenizer.encode_batch_fast(rest, add_special_tokens=False))))
        ids = [other[k] if k in other else next(found) for k in range(len(parts))]
        self.known = pa.concat_arrays([self.known, parts])
        self.flat = np.concatenate([self.flat, np.fromiter((i for x in ids for i in x), self.width)])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum([len(x) for x in ids])])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the rows of a byte array."""
        kept = ~SPACE[data]
        first = np.flatnonzero(cut_before(data, offsets)[:-1][kept])
        if not len(first):
            return self.flat[:0], np.zeros(len(offsets), np.int64)
        body, bounds = data[kept], np.append(first, kept.sum())
        parts = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(body)]).dictionary_encode()
        if len(self.known) > CACHE_ENTRIES:
            self.clear()
        entry = pc.index_in(parts.dictionary, value_set=self.known)
        new = pc.is_null(entry)
        entry = pc.fill_null(entry, 0).to_numpy().copy()
        if new.true_count:
            entry[new.to_numpy(zero_copy_only=False)] = np.arange(new.true_count) + len(self.known)
            self.learn(parts.dictionary.filter(new))
        entry = entry[parts.indices.to_numpy()]
        sizes = self.starts[entry + 1] - self.starts[entry]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(self.starts[entry] - ends + sizes, sizes) + np.arange(ends[-1])]
        row_ends = np.concatenate([[0], np.cumsum(kept)])[offsets]
        return ids, np.concatenate([[0], ends])[np.searchsorted(first, row_ends)]


_STORES: dict[tuple[str, str], TokenStore] = {}


def _tokenise(path: str, end_id: int, width: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store = _STORES.setdefault((path, width), TokenStore(path, width))
        for batch in batches:
            data, offsets = utf8_of(batch["text"])
            for a, b in pieces(offsets, 1 << 22):
                ids, at = store.encode(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                sizes = np.diff(at) + 1
                stops = np.cumsum(sizes)
                out = np.insert(ids, at[1:], np.array(end_id, width))
                tokens = pa.Array.from_buffers(
                    pa.large_binary(), b - a, [None, pa.py_buffer(np.concatenate([[0], stops]).astype(np.int64) * out.itemsize), pa.py_buffer(out)]
                )
                yield pa.record_batch([batch["doc_id"].slice(a, b - a), batch["row"].slice(a, b - a), pa.array(sizes), tokens.cast(pa.binary())], names=["doc_id", "row", "n", "ids"])

    return run


def _ids_of(column: pa.Array, width: str) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = utf8_of(column)
    return np.frombuffer(data.tobytes(), width), offsets // np.dtype(width).itemsize


def _counted(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, times) of the different ids of each row."""
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64), np.diff(offsets))
    keys, times = np.unique(row << 32 | ids.astype(np.int64), return_counts=True)
    return keys >> 32, keys & 0xFFFFFFFF, times


def _spread(width: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents of this task that hold each id."""
        held = np.zeros(0, np.int64)
        for batch in batches:
            ids, offsets = _ids_of(batch["ids"], width)
            for a, b in pieces(offsets, 1 << 20):
                found = np.bincount(_counted(ids[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])[1])
                size = max(len(held), len(found))
                held = np.pad(held, (0, size - len(held))) + np.pad(found, (0, size - len(found)))
        used = np.flatnonzero(held)
        yield pa.record_batch([pa.array(used), pa.array(held[used])], names=["id", "n_docs"])

    return run


def axes(ids: np.ndarray) -> np.ndarray:
    """Row of the projection of each id: signs of its hashed dimension on the few axes."""
    dimension = mix64(ids.astype(np.uint64) + np.uint64(1)) % np.uint64(HASHED)
    signs = mix64(dimension[:, None] * np.uint64(DIMENSIONS) + np.arange(1, DIMENSIONS + 1, dtype=np.uint64)) >> np.uint64(63)
    return signs.astype(np.float64) * 2 - 1


def _points(rarity: np.ndarray, width: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sign = axes(np.arange(len(rarity)))
        for batch in batches:
            ids, offsets = _ids_of(batch["ids"], width)
            points = np.zeros((batch.num_rows, DIMENSIONS))
            for a, b in pieces(offsets, 1 << 20):
                row, token, times = _counted(ids[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                weight = (1 + np.log(times)) * rarity[token]
                length = np.sqrt(np.bincount(row, weight * weight, minlength=b - a))
                sums = np.stack([np.bincount(row, weight * sign[token, k], minlength=b - a) for k in range(DIMENSIONS)], axis=1)
                points[a:b] = sums / np.where(length > 0, length, 1)[:, None]
            yield pa.record_batch([batch["row"], batch["n"], *(pa.array(points[:, k]) for k in range(DIMENSIONS))], names=["row", "n", *(f"x{k}" for k in range(DIMENSIONS))])

    return run


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with whole coordinates below 2 ** bits, one row each.

    The reflections and exchanges that turn each sub-cube are undone from the coarsest bit down; then the bits of all axes,
    interleaved, are the place in Gray code.
    """
    x = [cells[:, k].astype(np.int64) for k in range(cells.shape[1])]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for k in range(len(x)):
            upper = (x[k] & bit) != 0
            swap = np.where(upper, 0, (x[0] ^ x[k]) & low)
            x[0] = np.where(upper, x[0] ^ low, x[0] ^ swap)
            x[k] = x[k] ^ swap if k else x[k]
    for k in range(1, len(x)):
        x[k] = x[k] ^ x[k - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn = np.where(x[-1] & (1 << level), turn ^ ((1 << level) - 1), turn)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | ((axis ^ turn) >> level & 1)
    return key


def _curve(middle: list[float], spread: list[float]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = np.stack([batch[f"x{k}"].to_numpy() for k in range(DIMENSIONS)], axis=1)
            share = 1 / (1 + np.exp(-1.702 * (points - middle) / spread))  # close to the normal distribution function
            cells = np.minimum((share * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            yield pa.record_batch([batch["row"], batch["n"], pa.array(hilbert_key(cells, BITS))], names=["row", "n", "curve"])

    return run


def sequence_starts(total: int, limit: int) -> tuple[int, list[int]]:
    """(number of full sequences, starts of the shorter ones at the end, whose lengths are powers of two)."""
    full, rest = divmod(total, limit)
    starts, at = [], full * limit
    while rest:
        starts.append(at)
        part = 1 << (rest.bit_length() - 1)
        at, rest = at + part, rest - part
    return full, starts


def cuts_of(at: int, n: int, limit: int, full: int, tail: list[int]) -> list[tuple[int, int, int]]:
    """(sequence, first position, last position + 1) of the parts of a stream's stretch."""
    out, stop = [], at + n
    while at < stop:
        if at < full * limit:
            number, begin = divmod(at, limit)[0], at // limit * limit
            end = begin + limit
        else:
            k = int(np.searchsorted(tail, at, side="right")) - 1
            number, end = full + k, tail[k + 1] if k + 1 < len(tail) else stop
        out.append((number, at, min(end, stop)))
        at = out[-1][2]
    return out


def _cut(total: int, limit: int, width: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full, tail = sequence_starts(total, limit)
        for batch in batches:
            ids, offsets = _ids_of(batch["ids"], width)
            wide = ids.astype("<u4")
            owner, found = [], []
            for i, (at, n) in enumerate(zip(batch["at"].to_pylist(), batch["n"].to_pylist())):
                for number, a, b in cuts_of(at, n, limit, full, tail):
                    begin = number * limit if number < full else tail[number - full]
                    owner.append(i)
                    found.append((a - at, b - a, number, a - begin))
            start, length, number, place = (np.array(x, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
            first = offsets[np.array(owner, np.int64)] + start
            body = [wide[a : a + k].tobytes() for a, k in zip(first, length)]
            picked = lambda name: batch[name].take(pa.array(owner, pa.int64()))
            yield pa.record_batch(
                [picked("doc_id"), pa.array(start), pa.array(length), pa.array(body, pa.binary()), picked("n"), pa.array(number), pa.array(place), picked("curve")],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "curve"],
            )

    return run


def pack_documents(docs: DataFrame, vocabulary: str, limit: int = LIMIT, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces of packed sequences: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset,
    curve (the document's place on the curve).

    `vocabulary` is the path of a tokenizers file that every executor can read. A document is its token ids and then `end_id`,
    so a null or empty text is that one id; a text of any length is cut into as many pieces as it needs. Sequences hold `limit`
    tokens; at the end of the stream come shorter ones whose lengths are powers of two. Every row is packed by itself: equal
    texts lie next to each other, repeated rows are packed as often as they come. Documents at one place of the curve follow the
    order in which they were read. Other columns are ignored; an empty table has no pieces.

    Token ids are written once to the session's shared folder. The driver sees one number for each token of the vocabulary
    (documents that hold it), the moments of four axes and the cuts of the curve.
    """
    spark = docs.sparkSession
    size = _tokenizer(vocabulary).get_vocab_size()
    width = "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"
    kind = docs.schema[doc_id].dataType.simpleString()
    folder = shared_folder(spark, "packing-tokens")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text).cast("string").alias("text"))
    rows.mapInArrow(_tokenise(vocabulary, end_id, width), f"doc_id {kind}, row long, n long, ids binary").write.parquet(folder)
    tokens = spark.read.parquet(folder)
    n_docs = tokens.count()
    # one row for each entry of the vocabulary at most
    held = tokens.select("ids").mapInArrow(_spread(width), "id long, n_docs long").groupBy("id").agg(F.sum("n_docs").alias("n_docs")).toPandas()
    rarity = np.zeros(max(size, end_id + 1))
    rarity[held["id"].to_numpy(np.int64)] = np.log1p(n_docs / held["n_docs"].to_numpy(np.float64))
    names = [f"x{k}" for k in range(DIMENSIONS)]
    points_folder = shared_folder(spark, "packing-points")
    tokens.select("row", "n", "ids").mapInArrow(_points(rarity, width), "row long, n long, " + ", ".join(f"{x} double" for x in names)).write.parquet(points_folder)
    points = spark.read.parquet(points_folder)
    moments = points.agg(F.sum("n").alias("n"), *[F.avg(x).alias(f"m_{x}") for x in names], *[F.stddev_pop(x).alias(f"s_{x}") for x in names]).first()
    total = moments["n"] or 0
    middle = [moments[f"m_{x}"] or 0.0 for x in names]
    spread = [s if (s := moments[f"s_{x}"]) and math.isfinite(s) and s > 1e-12 else 1.0 for x in names]
    keyed = points.mapInArrow(_curve(middle, spread), "row long, n long, curve long")
    placed = running_totals(keyed, "curve", "row", {"upto": F.col("n")}, rank="place").select("row", "curve", (F.col("upto") - F.col("n")).alias("at"))
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, curve long"
    return tokens.join(placed, "row").select("doc_id", "n", "ids", "at", "curve").mapInArrow(_cut(total, limit, width), schema)
