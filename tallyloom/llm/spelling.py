"""Spelling variants: words one edit apart, found by pivotal bigrams, and the common form that each rare word stands for.

Bigrams are ordered by how many words hold them, rare ones first. A word's prefix is its first three bigrams in that order
(with those that tie with the third), and its pivots are two of the first three that do not overlap, chosen by dynamic
programming for the fewest words. One edit leaves one pivot as it is: an edit right of the first pivot's end leaves everything
up to that end, any other edit leaves everything from the second pivot on. So of two words one edit apart, the one whose third
bigram is the rarer has a pivot that the other holds in its prefix, at the same distance from the start or from the end and
with the same letters on that side. Those letters are the key of the join, the position limit of the method at its tightest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.batches import Prefix, mix64, pieces
from tallyloom.llm.common import ascii_lower
from tallyloom.session import cut_lineage, shared_folder

MIN_LENGTH = 7
MIN_COUNT = 2
TIMES = 10
PREFIX = 3  # grams of two letters, one edit: 2 x 1 + 1
#: Letters of a word, and one occurrence in so many loses a letter.
LETTERS = "[A-Za-z\\u00C0-\\u00FF]"
ONE_IN = 31


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words of all texts after the planted deletions; runs too short to give a word are not taken out of the text."""
    runs = F.regexp_extract_all(F.col(text), F.lit(f"({LETTERS}{{{min_length},}})"), F.lit(1))
    rows = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", ascii_lower(F.col("run")).alias("run"))
    rows = rows.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.char_length("run")))
    words = rows.select(F.when(F.col("h") % ONE_IN == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.filter(F.char_length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(letters, offsets): one byte for each letter, as all are below U+0100."""
    words = [w.encode("latin-1") for w in column.to_pylist()]
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])
    return np.frombuffer(b"".join(words), np.uint8), offsets


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, start, bigram) of all bigrams; a bigram is one number below 65,536."""
    sizes = np.maximum(np.diff(offsets) - 1, 0)
    word = np.repeat(np.arange(len(sizes)), sizes)
    start = np.arange(len(word)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + offsets[word]
    return word, start, data[start].astype(np.int64) << 8 | data[start + 1]


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = np.zeros(1 << 16, np.int64)
    for batch in batches:
        word, _, gram = _grams(*_letters(batch["word"]))
        held += np.bincount(np.unique(word << 16 | gram) & 0xFFFF, minlength=1 << 16)
    used = np.flatnonzero(held)
    yield pa.record_batch([pa.array(used), pa.array(held[used])], names=["gram", "n_words"])


def choose_pivots(starts: np.ndarray, costs: np.ndarray, width: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """The two grams of least total cost that do not overlap, one row for each word.

    `starts` and `costs` list the grams of a prefix in order of place. After each gram, `one` is the cheapest choice of one
    gram among those that end before the next, and `two` the cheapest choice of two.
    """
    rows, n = np.arange(len(starts)), starts.shape[1]
    two, first, second = np.full(len(starts), np.inf), np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    for k in range(1, n):
        apart = starts[:, :k] + width <= starts[:, k : k + 1]
        options = np.where(apart, costs[:, :k], np.inf)
        one = options.argmin(axis=1)
        total = options[rows, one] + costs[:, k]
        better = total < two
        two, first, second = np.where(better, total, two), np.where(better, one, first), np.where(better, k, second)
    return first, second


def _marks(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64 bits of each word: one edit changes two of them at most."""
    word = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    key = np.sort(word << 8 | data)
    first = np.r_[True, key[1:] != key[:-1]]
    nth = np.arange(len(key)) - np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
    bit = mix64((key & 0xFF).astype(np.uint64) << np.uint64(32) | nth.astype(np.uint64)) & np.uint64(63)
    return np.bitwise_xor.reduceat(np.uint64(1) << bit, offsets[:-1])


def _keys(n_words: np.ndarray, rank: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keys of words: for a pivot, the letters on the side that an edit leaves; for each gram of a prefix, those on either side."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _letters(batch["word"])
            for a, b in pieces(offsets, 1 << 18):
                yield part(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], batch["wid"].to_numpy()[a:b])

    def part(data: np.ndarray, offsets: np.ndarray, wid: np.ndarray) -> pa.RecordBatch:
        word, start, gram = _grams(data, offsets)
        order = np.lexsort((start, rank[gram], word))
        head = np.searchsorted(word, np.arange(len(wid)))[:, None] + np.arange(PREFIX)
        chosen = np.sort(order[head], axis=1)  # the rarest grams in order of place
        last = rank[gram[order[head[:, -1]]]]
        one, two = choose_pivots(start[chosen], n_words[gram[chosen]].astype(np.float64))
        rows = np.arange(len(wid))
        left, right = start[chosen[rows, one]], start[chosen[rows, two]]
        held = np.flatnonzero(rank[gram] <= last[word])
        owner = np.concatenate([rows, rows, word[held], word[held]])
        begins, ends = offsets[:-1], offsets[1:]
        hashes = Prefix(data)
        before, after = np.uint64(1), np.uint64(2)
        key = np.concatenate(
            [
                mix64(hashes.of(begins, left + 2) + before),
                mix64(hashes.of(right, ends) + after),
                mix64(hashes.of(begins[word[held]], start[held] + 2) + before),
                mix64(hashes.of(start[held], ends[word[held]]) + after),
            ]
        ).view(np.int64)
        pivot = np.arange(len(owner)) < 2 * len(rows)
        marks, sizes = _marks(data, offsets).view(np.int64), np.diff(offsets)
        columns = [wid[owner], key, pivot, last[owner].astype(np.int32), sizes[owner].astype(np.int32), marks[owner]]
        return pa.record_batch([pa.array(c) for c in columns], names=["wid", "key", "pivot", "last", "size", "marks"])

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b, word_a, n_a, word_b, n_b): every pair of different words one edit apart, once. `words` has wid, word and n, and is
    read several times. Words have `MIN_LENGTH` letters below U+0100 or more.

    The driver sees one number for each of at most 90 x 90 bigrams. Keys and marks only propose pairs; letters decide.
    """
    # the letters are 90 code points, so this has 8,100 rows at most
    held = words.select("word").mapInArrow(_gram_counts, "gram long, n_words long").groupBy("gram").agg(F.sum("n_words").alias("n_words")).toPandas()
    n_words = np.zeros(1 << 16, np.int64)
    n_words[held["gram"].to_numpy(np.int64)] = held["n_words"].to_numpy(np.int64)
    rank = np.empty(1 << 16, np.int64)
    rank[np.lexsort((np.arange(1 << 16), n_words))] = np.arange(1 << 16)
    folder = shared_folder(words.sparkSession, "spelling-keys")
    words.select("wid", "word").mapInArrow(_keys(n_words, rank), "wid long, key long, pivot boolean, last int, size int, marks long").write.parquet(folder)
    keys = words.sparkSession.read.parquet(folder)
    s, r = keys.filter("pivot").alias("s"), keys.filter("NOT pivot").alias("r")
    close: Column = (
        (F.col("s.key") == F.col("r.key")) & (F.col("s.wid") != F.col("r.wid")) & (F.col("s.last") <= F.col("r.last"))
        & (F.abs(F.col("s.size") - F.col("r.size")) <= 1) & (F.bit_count(F.col("s.marks").bitwiseXOR(F.col("r.marks"))) <= 2)
    )
    pairs = s.join(r, close).select(F.least("s.wid", "r.wid").alias("a"), F.greatest("s.wid", "r.wid").alias("b")).distinct()
    one = words.select(F.col("wid").alias("a"), F.col("word").alias("word_a"), F.col("n").alias("n_a"))
    two = words.select(F.col("wid").alias("b"), F.col("word").alias("word_b"), F.col("n").alias("n_b"))
    return pairs.join(one, "a").join(two, "b").filter(F.levenshtein("word_a", "word_b", 1) == 1)


def roots_of(forms: DataFrame, links: int) -> DataFrame:
    """(word, root): the last word of each chain of `forms` (word, form), of at most `links` links.

    Every round doubles the length that is followed.
    """
    ways = forms.select("word", F.col("form").alias("root"))
    followed = 1
    while followed < links:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways = cut_lineage(ways.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root")))
        followed *= 2
    return ways


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, times: int = TIMES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Words of all texts with word, form, root, n, n_near, form_n.

    A word is a run of Latin letters (A-Z lower-cased; runs whose checksum with the id is divisible by 31 lose one letter) of
    `min_length` (4 at least) letters or more that occurs `min_count` times or more. Its form is the commonest word one edit away, the first in
    code-point order of equally common ones, if that is `times` (2 at least) times as common or more. A null id counts as the empty string. Null and
    empty texts have no words, repeated rows count as often as they come, texts and words of any length are taken whole, other
    columns are ignored, and an empty table has no words.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark, "spelling-words")
    counted = word_counts(docs, min_length, min_count, doc_id, text)
    counted.select(F.monotonically_increasing_id().alias("wid"), "word", "n").write.parquet(folder)
    words = spark.read.parquet(folder)
    pairs = near_pairs(words)
    ends = F.array(F.struct(F.col("a").alias("wid"), F.col("word_b").alias("word"), F.col("n_b").alias("n")), F.struct(F.col("b").alias("wid"), F.col("word_a").alias("word"), F.col("n_a").alias("n")))
    near = pairs.select(F.inline(ends)).groupBy("wid").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "word")).alias("best"))
    best_n = -F.col("best.less")
    common = best_n >= F.col("n") * times
    rows = words.join(near, "wid", "left").select(
        "word", F.when(common, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(common, best_n).alias("form_n")
    )
    rows = cut_lineage(rows)
    most, links = words.agg(F.max("n")).first()[0] or 0, 0
    while min_count * times**links <= most:
        links += 1
    roots = roots_of(rows.filter("form IS NOT NULL").select("word", "form"), links)
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
