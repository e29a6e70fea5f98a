"""Event and token sequences per customer, vocabularies, padded ids, token vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.config import MAX_EVENTS
from tallyloom.functions import arrays
from tallyloom.operators import word_vectors as wv
from tallyloom.operators.prepare import code_table
from tallyloom.operators.trailing import Trailing, attach_trailing
from tallyloom.session import written


def view_level(views: Column) -> Column:
    """1 for one view, 3 for more than five, else 2."""
    return F.when(views > 5, 3).when(views == 1, 1).otherwise(2)


def training_rows(events: DataFrame, purchases: DataFrame, days: int = 60, n: int = MAX_EVENTS) -> DataFrame:
    """Per purchase: the newest n events of the days before it, oldest first, and the bought token.

    `events`: customer_id, day, token, views; `purchases`: customer_id, day, token. Events are
    kept as one array per customer and day (at most n long), so a purchase meets at most
    `days` arrays, whatever the number of its customer's events.
    """
    counts = events.groupBy("customer_id", "day", "token").agg(F.sum("views").alias("views")).where(F.col("views") > 0)
    item = F.struct("token", view_level(F.col("views")).alias("level"))
    # The last n items of a day are picked before they are collected: a robot's day is no longer than anyone's.
    place = F.row_number().over(Window.partitionBy("customer_id", "day").orderBy(F.desc(item)))
    counts = counts.withColumn("__place", place).where(F.col("__place") <= n)
    daily = counts.groupBy("customer_id", "day").agg(F.array_sort(F.collect_list(item)).alias("items"))
    daily = daily.select("customer_id", "day", F.struct("day", arrays.last_n("items", n).alias("items")).alias("items"))
    bought = purchases.select("customer_id", F.col("day").alias("bought"), F.col("token").alias("target")).distinct()
    anchors = bought.select("customer_id", "bought").distinct()
    seen = attach_trailing(anchors, daily, "customer_id", "bought", "day", {"__days": Trailing("collect", -days, -1, "items")})
    flat = F.flatten(
        F.transform(
            "__days",
            lambda d: F.transform(
                d["items"], lambda x: F.struct((F.datediff("bought", d["day"]) + 1).alias("days_diff"), x["token"].alias("token"), x["level"].alias("level"))
            ),
        )
    )
    rows = seen.select("customer_id", "bought", arrays.last_n(flat, n).alias("events")).where(F.size("events") > 0)
    return rows.join(bought, ["customer_id", "bought"])


def token_codes(rows: DataFrame, target: str, at_least: int = 10) -> DataFrame:
    """Dense codes from 1 of the targets that occur often enough; one row per label."""
    return code_table(rows, target, at_least)


def split_arrays(rows: DataFrame, codes: DataFrame, events: str = "events", target: str = "target", longer_than: int = 4) -> DataFrame:
    """Arrays of token codes, days and levels; unknown tokens are dropped, short sequences too.

    Tokens are joined to the code table one by one, so it may have any number of labels. A sequence is at most as long as
    `training_rows` made it; its row is named by the other columns.
    """
    keys = [c for c in rows.columns if c != events]
    opened = rows.join(codes.select(F.col(target).alias("__t"), F.col("code").alias("target_code")), F.col(target) == F.col("__t")).drop("__t")
    tokens = opened.select(*keys, "target_code", F.posexplode(events).alias("__pos", "__x"))
    known = tokens.join(codes.select(F.col(target).alias("__token"), "code"), F.col("__x.token") == F.col("__token"))
    item = F.struct("__pos", "code", F.col("__x.days_diff").alias("days_diff"), F.col("__x.level").alias("level"))
    kept = known.groupBy(*keys, "target_code").agg(F.array_sort(F.collect_list(item)).alias("__kept")).where(F.size("__kept") > longer_than)
    return kept.select(
        *[c for c in keys if c != target], arrays.field("__kept", "code").alias("tokens"), arrays.field("__kept", "days_diff").alias("days"),
        arrays.field("__kept", "level").alias("levels"), "target_code",
    )


def vocabulary(docs: DataFrame, words: Column, size: int) -> DataFrame:
    """Word indices by falling frequency from 1 (0 is padding), words below `size` only; ties by word."""
    counts = docs.select(F.explode(words).alias("word")).where(F.col("word") != "").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.desc("n"), "word").limit(size - 1)
    ranked = top.agg(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "word"))).alias("w"))
    return ranked.select(F.posexplode("w").alias("i", "x")).select(F.col("x.word").alias("word"), (-F.col("x.n")).alias("n"), (F.col("i") + 1).alias("index"))


def encode_pad(docs: DataFrame, key: str, words: Column, vocab: DataFrame, length: int, out: str = "ids") -> DataFrame:
    """The last `length` known words as indices, in order, left-padded to a fixed length.

    Words are numbered from the end and cut before they are collected, so a row is never longer than `length`.
    """
    tokens = docs.select(key, F.posexplode(words).alias("pos", "word"))
    known = tokens.join(vocab.select("word", "index"), "word")
    known = known.withColumn("__n", F.row_number().over(Window.partitionBy(key).orderBy(F.desc("pos")))).where(F.col("__n") <= length)
    ids = known.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "index"))).alias("__x"))
    joined = docs.select(key).join(ids, key, "left")
    values = F.coalesce(F.transform("__x", lambda x: x["index"].cast("long")), F.array().cast("array<long>"))
    return joined.select(key, arrays.pad_left(values, length).alias(out))


def document_vectors(docs: DataFrame, key: str, words: Column, size: int = 32, window: int = 5, min_count: int = 5, iterations: int = 1, seed: int = 1) -> DataFrame:
    """Mean word vector of each token sequence.

    Words are 64-bit hashes. The vocabulary and its vectors are broadcast; rows are encoded once and learnt from by many tasks.
    """
    sequence = F.coalesce(words, F.array().cast("array<string>"))
    hashed = docs.select(key, F.transform(sequence, lambda w: F.xxhash64(w)).alias("__hashes"))
    hashes, counts = wv.vocabulary_counts(hashed, min_count)
    if not len(hashes):
        return docs.select(key, F.array_repeat(F.lit(0.0), size).alias("vec"))
    rows = written(wv.encoded(hashed, key, hashes), "encoded-words")
    return wv.mean_vectors(rows, key, wv.train(rows, key, counts, size, window, iterations, seed))


def vector_grid(docs: DataFrame, key: str, words: Column, sizes: Sequence[int], windows: Sequence[int]) -> dict[tuple[int, int], DataFrame]:
    """Vectors for each size and window."""
    return {(s, w): document_vectors(docs, key, words, s, w) for s in sizes for w in windows}
