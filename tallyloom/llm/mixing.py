"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents, in a hashed order, form one stream of words that is cut into a fixed number of equal parts, its blocks.
A source has as many slots as its target holds blocks. The points of the slots are multiples of the golden ratio, in whole
numbers: k * F(n - 1) mod F(n) for Fibonacci numbers, which takes every value once, so every source holds as many points as it
has slots, spread evenly over the mix. Its slots, ranked by k, take its blocks in turn. Native DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import KEY, SPACE_WORD, free_names, joined_by_key, key_columns
from tallyloom.session import cut_lineage

CELLS = 1024
CHUNK = 4096
BUCKET_DIGITS = 3
PARTS = 4096


def source_targets(sizes: DataFrame, cap: int = 3, weights: int = 3) -> DataFrame:
    """Targets of the sources, from (skey, source, source_size) with one row per source.

    Sources in code point order, null last, weigh 1, 2, ..., `weights`, repeating. All targets add up to all sizes; none is
    above `cap` times its source's size. With sources in order of cap / weight, the level is the first at which the next
    source is not above its cap; a target is weight times level, or the cap. The windows see one row per source.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.select(
        "*", (((F.row_number().over(by_name) - 1) % weights) + 1).cast("long").alias("weight"), (F.col("source_size") * cap).alias("most"), F.sum("source_size").over(everything).alias("total")
    )
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "skey")
    levels = ranked.select(
        "*",
        F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("full"),
        F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)).alias("rest"),
    ).withColumn("level", (F.col("total") - F.col("full")).cast("double") / F.col("rest").cast("double"))
    fits = F.col("level") * F.col("weight") <= F.col("most")
    chosen = levels.withColumn("level", F.min(F.when(fits, F.struct(F.col("most") / F.col("weight"), "skey", "level"))).over(everything)["level"])
    share = F.least(F.col("level") * F.col("weight"), F.col("most").cast("double"))
    return chosen.withColumn("target", share).select("skey", "source", "source_size", "weight", "total", "target")


def streams(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One narrow row per document: doc_id, source, skey, size, keys of the row and its place in its source's stream.

    (skey, bucket, place) names the row: `bucket` is the head of the id's md5, `place` the order inside the bucket and
    `inside` the words ahead of it there, so one source never lies in one task. Materialised.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(SPACE_WORD)), F.lit(0)).cast("long")
    order = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("z")).alias("skey"),
        size.alias("size"), order.alias("order"), *key_columns(doc_id, text),
    )
    rows = rows.withColumn("bucket", F.substring("order", 1, BUCKET_DIGITS))
    here = Window.partitionBy("skey", "bucket").orderBy("order", *KEY)
    return cut_lineage(
        rows.select("*", F.row_number().over(here).alias("place"), F.coalesce(F.sum("size").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("inside")).drop("order")
    )


def fibonacci(least: int) -> tuple[int, int]:
    """Neighbouring Fibonacci numbers, the larger one `least` or more."""
    a, b = 1, 1
    while b < least:
        a, b = b, a + b
    return a, b


def slot_counts(targets: DataFrame, cap: int, parts: int) -> DataFrame:
    """`targets` with blocks (parts of the stream, of a word at least), slots (target in blocks, rounded) and the first point `lo`."""
    blocks = F.least("source_size", F.lit(parts))
    slots = F.least(F.round(F.col("target") * blocks / F.col("source_size")).cast("long"), blocks * cap)
    counted = targets.withColumn("blocks", blocks).withColumn("slots", F.when(F.col("source_size") > 0, slots).otherwise(0))
    return counted.withColumn("lo", F.sum("slots").over(Window.orderBy("skey").rowsBetween(Window.unboundedPreceding, 0)) - F.col("slots"))


def schedule(targets: DataFrame) -> DataFrame:
    """Slots of the mix and the rank of each in its source: (k, skey, rank from 0), from (skey, slots, lo).

    Points meet the sources cell by cell, an equality join. Ranks are counted per chunk of slots and then summed over the
    chunks, so that a source with most slots is ranked by many tasks.
    """
    spark = targets.sparkSession
    total = targets.agg(F.sum("slots")).head()[0] or 0
    step, size = fibonacci(total)
    if size >= 1 << 31:
        raise ValueError("too many slots for points in 64 bits: take fewer parts")
    width = -(-size // CELLS)
    points = spark.range(size).select(F.col("id").alias("k"), (F.col("id") * step % size).alias("point")).filter(F.col("point") < total)
    points = points.withColumn("cell", F.expr(f"point div {width}"))
    ends = [F.expr(f"lo div {width}"), F.expr(f"(lo + slots - 1) div {width}")]
    spans = targets.filter("slots > 0").select("skey", "lo", "slots", F.explode(F.sequence(*ends)).alias("cell"))
    drawn = points.join(spans, "cell").filter("point >= lo and point < lo + slots").select("k", "skey", F.floor(F.col("k") / CHUNK).alias("chunk"))
    counts = drawn.groupBy("skey", "chunk").agg(F.count("*").alias("n"))
    ahead = counts.select("skey", "chunk", F.coalesce(F.sum("n").over(Window.partitionBy("skey").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    nth = F.row_number().over(Window.partitionBy("skey", "chunk").orderBy("k"))
    return drawn.withColumn("nth", nth).join(ahead, ["skey", "chunk"]).select("k", "skey", (F.col("ahead") + F.col("nth") - 1).alias("rank"))


def placed_rows(rows: DataFrame) -> DataFrame:
    """(skey, bucket, place, size, at) of the rows of `streams` with words; `at` counts the words ahead in the source's stream."""
    heads = rows.groupBy("skey", "bucket").agg(F.sum("size").alias("words"))
    heads = heads.select("skey", "bucket", F.coalesce(F.sum("words").over(Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    return rows.filter("size > 0").join(heads, ["skey", "bucket"]).select("skey", "bucket", "place", "size", (F.col("ahead") + F.col("inside")).alias("at"))


def mix_rows(docs: DataFrame, cap: int = 3, parts: int = PARTS, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """`streams` with source_size, target and taken: the words that the mix takes of each row, repeats counted.

    Every source is cut into `parts` blocks of equal length (to a word; a source of fewer words into single words), so its taken
    words are its target to half a block, whatever its size beside the others. A block is drawn at most `cap` times, hence no
    row gives more than `cap` times its size. Rows without words give nothing.
    """
    rows = streams(docs, doc_id, text, source)
    sizes = rows.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    targets = cut_lineage(slot_counts(source_targets(sizes, cap), cap, parts))
    blocks = targets.select("skey", "source_size", "blocks")
    drawn = schedule(targets).join(blocks, "skey").groupBy("skey", (F.col("rank") % F.col("blocks")).alias("block")).agg(F.count("*").alias("uses"))
    placed = placed_rows(rows).join(blocks, "skey")
    # word w lies in block ((w + 1) * blocks - 1) div source_size; block b begins at word b * source_size div blocks
    reach = F.sequence(F.expr("((at + 1) * blocks - 1) div source_size"), F.expr("((at + size) * blocks - 1) div source_size"))
    pieces = placed.select("*", F.explode(reach).alias("block"))
    overlap = F.least(F.col("at") + F.col("size"), F.expr("(block + 1) * source_size div blocks")) - F.greatest("at", F.expr("block * source_size div blocks"))
    pieces = pieces.select("skey", "bucket", "place", "block", overlap.alias("overlap"))
    taken = pieces.join(drawn, ["skey", "block"]).groupBy("skey", "bucket", "place").agg(F.sum(F.col("overlap") * F.col("uses")).alias("taken"))
    return (
        rows.join(targets.select("skey", "source_size", F.coalesce("target", F.lit(0.0)).alias("target")), "skey")
        .join(taken, ["skey", "bucket", "place"], "left")
        .withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))
    )


def mix_documents(docs: DataFrame, cap: int = 3, parts: int = PARTS, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, source, size, source_size, target, taken of every document; see `mix_rows`.

    Null text has size 0; a null source is a source of its own, last in order; repeated rows count one by one; an empty
    table gives no rows; texts of any length are counted whole; other columns are ignored. Reruns agree: order and points depend
    on the rows alone.
    """
    return mix_rows(docs, cap, parts, doc_id, text, source).select("doc_id", "source", "size", "source_size", "target", "taken")


def mixed_corpus(docs: DataFrame, cap: int = 3, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents as the mix repeats them, with the input's columns.

    A document comes as often as its words that the schedule takes hold it (see `mix_rows`), rounded to the nearest count: 0 to
    `cap` times. Repeated rows share what their copies take. A document without words has no weight in the mix and stays once.
    """
    per = mix_rows(docs, cap, PARTS, doc_id, text, source).groupBy(*KEY).agg(F.sum("taken").alias("__taken"), F.sum("size").alias("__size"))
    times = F.when(F.col("__size") > 0, F.floor(F.col("__taken") / F.col("__size") + 0.5)).otherwise(1).cast("int")
    times_name, copy_name = free_names(docs, "__times", "__copy")
    counts = per.select(*KEY, times.alias(times_name)).filter(F.col(times_name) > 0)
    found, names = joined_by_key(docs, counts, "inner", doc_id, text)
    copies = F.explode(F.sequence(F.lit(1), F.col(times_name)))
    return found.select("*", copies.alias(copy_name)).drop(times_name, copy_name, *names)
