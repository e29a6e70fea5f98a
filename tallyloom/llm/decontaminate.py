"""Benchmark decontamination by winnowing.

A text's k-gram hashes are cut down to the smallest of every sliding window of `guarantee - k + 1` of them, so two texts
that share `guarantee` words share a kept hash. Documents whose kept hashes meet the benchmark's are candidates; their
hits are then extended to the exact words covered by benchmark windows. Native DataFrame operations only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import KEY, ascii_lower, joined_by_key, key_columns, small_or_shuffled
from tallyloom.session import cut_lineage

# Fixed value: what separates words once A-Z is lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
GRAM = 5


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def _positions(n: Column, length: int) -> Column:
    """0, 1, ..., n - length, empty when a text is shorter."""
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def _grams(hashes: Column, n: Column, length: int) -> Column:
    return F.transform(_positions(n, length), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(length)]))


def _kept(grams: Column, n: Column, span: int) -> Column:
    """Smallest gram of every `span` consecutive ones, each value once."""
    return F.array_distinct(F.transform(_positions(n, span), lambda i: F.least(*[F.get(grams, i + j) for j in range(span)])))


def fingerprints(rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Adds `__n` (words) and `__kept` (winnowed hashes) to rows with a column `__words`."""
    span = window - gram + 1
    return (
        rows.withColumn("__n", F.size("__words"))
        .withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))
        .withColumn("__grams", _grams(F.col("__hashes"), F.col("__n"), gram))
        .withColumn("__kept", _kept(F.col("__grams"), F.size("__grams"), span))
    )


def _windows(rows: DataFrame, length: int, *keep: str) -> DataFrame:
    """Every run of `length` words with its place and two hashes of its words."""
    run = lambda i: F.slice("__words", i + 1, length)
    at = F.transform(_positions(F.size("__words"), length), lambda i: F.struct(i.alias("at"), F.xxhash64(run(i)).alias("w1"), F.hash(run(i)).alias("w2")))
    # The outer form: the inner one adds a size filter that would be pushed below the split and redo it for every place.
    return rows.select(*keep, F.explode_outer(at).alias("w")).select(*keep, "w.*", F.lit(length).alias("length")).filter("at is not null")


def contaminated_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(screened documents, hits). Screened: doc_id, keys, n_words. Hits: keys, at, length, item of every occurrence.

    An item of fewer than `window` words is one window of its own length; such lengths cannot be winnowed and are looked up
    at every place of every document. Null texts have no words; a null item id is the item "null".
    """
    narrow = docs.select(F.col(doc_id).alias("doc_id"), *key_columns(doc_id, text), words(F.col(text)).alias("__words"))
    items = cut_lineage(
        benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("item"), words(F.col(item_text)).alias("__words")).filter(F.size("__words") > 0)
    )
    short = sorted(r[0] for r in items.filter(F.size("__words") < window).select(F.size("__words")).distinct().collect())  # at most window - 1 numbers

    marks = fingerprints(items, window, gram).select(F.explode_outer("__kept").alias("mark")).filter("mark is not null").distinct().withColumn("met", F.lit(1))
    spread = fingerprints(narrow, window, gram).select("doc_id", *KEY, "__n", F.explode_outer("__kept").alias("mark"))
    screened = cut_lineage(
        spread.join(marks, "mark", "left").groupBy("doc_id", *KEY).agg(F.max("__n").cast("long").alias("n_words"), F.count("met").alias("met"))
    )
    candidates = screened.filter("met > 0").select(*KEY)
    near = narrow.join(small_or_shuffled(candidates, candidates.count()), KEY, "left_semi").select(*KEY, "__words")

    def occurrences(rows: DataFrame, length: int) -> DataFrame:
        targets = items.filter(F.size("__words") == length) if length < window else items
        known = _windows(targets, length, "item").select("item", "w1", "w2").distinct()
        return _windows(rows, length, *KEY).join(known, ["w1", "w2"]).select(*KEY, "at", "length", "item")

    hits = occurrences(near, window)
    for length in short:
        hits = hits.unionByName(occurrences(narrow, length))
    return screened.drop("met"), cut_lineage(hits)


def merged(hits: DataFrame) -> DataFrame:
    """Maximal runs of hit words per row: keys, start, stop (words, stop excluded)."""
    order = Window.partitionBy(*KEY).orderBy("at", "stop")
    ends = hits.select(*KEY, "at", (F.col("at") + F.col("length")).alias("stop")).groupBy(*KEY, "at").agg(F.max("stop").alias("stop"))
    reach = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = ends.withColumn("new", F.coalesce(F.col("at") > reach, F.lit(True)).cast("int")).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*KEY, "run").agg(F.min("at").alias("start"), F.max("stop").alias("stop")).drop("run")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every document.

    Without words or benchmark a document has no hit and the digest of an empty string. Rows that repeat with id and text
    give equal results, one for each. Other columns are ignored.
    """
    screened, hits = contaminated_spans(docs, benchmark, window, gram, doc_id, text, item_id, item_text)
    covered = merged(hits).groupBy(*KEY).agg(F.sum(F.col("stop") - F.col("start")).cast("long").alias("n_hit"))
    items = hits.select(*KEY, "item").distinct().groupBy(*KEY).agg(F.array_sort(F.collect_list("item")).alias("items"))
    found = covered.join(items, KEY)
    rows = docs.select(*key_columns(doc_id, text)).groupBy(*KEY).agg(F.count("*").alias("times")).filter("times > 1")
    out = screened.join(found, KEY, "left").join(small_or_shuffled(rows, rows.count()), KEY, "left")
    return out.select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"),
        F.explode(F.sequence(F.lit(1), F.coalesce(F.col("times").cast("int"), F.lit(1)))).alias("__copy"),
    ).drop("__copy")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without any hit, with the input's columns, whatever their names. A null or empty text has no hit; rows that
    repeat id and text all stay or all go; an empty table gives no rows."""
    _, hits = contaminated_spans(docs, benchmark, window, gram, doc_id, text)
    bad = cut_lineage(hits.select(*KEY).distinct())
    kept, names = joined_by_key(docs, small_or_shuffled(bad, bad.count()), "left_anti", doc_id, text)
    return kept.drop(*names)
