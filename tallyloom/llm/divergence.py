"""Divergence of sources: term counts of every group of language and source by a second pass over minimal perfect hashes.

The first pass counts the documents of each term exactly and keeps the frequent terms of each language. They are dealt into
shards; a task builds the minimal perfect hash of its shards: buckets of keys are displaced until no two keys meet, and a key
alone in its bucket names its slot. The second pass broadcasts the hashes with their keys, looks every term up, compares it
with the stored key, and adds to the dense slots of the group. Hashes above a fixed number of bytes are broadcast in turns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.batches import LOW_BYTES, LOWER, eights_of, mix64, pieces, stretch_hashes, table_of, utf8_of
from tallyloom.session import shared_folder

MIN_DOCS = 10
TOP = 10
SCALE = 1_000_000_000
SHARD_KEYS = 4096
KEYS_A_BUCKET = 2
TURN_BYTES = 48 << 20
SLOTS_HELD = 1 << 24
PART_BYTES = 1 << 21
#: Fixed value: runs of these bytes are terms, that is of A-Z, a-z and everything outside ASCII.
TERM_BYTES = table_of((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))


def coded_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(different terms, term of each occurrence, row of each occurrence) of the rows of a byte array."""
    text = LOWER[data]
    inside = TERM_BYTES[text]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    rows_at = offsets[:-1][offsets[:-1] < offsets[-1]]
    begins[rows_at] = inside[rows_at]
    first = np.flatnonzero(begins[inside])
    body = text[inside]
    bounds = np.append(first, len(body)).astype(np.int64)
    terms = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(body)]).dictionary_encode()
    row = np.searchsorted(offsets, np.flatnonzero(begins), side="right") - 1
    return terms.dictionary, terms.indices.to_numpy().astype(np.int64), row


def lang_seeds(langs: list[str], seed: int) -> np.ndarray:
    """One seed for each language, from its name alone."""
    data, offsets = utf8_of(pa.array(langs, pa.string()))
    return stretch_hashes(data, offsets[:-1], offsets[1:], np.full(len(langs), seed, np.uint64))


def placed(hashes: np.ndarray, size: np.ndarray | int, displacement: np.ndarray | int) -> np.ndarray:
    """Slot of each hash among `size` under a displacement; a negative displacement names the slot itself."""
    moved = mix64(hashes ^ mix64(np.atleast_1d(displacement).astype(np.uint64))) % np.asarray(size, np.uint64)
    return np.where(np.asarray(displacement) < 0, -1 - np.asarray(displacement), moved.astype(np.int64))


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) % np.uint64(shards)).astype(np.int64)


def bucket_of(hashes: np.ndarray, buckets: np.ndarray | int) -> np.ndarray:
    return ((hashes >> np.uint64(8)) % np.asarray(buckets, np.uint64)).astype(np.int64)


def build_hash(hashes: np.ndarray) -> np.ndarray:
    """Displacements that send n different hashes to the slots 0 to n - 1, one for each bucket.

    Full buckets come first. All open buckets of one size try the same displacement; each is placed when its slots are free and
    no bucket before it wants one of them.
    """
    n = len(hashes)
    shift = np.zeros(-(-n // KEYS_A_BUCKET), np.int32)
    bucket = bucket_of(hashes, len(shift))
    sizes = np.bincount(bucket, minlength=len(shift))
    free = np.ones(n, dtype=bool)
    for size in range(int(sizes.max(initial=0)), 1, -1):
        open_ = np.flatnonzero(sizes[bucket] == size)
        keys, owner, d = hashes[open_], bucket[open_], 0
        while len(keys):
            at = placed(keys, n, d)
            claim = np.full(n, len(shift))
            np.minimum.at(claim, at, owner)
            fits = free[at] & (claim[at] == owner) & _meets_no_own(at, owner)
            done = (np.bincount(owner, weights=fits, minlength=len(shift)) == size)[owner]
            free[at[done]] = False
            shift[owner[done]] = d
            keys, owner = keys[~done], owner[~done]
            d += 1
    single = np.flatnonzero(sizes == 1)
    shift[single] = -1 - np.flatnonzero(free)[: len(single)]
    return shift


def _meets_no_own(at: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Marks of the keys that no other key of their bucket meets."""
    pair = at << 32 | owner
    _, back, times = np.unique(pair, return_inverse=True, return_counts=True)
    return times[back] == 1


def _shard_hashes(seed: int, shards: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8_of(batch["term"])
            codes = batch["lang"].dictionary_encode()
            seeds = lang_seeds(codes.dictionary.to_pylist(), seed)[codes.indices.to_numpy()] if len(batch["lang"]) else np.zeros(0, np.uint64)
            hashes = stretch_hashes(data, offsets[:-1], offsets[1:], seeds)
            shard = shard_of(hashes, shards)
            yield pa.record_batch([batch["lang"], batch["term"], pa.array(shard.astype(np.int32)), pa.array(hashes.view(np.int64))], names=["lang", "term", "shard", "hash"])

    return run


def _built(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One row for a shard: its keys in the order of their slots, and the displacements. Not whole: two keys have one hash."""
    hashes = table["hash"].to_numpy().view(np.uint64)
    whole = len(np.unique(hashes)) == len(hashes)
    if not whole:
        return pa.table({"shard": [key[0].as_py()], "whole": [False], "bytes": [0], "shift": [[]], "langs": [[]], "terms": [[]]}, BUILT)
    shift = build_hash(hashes)
    ordered = table.take(pa.array(np.argsort(placed(hashes, len(hashes), shift[bucket_of(hashes, len(shift))]))))
    terms, langs = ordered["term"].to_pylist(), ordered["lang"].to_pylist()
    size = sum(len(t.encode()) for t in terms) + 24 * len(terms) + 4 * len(shift)
    return pa.table({"shard": [key[0].as_py()], "whole": [True], "bytes": [size], "shift": [shift.tolist()], "langs": [langs], "terms": [terms]}, BUILT)


BUILT = pa.schema([("shard", pa.int32()), ("whole", pa.bool_()), ("bytes", pa.int64()), ("shift", pa.list_(pa.int32())), ("langs", pa.list_(pa.string())), ("terms", pa.list_(pa.string()))])


class Hashes:
    """Plain arrays of the shards of one turn, and the look-up over them. `arrays` may be broadcast; a task rebuilds the object."""

    def __init__(self, arrays: dict):
        self.__dict__.update(arrays)
        self.lang_no = {lang: k for k, lang in enumerate(self.langs)}
        self.seeds = lang_seeds(self.langs, self.seed)

    @staticmethod
    def arrays(built: pa.Table, shards: int, seed: int) -> dict:
        """From rows of `_built`; shards that are not among them are empty."""
        built = built.sort_by("shard").combine_chunks()
        size, buckets = np.zeros(shards, np.int64), np.zeros(shards, np.int64)
        flat = {c: pa.concat_arrays([x.flatten() for x in built[c].chunks]) if len(built) else pa.array([], t) for c, t in (("shift", pa.int32()), ("langs", pa.string()), ("terms", pa.string()))}
        size[built["shard"].to_numpy()] = pc.list_value_length(built["terms"]).to_numpy()
        buckets[built["shard"].to_numpy()] = pc.list_value_length(built["shift"]).to_numpy()
        langs = flat["langs"].dictionary_encode()
        keys, key_at = utf8_of(flat["terms"])
        return {
            "seed": seed, "shards": shards, "langs": langs.dictionary.to_pylist(), "size": size, "buckets": buckets, "first_slot": np.cumsum(size) - size,
            "first_bucket": np.cumsum(buckets) - buckets, "shift": flat["shift"].to_numpy().copy(), "slot_lang": langs.indices.to_numpy().copy(),
            "keys": keys.copy(), "key_at": key_at.copy(),
        }

    def codes(self) -> np.ndarray:
        """Number of each slot that holds over all turns: shard and place in it."""
        shard = np.repeat(np.arange(self.shards), self.size)
        return shard << 32 | np.arange(len(shard)) - self.first_slot[shard]

    def find(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Slot of each stretch of `data` as a term of the language with that number, or -1. The stored key decides."""
        slots = np.full(len(starts), -1, np.int64)
        if not len(self.slot_lang):
            return slots
        live = np.flatnonzero((lang >= 0) & (stops - starts <= np.diff(self.key_at).max()))
        hashes = stretch_hashes(data, starts[live], stops[live], self.seeds[lang[live]])
        shard = shard_of(hashes, self.shards)
        filled = self.size[shard] > 0
        live, hashes, shard = live[filled], hashes[filled], shard[filled]
        shift = self.shift[self.first_bucket[shard] + bucket_of(hashes, self.buckets[shard])]
        slot = self.first_slot[shard] + placed(hashes, self.size[shard], shift)
        sizes = stops[live] - starts[live]
        same = (self.slot_lang[slot] == lang[live]) & (self.key_at[slot + 1] - self.key_at[slot] == sizes)
        live, slot, sizes = live[same], slot[same], sizes[same]
        text, keys = eights_of(data), eights_of(self.keys)
        equal, open_, step = np.ones(len(live), dtype=bool), np.flatnonzero(sizes > 0), 0
        while len(open_):
            low = LOW_BYTES[np.minimum(sizes[open_] - step, 8)]
            equal[open_] &= (text[starts[live[open_]] + step] ^ keys[self.key_at[slot[open_]] + step]) & low == 0
            step += 8
            open_ = open_[(sizes[open_] > step) & equal[open_]]
        slots[live[equal]] = slot[equal]
        return slots


def _recount(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes(shared.value)
        by_lang = np.argsort(hashes.slot_lang, kind="stable")
        lang_at = np.searchsorted(hashes.slot_lang[by_lang], np.arange(len(hashes.langs) + 1))
        place = np.empty(len(by_lang), np.int64)  # of a slot among those of its language
        place[by_lang] = np.arange(len(by_lang)) - lang_at[hashes.slot_lang[by_lang]]
        codes = hashes.codes()[by_lang]
        dense: dict[tuple[str, str], np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), counts in dense.items():
                own = codes[lang_at[hashes.lang_no[lang]] :]
                used = np.flatnonzero(counts)
                for a in range(0, len(used), 1 << 16):
                    part = used[a : a + (1 << 16)]
                    lists = [pa.array([x], pa.list_(pa.int64())) for x in (own[part], counts[part])]
                    yield pa.record_batch([pa.array([lang]), pa.array([source]), *lists], names=["lang", "source", "codes", "counts"])
            dense.clear()

        for batch in batches:
            data, offsets = utf8_of(batch["text"])
            groups = list(zip(batch["lang"].to_pylist(), batch["source"].to_pylist()))
            for a, b in pieces(offsets, PART_BYTES):
                terms, term, row = coded_terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                number: dict[tuple[str, str], int] = {}
                of = np.array([number.setdefault(g, len(number)) for g in groups[a:b]], np.int64)
                # the occurrences of each term in each group of this part, then one look-up for each
                joint, counts = np.unique(of[row] << 32 | term, return_counts=True)
                group, term = joint >> 32, joint & 0xFFFFFFFF
                lang = np.array([hashes.lang_no.get(g[0], -1) for g in number], np.int64)
                body, bounds = utf8_of(terms)
                slot = hashes.find(body, bounds[term], bounds[term + 1], lang[group])
                group, slot, counts = group[slot >= 0], slot[slot >= 0], counts[slot >= 0]
                edges = np.searchsorted(group, np.arange(len(number) + 1))
                for (g, k), i, j in zip(number.items(), edges, edges[1:]):
                    if i == j:
                        continue
                    if g not in dense:
                        size = int(lang_at[lang[k] + 1] - lang_at[lang[k]])
                        if sum(map(len, dense.values())) + size > SLOTS_HELD:
                            yield from flush()
                        dense[g] = np.zeros(size, np.int64)
                    dense[g][place[slot[i:j]]] += counts[i:j]
        yield from flush()

    return run


def shares(counts: np.ndarray, totals: np.ndarray, n_terms: int) -> np.ndarray:
    """1 + floor(10 ** 9 * (count + 2) / (total + 2 * n_terms)), three digits a step, exact while the totals are below 9 * 10 ** 15."""
    whole = np.asarray(totals, np.int64) + 2 * n_terms
    found, rest = np.divmod(np.asarray(counts, np.int64) + 2, whole)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        found = found * 1000 + digits
    return found + 1


def excess(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _scored(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Partial sums of every two sources, and the best terms of each source, over one block of a language's terms.

    Rows with a source and no code name the groups of the language with their totals and number of kept terms; the others are counts.
    """
    lang = key[0].as_py()
    is_group = table["code"].is_null()
    groups = table.filter(is_group)
    names = groups["source"].to_pylist()
    number = {name: k for k, name in enumerate(names)}
    totals, n_terms = groups["total"].to_numpy(), groups["n_terms"][0].as_py()
    cells = table.filter(pc.invert(is_group))
    codes, term = np.unique(cells["code"].to_numpy(), return_inverse=True)
    counts = np.zeros((len(names), len(codes)), np.int64)
    counts[[number[s] for s in cells["source"].to_pylist()], term] = cells["count"].to_numpy()
    p = shares(counts, totals[:, None], n_terms)
    q = shares(counts.sum(axis=0), totals.sum(), n_terms)
    sources, items, part_codes, values = [], [], [], []
    for k, name in enumerate(names):
        sums = excess(p[k + 1 :], p[k]).sum(axis=1).tolist()
        for other, value in zip(names[k + 1 :], sums):
            sources += [name, other]
            items += [other, name]
            part_codes += [None, None]
            values += [value, value]
        own = np.flatnonzero((counts[k] > 0) & (p[k] > q))
        f = excess(p[k, own], q[own])
        best = own[f >= np.partition(f, -TOP)[-TOP]] if len(f) > TOP else own  # ties with the last one stay
        sources += [name] * len(best)
        items += [None] * len(best)
        part_codes += codes[best].tolist()
        values += excess(p[k, best], q[best]).tolist()
    return pa.table({"lang": [lang] * len(values), "source": sources, "item": items, "code": part_codes, "value": values}, SCORED)


SCORED = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("code", pa.int64()), ("value", pa.int64())])


def _term_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each term and language, added up within a few megabytes of text."""
    for batch in batches:
        data, offsets = utf8_of(batch["text"])
        for a, b in pieces(offsets, PART_BYTES):
            terms, term, row = coded_terms(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
            langs = batch["lang"].slice(a, b - a).dictionary_encode()
            lang = langs.indices.to_numpy().astype(np.int64)
            each = np.unique(row << 32 | term)
            joint, n = np.unique(lang[each >> 32] << 32 | each & 0xFFFFFFFF, return_counts=True)
            names = terms.take(pa.array(joint & 0xFFFFFFFF)).cast(pa.binary()).cast(pa.string())
            yield pa.record_batch([langs.dictionary.take(pa.array(joint >> 32)), names, pa.array(n)], names=["lang", "term", "n_docs"])


def kept_terms(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(lang, term) of the terms in at least `min_docs` documents of a language. `docs` has lang and text without nulls."""
    parts = docs.select("lang", "text").mapInArrow(_term_documents, "lang string, term string, n_docs long")
    return parts.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs")).filter(F.col("n_docs") >= min_docs).select("lang", "term")


def perfect_hashes(kept: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[DataFrame, int, int]:
    """(shards, number of shards, seed): one row of `_built` for each shard. Another seed is taken if two keys have one hash."""
    spark = kept.sparkSession
    shards = max(1, -(-kept.count() // shard_keys))
    seed = 1
    while True:
        folder = shared_folder(spark, "divergence-hashes")
        dealt = kept.mapInArrow(_shard_hashes(seed, shards), "lang string, term string, shard int, hash long")
        built = dealt.groupBy("shard").applyInArrow(_built, "shard int, whole boolean, bytes long, shift array<int>, langs array<string>, terms array<string>")
        built.write.parquet(folder)
        built = spark.read.parquet(folder)
        if built.filter("NOT whole").isEmpty():
            return built, shards, seed
        seed += 1


def group_counts(docs: DataFrame, built: DataFrame, shards: int, seed: int, turn_bytes: int = TURN_BYTES) -> DataFrame:
    """(lang, source, code, count) of the terms of `built` in every group, from one pass over `docs` for each turn."""
    spark = docs.sparkSession
    sizes = built.select("shard", "bytes").toPandas().sort_values("shard")
    turn = (sizes["bytes"].cumsum() - 1) // turn_bytes
    found = None
    for _, own in sizes.groupby(turn):
        # at most `turn_bytes` and one shard: the bound of what the driver collects and broadcasts at once
        rows = built.filter(F.col("shard").between(int(own["shard"].min()), int(own["shard"].max()))).drop("whole", "bytes").toArrow()
        shared = spark.sparkContext.broadcast(Hashes.arrays(rows, shards, seed))
        part = docs.mapInArrow(_recount(shared), "lang string, source string, codes array<long>, counts array<long>")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "lang string, source string, code long, count long")
    cells = found.select("lang", "source", F.inline(F.arrays_zip("codes", "counts")))
    return cells.groupBy("lang", "source", F.col("codes").alias("code")).agg(F.sum("counts").alias("count"))


def source_divergence(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, turn_bytes: int = TURN_BYTES, text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """How the sources of each language differ: lang, source, part, item, value, rank.

    Part `pair` has every other source of the language with the summed excess over all kept terms, part `term` the `top` (10 at
    most) terms that stand out most against the language. All numbers are whole and exact. Null text, language and source count as
    empty strings; every group that occurs has its pairs, also one without terms (a language without kept terms has pairs of value 0);
    repeated rows count as often as they come; texts and terms of any length are taken whole; other columns are ignored; an empty
    table has no rows. Hashes of at most `turn_bytes` and one shard are broadcast at once.
    """
    spark = docs.sparkSession
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    folder = shared_folder(spark, "divergence-terms")
    kept_terms(rows, min_docs).write.parquet(folder)
    kept = spark.read.parquet(folder)
    built, shards, seed = perfect_hashes(kept)
    folder = shared_folder(spark, "divergence-counts")
    group_counts(rows, built, shards, seed, turn_bytes).write.parquet(folder)
    counts = spark.read.parquet(folder)

    groups = rows.select("lang", "source").distinct()
    totals = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"))
    sizes = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"))
    folder = shared_folder(spark, "divergence-groups")
    groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "n_terms"]).write.parquet(folder)
    groups = spark.read.parquet(folder)

    cells = counts.withColumn("block", F.shiftright("code", 32))
    blocks = cells.select("lang", "block").distinct()
    empty = lambda name: F.lit(None).cast("long").alias(name)
    heads = blocks.join(groups, "lang").select("lang", "block", "source", empty("code"), empty("count"), "total", "n_terms")
    folder = shared_folder(spark, "divergence-scores")
    both = heads.unionByName(cells.select("lang", "block", "source", "code", "count", empty("total"), empty("n_terms")))
    both.groupBy("lang", "block").applyInArrow(_scored, "lang string, source string, item string, code long, value long").write.parquet(folder)
    scored = spark.read.parquet(folder)

    sums = scored.filter("code IS NULL").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").filter("source <> item")
    pairs = pairs.join(sums, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))
    names = built.select("shard", F.posexplode("terms").alias("place", "term")).select((F.shiftleft(F.col("shard").cast("long"), 32) + F.col("place")).alias("code"), "term")
    terms = scored.filter("code IS NOT NULL").join(names, "code").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    nth = F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item"))
    ranked = pairs.withColumn("rank", nth).unionByName(terms.withColumn("rank", nth).filter(F.col("rank") <= min(top, TOP)))
    return ranked.select("lang", "source", "part", "item", "value", "rank")
