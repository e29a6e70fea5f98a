"""N-gram Jaccard join by a prefix tree, and the groups of documents that its links form.

Sets of word 5-grams are kept as ascending 64-bit hashes, one order for all sets. The join is exact and has three steps.

1. Screen. A set linked to another one misses at most a quarter of its own grams there. Every set sends its grams below a
   fixed hash bound (at least its prefix); a set goes on only if enough of what it sent is shared.
2. Candidates. The sets that are left order what they sent: grams below the bound by frequency, which is known for them, then
   the others by hash; two linked sets share a gram of their prefixes.
   A prefix gram first ties its sets to one hub, where the places of the gram leave room for the overlap that the sizes of
   the two sets ask for. Sets of a gram that those ties do not join meet in blocks inside tasks.
3. Trie. Candidates of a set arrive in the order of their grams, which is a depth-first walk of the tree of their sets. The
   overlap counted along a shared path is kept, and a set is left as soon as its remaining grams cannot reach the bound.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.batches import BASE, LOWER, NOT_SPACE, Prefix, mix64, pieces, utf8_of, word_bounds
from tallyloom.llm.common import KEY, joined_by_key, key_columns, release
from tallyloom.llm.graph import components
from tallyloom.session import cut_lineage

GRAM = 5
# 100 * intersection >= 75 * union, as a fraction in lowest terms.
ABOVE, BELOW = 3, 4
SENT_SHARE = 0.35
SENT_BELOW = np.uint64(int(SENT_SHARE * 2**64))
PLACES = mix64(np.arange(1, GRAM + 1, dtype=np.uint64) * np.uint64(BASE)) | np.uint64(1)
HUB_CHUNK = 512
STRIDE = 64
PAIR_BLOCK = 2048
BINS = 256


def gram_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(grams, bounds): the distinct gram hashes of each text in ascending order, text i from bounds[i] to bounds[i + 1].

    A text of fewer than GRAM words has its whole sequence as one gram; one without words has none.
    """
    rows = len(offsets) - 1
    data = LOWER[data]
    starts, stops, row = word_bounds(data, offsets, NOT_SPACE)
    words = Prefix(data).of(starts, stops)
    n = np.bincount(row, minlength=rows)
    first = np.cumsum(n) - n
    if len(words) >= GRAM:
        long = row[GRAM - 1 :] == row[: len(row) - GRAM + 1]
        grams = sum((words[k : len(words) - GRAM + 1 + k] * PLACES[k] for k in range(GRAM)), np.uint64(0))[long]
        of = row[: len(row) - GRAM + 1][long]
    else:
        grams, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((n > 0) & (n < GRAM))
    if len(short):
        tail = np.zeros(len(short), np.uint64)
        for k in range(GRAM - 1):
            has = n[short] > k
            tail[has] += words[first[short[has]] + k] * PLACES[k]
        grams = np.concatenate([grams, tail + n[short].astype(np.uint64)])
        of = np.concatenate([of, short])
        order = np.argsort(of, kind="stable")
        grams, of = grams[order], of[order]
    grams = mix64(grams)
    ends = np.searchsorted(of, np.arange(rows + 1))
    for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()):
        grams[a:b].sort()
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (of[1:] != of[:-1])
    return grams[new], np.concatenate([[0], np.cumsum(np.bincount(of[new], minlength=rows))])


def prefix_length(n: np.ndarray) -> np.ndarray:
    """A linked set shares at least ceil(3n / 4) of n grams, so one of any n - ceil(3n / 4) + 1."""
    return n - -(-ABOVE * n // BELOW) + 1


def sent_counts(grams: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of its smallest grams each set sends: those below the bound, but its prefix at least."""
    below = np.concatenate([[0], np.cumsum(grams < SENT_BELOW)])
    n = np.diff(bounds)
    return np.where(n > 0, np.maximum(below[bounds[1:]] - below[bounds[:-1]], prefix_length(n)), 0)


def set_keys(grams: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name each set."""
    out = []
    for salt in (1, 2):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(grams * np.uint64(BASE) + np.uint64(salt)), dtype=np.uint64)])
        out.append(mix64(sums[bounds[1:]] - sums[bounds[:-1]]).view(np.int64))
    return out[0], out[1]


def _sets_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    data, offsets = utf8_of(batch.column("text"))
    for i, j in pieces(offsets):
        yield i, j, *gram_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys, size, number of sent grams and name of the set of each row."""
    for batch in batches:
        for i, j, grams, bounds in _sets_of(batch):
            s1, s2 = set_keys(grams, bounds)
            yield pa.record_batch(
                [*batch.slice(i, j - i).select(["doc_id", *KEY]).columns, pa.array(np.diff(bounds)), pa.array(sent_counts(grams, bounds)), pa.array(s1), pa.array(s2)],
                names=["doc_id", *KEY, "n", "sent", "s1", "s2"],
            )


def _send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What sets send: (gram, owner, credit).

    Each task sends a set once. Within a piece, a gram of several sets is credited to them on the spot (rows with the
    owner's total as credit) and goes out once, marked -1; so a gram of very many sets is a few rows for each task.
    """
    seen: set[int] = set()
    for batch in batches:
        for _, _, grams, bounds in _sets_of(batch):
            owners, counts = set_keys(grams, bounds)[0], sent_counts(grams, bounds)
            fresh = np.zeros(len(owners), dtype=bool)
            for r, o in enumerate(owners.tolist()):
                if counts[r] and o not in seen:
                    seen.add(o)
                    fresh[r] = True
            counts = np.where(fresh, counts, 0)
            rows = np.repeat(np.arange(len(counts)), counts)
            at = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[rows]
            order = np.argsort(grams[at])
            sent, rows = grams[at][order], rows[order]
            edge = np.concatenate([[True], sent[1:] != sent[:-1], [True]]) if len(sent) else np.ones(1, bool)
            many = ~(edge[:-1] & edge[1:])
            credit = np.bincount(rows[many], minlength=len(counts))
            some = np.flatnonzero(credit)
            heads = many & edge[:-1]
            h = np.concatenate([sent[~many].view(np.int64), sent[heads].view(np.int64), owners[some]])
            owner = np.concatenate([owners[rows[~many]], np.zeros(int(heads.sum()), np.int64), owners[some]])
            marks = np.concatenate([np.zeros(int((~many).sum())), np.full(int(heads.sum()), -1), credit[some]]).astype(np.int32)
            yield pa.record_batch([pa.array(h), pa.array(owner), pa.array(marks)], names=["gram", "owner", "credit"])


def _credit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(owner, credit) from rows of `_send` in the order of grams: one for each gram that another set has, too."""
    held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)]

    def counted(gram, owner, credit):
        own = credit > 0
        totals, who = credit[own], owner[own]
        gram, owner, credit = gram[~own], owner[~own], credit[~own]
        if len(gram):
            heads = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
            known = np.minimum.reduceat(credit, heads) < 0
            spread = np.minimum.reduceat(owner, heads) != np.maximum.reduceat(owner, heads)
            shared = np.repeat(known | spread, np.diff(np.append(heads, len(gram)))) & (credit == 0)
            who = np.concatenate([who, owner[shared]])
            totals = np.concatenate([totals, np.ones(int(shared.sum()), np.int32)])
        names, index = np.unique(who, return_inverse=True)
        return pa.record_batch([pa.array(names), pa.array(np.bincount(index, weights=totals, minlength=len(names)).astype(np.int64))], names=["owner", "credit"])

    for batch in batches:
        held = [np.concatenate([a, batch.column(c).to_numpy()]) for a, c in zip(held, ("gram", "owner", "credit"))]
        cut = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0  # the last gram may go on in the next batch
        if cut:
            yield counted(*[a[:cut] for a in held])
            held = [a[cut:] for a in held]
    if len(held[0]):
        yield counted(*held)


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole sets as big-endian bytes, so that bytes sort as the grams do."""
    for batch in batches:
        for i, j, grams, bounds in _sets_of(batch):
            body, sent = grams.astype(">u8"), sent_counts(grams, bounds)
            packed = [body[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.record_batch([batch.column("sid")[i:j], pa.array(np.diff(bounds)), pa.array(sent), pa.array(packed, pa.binary())], names=["sid", "n", "sent", "grams"])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, sid, n, sent, upto) of the grams that each set sends.

    `upto` is how many grams of the set lie below the hash bound; for a gram at or above it, the gram's place in the set.
    """
    for batch in batches:
        sent = batch.column("sent").to_numpy()
        body = b"".join(g.as_py()[: 8 * s] for g, s in zip(batch.column("grams"), sent.tolist()))
        grams = np.frombuffer(body, ">u8").astype(np.uint64)
        row = np.repeat(np.arange(len(sent)), sent)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sent) - sent, sent) + 1
        below = grams < SENT_BELOW
        upto = np.where(below, np.bincount(row[below], minlength=len(sent))[row], place)
        columns = [pa.array(batch.column(c).to_numpy()[row]) for c in ("sid", "n", "sent")]
        yield pa.record_batch([pa.array(grams.view(np.int64)), *columns, pa.array(upto)], names=["gram", "sid", "n", "sent", "upto"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) from rows in trie order: a probe set, then its candidate sets by their grams.

    `path` and `upto` are the grams of the last candidate and the overlap with the probe at each of its depths, counted as far
    as `depth`; the next candidate starts from where its path leaves that one.
    """
    probe, upto, path, depth = np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint64), 0
    for batch in batches:
        us, vs = [], []
        columns = [batch.column(c) for c in ("hub", "kind", "sid", "grams")]
        for hub, kind, sid, packed in zip(columns[0].to_pylist(), columns[1].to_pylist(), columns[2].to_pylist(), columns[3]):
            grams = np.frombuffer(packed.as_buffer(), ">u8").astype(np.uint64)
            if kind == 0:
                probe, path, upto, depth = grams, np.zeros(0, np.uint64), np.zeros(1, np.int64), 0
                continue
            n, m = len(grams), len(probe)
            need = -(-ABOVE * (n + m) // (ABOVE + BELOW))
            shared = min(n, depth)
            differ = np.flatnonzero(grams[:shared] != path[:shared])
            at = int(differ[0]) if len(differ) else shared
            counts = np.zeros(n + 1, np.int64)
            counts[: at + 1] = upto[: at + 1]
            while at < n:
                here = int(np.searchsorted(probe, grams[at]))
                if counts[at] + min(n - at, m - here) < need:
                    break
                block = grams[at : at + STRIDE]
                place = np.minimum(np.searchsorted(probe, block), m - 1)
                counts[at + 1 : at + 1 + len(block)] = counts[at] + np.cumsum(probe[place] == block)
                at += len(block)
            path, upto, depth = grams, counts, at
            if at == n and counts[n] >= need:
                us.append(hub)
                vs.append(sid)
        yield pa.record_batch([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among candidate pairs (hub, sid), checked on whole sets; see `_walk`.

    A hub's candidates are split over chunks of about HUB_CHUNK, and the hub's set goes to each of them.
    """
    sizes = pairs.groupBy("hub").agg((F.count("*") / HUB_CHUNK).cast("int").alias("chunks"))
    dealt = pairs.join(sizes, "hub").select("hub", "sid", F.pmod(F.hash("sid"), F.col("chunks") + 1).alias("chunk"))
    members = dealt.join(sets, "sid").select("hub", "chunk", F.lit(1).alias("kind"), "sid", "grams")
    probes = dealt.select("hub", "chunk").distinct().join(sets.withColumnRenamed("sid", "hub"), "hub").select("hub", "chunk", F.lit(0).alias("kind"), F.col("hub").alias("sid"), "grams")
    walk = members.unionByName(probes).repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", "kind", "grams", "sid")
    return walk.mapInArrow(_walk, "u long, v long")


def candidate_prefixes(sets: DataFrame) -> DataFrame:
    """(gram, sid, n, rank, weight) of the prefix grams that several sets have; see step 2 of the module.

    `rank` counts the grams of the set up to this one, from 1, those of no other set included. Grams below the hash bound are
    sent by all their sets and go by `df`. One at or above it may be in sets that do not send it, so `df` says nothing there:
    such grams follow by hash alone, as `gram_sets` has them, and the prefix is always among what a set sends.
    `weight` says how common the grams of a set are: the text that others were edited from has more of their grams than
    they have of each other's, and is the best hub.
    """
    sent = sets.mapInArrow(_unpack, "gram long, sid long, n long, sent long, upto long")
    often = sent.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1")
    known = sent.join(often, "gram")
    late = F.shiftrightunsigned("gram", 1) >= F.lit(int(SENT_BELOW) >> 1)
    own = Window.partitionBy("sid")
    ranked = known.select(
        "*", F.row_number().over(own.orderBy(late, "df", "gram")).alias("nth"), F.count_if(~late).over(own).alias("shared"), (F.sum(F.log2("df")).over(own) / F.col("sent")).alias("weight")
    )
    prefix = F.col("n") - F.expr(f"({ABOVE} * n + {BELOW - 1}) div {BELOW}") + 1
    ranked = ranked.withColumn("rank", F.when(late, F.col("upto")).otherwise(F.col("nth") + F.col("upto") - F.col("shared")))
    return ranked.filter(F.col("rank") <= prefix).select("gram", "sid", "n", "rank", "weight")


def _may_link() -> Column:
    """Bound on a pair that shares a gram: sets of n and m grams link only if they share 3(n + m) / 7, so the first gram they
    share leaves that many from it on in either set. It is the gram's rank in the set of n, `at` in the one of m."""
    need = F.expr(f"({ABOVE} * (n + m) + {ABOVE + BELOW - 1}) div {ABOVE + BELOW}")
    return (F.least("n", "m") >= need) & (F.col("n") - F.col("rank") + 1 >= need) & (F.col("m") - F.col("at") + 1 >= need)


def _bins(grams: list[np.ndarray]) -> np.ndarray:
    """How many grams of each set fall into each of BINS bins, up to 255."""
    return np.stack([np.minimum(np.bincount(g.astype(np.int64) & (BINS - 1), minlength=BINS), 255) for g in grams]).astype(np.uint8)


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(u, v): links of a block of sets, or of two blocks, that join different groups; as few as join them.

    Two sets share no more grams than the sum of the smaller counts of their bins; a bin that is full in both bounds nothing.
    What that leaves is counted on the whole sets.
    """
    keys, held = ["lead", "i", "j"], None

    def links(group: pa.Table) -> tuple[list[int], list[int]]:
        side, sid, n, rank, label = (group[c].to_numpy() for c in ("side", "sid", "n", "rank", "label"))
        grams = [np.frombuffer(g.as_buffer(), ">u8").astype(np.uint64) for c in group["grams"].chunks for g in c]
        bins = _bins(grams)
        full = bins == 255
        label = np.unique(label, return_inverse=True)[1]
        within = not side.any()
        right = np.arange(len(sid)) if within else np.flatnonzero(side == 1)
        us, vs = [], []
        for a in range(len(sid)) if within else np.flatnonzero(side == 0).tolist():
            b = right[a + 1 :] if within else right
            need = -(-ABOVE * (n[a] + n[b]) // (ABOVE + BELOW))
            ok = (label[b] != label[a]) & (np.minimum(n[a], n[b]) >= need) & (n[a] - rank[a] + 1 >= need) & (n[b] - rank[b] + 1 >= need)
            b, need = b[ok], need[ok]
            most = np.minimum(bins[a], bins[b]).sum(axis=1, dtype=np.int64)
            ok = (most >= need) | (full[a] & full[b]).any(axis=1)
            for c, wanted in zip(b[ok].tolist(), need[ok].tolist()):
                if label[c] == label[a]:
                    continue
                at = np.minimum(np.searchsorted(grams[a], grams[c]), n[a] - 1)
                if int((grams[a][at] == grams[c]).sum()) >= wanted:
                    us.append(int(sid[a]))
                    vs.append(int(sid[c]))
                    label[label == label[c]] = label[a]
        return us, vs

    def result(found: list[tuple[list[int], list[int]]]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([x for f in found for x in f[k]], pa.int64()) for k in (0, 1)], names=["u", "v"])

    for batch in batches:
        table = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
        new = np.zeros(table.num_rows, dtype=bool)
        for k in keys:
            c = table[k].to_numpy()
            new[1:] |= c[1:] != c[:-1]
        found, at = [], 0
        for stop in np.flatnonzero(new).tolist():  # the last group may go on in the next batch
            if stop - at > 1:
                found.append(links(table.slice(at, stop - at)))
            at = stop
        held = table.slice(at)
        yield result(found)
    if held is not None and held.num_rows > 1:
        yield result([links(held)])


def crossing_links(rows: DataFrame, sets: DataFrame) -> DataFrame:
    """(u, v): links between sets of different groups that share a prefix gram.

    Grams with the same smallest set go together: its sets meet once for all of them, in blocks of about PAIR_BLOCK, every
    block with every one. Sets are compared inside tasks, and only links leave them.
    """
    leads = rows.groupBy("gram").agg(F.min("sid").alias("lead"))
    members = cut_lineage(rows.join(leads, "gram").groupBy("lead", "sid").agg(F.min("rank").alias("rank"), F.max("n").alias("n"), F.max("label").alias("label")))
    sizes = members.groupBy("lead").agg((F.count("*") / PAIR_BLOCK).cast("int").alias("last"))
    own = F.pmod(F.hash("sid"), F.col("last") + 1)
    dealt = members.join(sizes, "lead").select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), "last")).alias("with"))
    blocks = dealt.select("lead", F.least("own", "with").alias("i"), F.greatest("own", "with").alias("j"), (F.col("own") > F.col("with")).cast("int").alias("side"), "sid", "n", "rank", "label")
    met = blocks.join(sets.select("sid", "grams"), "sid").repartition("lead", "i", "j").sortWithinPartitions("lead", "i", "j")
    return met.mapInArrow(_block_links, "u long, v long")


def _stars(rows: DataFrame) -> DataFrame:
    """(hub, sid): for each set outside the group of its grams' hubs, the hub that most of its prefix grams have."""
    best = rows.groupBy("gram").agg(F.max(F.struct("weight", "sid", "label", "n", "rank")).alias("best"))
    hubs = best.select("gram", F.col("best.sid").alias("hub"), F.col("best.label").alias("other"), F.col("best.n").alias("m"), F.col("best.rank").alias("at"))
    votes = rows.join(hubs, "gram").filter((F.col("label") != F.col("other")) & _may_link()).groupBy("sid", "hub").agg(F.count("*").alias("votes"))
    return votes.groupBy("sid").agg(F.max_by("hub", F.struct("votes", "hub")).alias("hub")).select("hub", "sid")


def linked_sets(sets: DataFrame) -> DataFrame:
    """(node, label) of all sets that link with another one; label is the smallest set id of the group.

    Stars join the bulk of each group with one candidate for each set. A prefix gram whose sets are in one group by then
    needs no more; for the others every pair of sets from different groups is looked at.
    """
    spark = sets.sparkSession
    prefixes = cut_lineage(candidate_prefixes(sets))
    stars = cut_lineage(_stars(prefixes.withColumn("label", F.col("sid"))))
    links = cut_lineage(verified(stars, sets))
    labels = components(links).withColumnRenamed("node", "sid")
    named = prefixes.join(labels, "sid", "left").withColumn("label", F.coalesce("label", "sid"))
    mixed = named.groupBy("gram").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high").select("gram")
    rows = cut_lineage(named.join(mixed, "gram"))
    release(spark)
    more = cut_lineage(crossing_links(rows, sets))
    return components(links.unionByName(more))


def documents_with_sets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keys of the row, n, sent and name of its set (s1, s2) of every row; materialised and narrow."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), *key_columns(doc_id, text), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return cut_lineage(rows.mapInArrow(_describe, f"doc_id {kind}, __k1 long, __k2 int, n long, sent long, s1 long, s2 long"))


def grouped(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keys of the row, n_shingles, component_id and name of the group (g1, g2; null without words) of every row.

    component_id is the smallest id that links reach. Texts without words, null ones too, link with nothing and keep their
    own id. A null id is never the smallest while the group has another one. Repeated rows are linked like any equal texts.
    """
    spark = docs.sparkSession
    described = documents_with_sets(docs, doc_id, text)
    texts = docs.select(F.col(text).alias("text"))
    credits = (
        texts.mapInArrow(_send, "gram long, owner long, credit int").repartition("gram").sortWithinPartitions("gram")
        .mapInArrow(_credit, "owner long, credit long").groupBy("owner").agg(F.sum("credit").alias("credit"))
    )
    names = described.filter("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("first_doc"), F.max("n").alias("n"), F.max("sent").alias("sent"), F.min(F.struct(*KEY)).alias("row"))
    spare = F.col("n") - F.expr(f"({ABOVE} * n + {BELOW - 1}) div {BELOW}")
    kept = names.join(credits.withColumnRenamed("owner", "s1"), "s1").filter(F.col("credit") >= F.greatest(F.lit(1), F.col("sent") - spare))
    kept = cut_lineage(kept.select(F.col("s1").alias("sid"), "first_doc", F.col("row.__k1").alias("__k1"), F.col("row.__k2").alias("__k2")))
    release(spark)
    keyed = docs.select(*key_columns(doc_id, text), F.col(text).alias("text"))
    chosen = keyed.join(kept.select("sid", *KEY), KEY)
    sets = chosen.mapInArrow(_full_sets, "sid long, n long, sent long, grams binary").dropDuplicates(["sid"])
    sets = cut_lineage(sets)
    release(spark)
    labels = linked_sets(sets)
    of_sets = kept.join(labels.withColumnRenamed("node", "sid"), "sid").select("sid", "label", "first_doc")
    heads = of_sets.groupBy("label").agg(F.min("first_doc").alias("head"))
    heads = of_sets.join(heads, "label").select(F.col("sid").alias("s1"), "head", "label")
    own = names.join(heads, "s1", "left").select(
        "s1", "s2", F.coalesce("head", "first_doc").alias("component_id"), F.coalesce("label", "s1").alias("g1"), F.when(F.col("label").isNull(), F.col("s2")).otherwise(0).alias("g2")
    )
    filled = described.filter("n > 0").join(own, ["s1", "s2"]).select("doc_id", *KEY, F.col("n").alias("n_shingles"), "component_id", "g1", "g2")
    empty = described.filter("n = 0").select("doc_id", *KEY, F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).alias("g1"), F.lit(None).alias("g2"))
    return filled.unionByName(empty)


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every document; see `grouped`. Other columns are ignored."""
    return grouped(docs, doc_id, text).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, the one with the smallest id (a null id only if there is no other), with the input's columns.

    Documents without words are in no group and stay. Rows that repeat id and text are one document. Other columns may have any
    names; an empty table gives no rows.
    """
    rows = grouped(docs, doc_id, text)
    first = rows.filter("n_shingles > 0").groupBy("g1", "g2").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", *KEY)).alias("row")).select(*[f"row.{k}" for k in KEY])
    kept = cut_lineage(first.unionByName(rows.filter("n_shingles = 0").select(*KEY).distinct()))
    found, names = joined_by_key(docs, kept, "inner", doc_id, text)
    return found.dropDuplicates(names).drop(*names)
