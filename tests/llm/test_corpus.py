"""Corpus operators against brute force on small documents with nulls, empty and long texts, ties, repeats and odd columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import decontaminate, fingerprint, language, lines, mixing, quality, sharding, similar, substrings
from tallyloom.llm.graph import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans string, score long, __copyright string"


def corpus():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdefghio") for _ in range(rng.randint(2, 8))) for _ in range(400)] + ["Été", "ÄRGER", "naïve", "日本"]

    def prose(n):
        out = []
        for k in range(n):
            out.append(rng.choice(vocabulary))
            if k % 17 == 16:
                out[-1] += ".\n"
        return re.sub("\n ", "\n", " ".join(out))

    passage = prose(70)
    texts = [prose(rng.randint(20, 200)) for _ in range(25)]
    texts += [texts[0], texts[0], texts[1].upper(), texts[2] + " tail end", "x " + texts[2]]
    texts += [t + "\n" + passage + "\n" + prose(60) for t in texts[3:9]]
    words = texts[9].split(" ")
    for k in range(4):  # near copies in a chain
        words = words[:]
        words[(7 * k + 3) % len(words)] = f"edit{k}"
        texts.append(" ".join(words))
    texts += [prose(6000), "a" * 700, "ab" * 400, "", None, None, "one", "One", "two words", "\n\n \t\n", "|||| %%% ###", "same line\n" * 40]
    rows = [(i, t, "en" if i % 3 else "fr", None if i % 11 == 0 else f"s{i % 4}", len(t or ""), "x", 7, "y") for i, t in enumerate(texts)]
    rows += [rows[4], (None, texts[5], None, "s1", 1, "x", 7, "y"), (None, None, None, None, None, None, None, None), (4, "another text of id four", "en", "s1", 3, "x", 7, "y")]
    return rows


ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def tuples(df, *columns):
    return Counter(tuple(r[c] for c in columns) for r in df.collect())


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def split(text):
    return re.findall("[^\x20\x09-\x0d]+", lower(text))


def crc(value, n):
    return None if value is None else zlib.crc32(str(value).encode()) % n


def test_decontaminate(spark, docs, empty):
    item = lambda i, n, at: " ".join((ROWS[i][1] or "").split()[at : at + n])
    items = [(10, item(3, 25, 5)), (2, item(6, 12, 30)), (7, "one"), (8, item(9, 4, 2)), (9, None), (11, ""), (None, item(12, 10, 0)), (10, item(20, 11, 3)), (12, "never in any text " * 4)]
    bench = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id long, text string, doc_id string")
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    expected = Counter()
    for row in ROWS:
        words, hit, found = find(row[1]), set(), set()
        for i, t in items:
            w = find(t)
            size = min(10, len(w))
            runs = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if w else set()
            for at in range(len(words) - size + 1) if w else ():
                if tuple(words[at : at + size]) in runs:
                    hit.update(range(at, at + size))
                    found.add("null" if i is None else str(i))
        expected[(row[0], len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))] += 1
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert tuples(decontaminate.decontaminate(docs, bench), *columns) == expected
    assert sum(v for k, v in expected.items() if k[-1]) > 5
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).filter("contaminated").count() == 0
    clean = decontaminate.clean_documents(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(v for k, v in expected.items() if not k[-1])


def test_language(docs, empty):
    out = language.identify(docs)
    assert out.count() == len(ROWS)
    for r in out.collect():
        assert 0 <= r["score"] <= 1 and r["held_out"] == (crc(r["doc_id"], 4) == 2) and r["lang_pred"] in ("en", "fr", "und")
    silent = sum(not re.search(r"[^\W\d_]", row[1] or "") for row in ROWS)
    assert out.filter("lang_pred = 'und'").count() == silent
    assert language.identify(empty).count() == 0
    assert language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).filter("lang_pred <> 'und'").count() == 0


def test_suffix_automaton_and_parse():
    rng = random.Random(1)
    text = [rng.randint(1, 3) for _ in range(60)]
    automaton = language.suffix_automaton(text)
    parts = {tuple(text[a:b]) for a in range(60) for b in range(a + 1, 61)}

    def accepts(symbols):
        state = 0
        for c in symbols:
            if c not in automaton[state]:
                return False
            state = automaton[state][c]
        return True

    for _ in range(3000):
        probe = tuple(rng.randint(1, 3) for _ in range(rng.randint(1, 9)))
        assert accepts(probe) == (probe in parts)


def test_language_learns(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = language.identify(rows).join(rows.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (out.lang == out.lang_pred).mean() > 0.97


def test_language_learns_behind_openings(spark):
    """All texts open with the same 2,500 characters; what tells the languages apart comes after them."""
    rng = random.Random(4)
    words = {k: ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(6)) for _ in range(60)] for k in ("aa", "bb", "cc")}
    opening = ("licence terms apply to all of this " * 80)[:2500]
    rows = [(i, opening + " " + " ".join(rng.choice(words[k]) for _ in range(1000)), k) for i, k in enumerate(["aa", "bb", "cc"] * 80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert len(out) > 30 and (out.lang == out.lang_pred).all()


def test_fingerprints(docs, empty):
    out = fingerprint.fingerprint_documents(docs)
    order = sorted(ROWS, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    expected = Counter()
    for row, follower in zip(order, order[1:] + order[:1]):
        t, n = row[1] or "", follower[1] or ""
        edited = t[: len(t) - len(t) // 3] + n[: len(t) // 3]
        expected[(row[0], len(t), hashlib.sha256(edited.encode()).hexdigest())] += 1
    assert tuples(out, "doc_id", "n_chars", "edited_sha256") == expected
    of_text = defaultdict(set)
    ids = Counter(r[0] for r in ROWS)
    text_of = {r[0]: r[1] or "" for r in ROWS if ids[r[0]] == 1}
    for r in out.collect():
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if r["doc_id"] in text_of:
            of_text[text_of[r["doc_id"]]].add(r["fingerprint"])
    assert all(len(v) == 1 for v in of_text.values()) and len({min(v) for v in of_text.values()}) == len(of_text)
    long = out.filter("n_chars > 300 and n_chars < 30000 and doc_id < 25")
    assert long.agg(F.avg("near_edited")).head()[0] > 0.35 and long.agg(F.avg("near_next")).head()[0] < 0.2
    assert fingerprint.fingerprint_documents(empty).count() == 0


def test_parsing_is_local():
    rng = np.random.default_rng(3)
    body = rng.integers(97, 123, 20_000).astype(np.uint8)
    shifted = np.concatenate([rng.integers(97, 123, 137).astype(np.uint8), body])
    a = fingerprint.sketches(body, np.array([len(body)]))
    b = fingerprint.sketches(shifted, np.array([len(shifted)]))
    assert fingerprint.likeness(a, b)[0] > 0.85


@pytest.mark.parametrize("slots,shards", [(64, 5), (4096, 24)])
def test_sharding(docs, empty, slots, shards):
    rows = sharding.shard_documents(docs, shards, slots).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in ROWS)
    places, owner = defaultdict(list), defaultdict(set)
    for r in rows:
        places[r["shard"]].append(r["slot"])
        owner[r["doc_id"]].add((r["shard"], r["grown_shard"]))
        assert r["law"] == "key" and 0 <= r["shard"] < shards and r["grown_shard"] in (r["shard"], shards)
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and all(len(v) == 1 for v in owner.values())
    assert sharding.shard_documents(empty, shards, slots).count() == 0


def test_slot_maps(spark, docs):
    first = sharding.first_map(spark, 24)
    grown = sharding.grow(first, 24)
    assert grown.groupBy("shard").count().agg(F.max("count") - F.min("count")).head()[0] <= 12
    assert grown.join(first.withColumnRenamed("shard", "old"), "vslot").filter("shard <> old and shard <> 24").count() == 0
    loads = spark.range(4096).select(F.col("id").cast("int").alias("vslot"), F.expr("cast(id % 97 * (case when id < 400 then 9 else 1 end) as long)").alias("bytes"))
    spread = lambda m: m.join(loads, "vslot").groupBy("shard").agg(F.sum("bytes").alias("b")).agg(F.max("b") / F.avg("b")).head()[0]
    even = sharding.rebalance(first, loads)
    assert even.count() == 4096 and spread(even) < 1.1 < spread(first)
    assert even.agg(F.max("version")).head()[0] == 2


def test_stored_slot_map(spark, docs, tmp_path):
    first = sharding.first_map(spark, 5, 64)
    even = sharding.rebalance(first, sharding.slot_loads(docs, 64))
    folder = f"file://{tmp_path}"
    assert [sharding.write_map(m, folder) for m in (first, even)] == [1, 2]
    stored = sharding.read_map(spark, folder, 2)
    owner = {r["vslot"]: r["shard"] for r in even.collect()}
    rows = sharding.shard_documents(docs, 5, 64, slot_map=stored).collect()
    assert len(rows) == len(ROWS) and all(r["shard"] == owner[r["vslot"]] and r["map_version"] == 2 and r["law"] == "map" for r in rows)
    assert stored.count() == 64 and all(0 <= r["shard"] < 5 for r in rows)


def test_number_of_shards_decides(docs):
    """Growing gives the map of one more shard, at every number of shards."""
    for shards, slots in ((1, 64), (5, 64), (24, 4096)):
        before = tuples(sharding.shard_documents(docs, shards, slots), "doc_id", "grown_shard")
        assert before == tuples(sharding.shard_documents(docs, shards + 1, slots), "doc_id", "shard")


def water_levels(sizes, cap=3):
    weight = {k: i % 3 + 1 for i, k in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(cap * sizes[k] for k in capped)
        level = rest / sum(weight[k] for k in sizes if k not in capped)
        over = {k for k in sizes if k not in capped and weight[k] * level > cap * sizes[k] + 1e-9}
        if not over:
            return {k: cap * sizes[k] if k in capped else weight[k] * level for k in sizes}
        capped |= over


def test_mixing(spark, docs, empty):
    words = {}
    sizes = defaultdict(int)
    for r in ROWS:
        words[(r[0], r[1])] = len(re.findall("[^\x20\x09-\x0d]+", r[1] or ""))
        sizes[r[3]] += words[(r[0], r[1])]
    out = mixing.mix_documents(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((r[0], words[(r[0], r[1])]) for r in ROWS)
    expected, taken = water_levels(sizes), defaultdict(int)
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - expected[r["source"]]) < 1e-6 * max(1, expected[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[k] - expected[k]) <= 0.02 * expected[k] + 8 for k in expected)
    assert tuples(mixing.mix_documents(docs.repartition(7)), "doc_id", "size", "taken") == Counter((r["doc_id"], r["size"], r["taken"]) for r in out)
    assert mixing.mix_documents(empty).count() == 0 and mixing.mixed_corpus(docs).columns == docs.columns
    assert mixing.mix_documents(docs.filter("text is null or text = ''")).agg(F.sum("taken")).head()[0] == 0


def test_small_sources_of_a_large_corpus(spark):
    """Sources of 300 to 5,000 words next to 20 million: each comes as often as its target says, to half a document."""
    sizes = {"a": (40, 500_000), "b": (10, 30), "c": (50, 20), "d": (250, 20), "e": (1, 70)}
    rows = [(k * 1000 + i, s, n) for k, (s, (docs, n)) in enumerate(sizes.items()) for i in range(docs)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n int").repartition(8).select("doc_id", F.expr("repeat('w ', n)").alias("text"), "source")
    expected = water_levels({s: docs * n for s, (docs, n) in sizes.items()})
    got = {r["source"]: r["count"] for r in mixing.mixed_corpus(docs).groupBy("source").count().collect()}
    assert all(abs(got.get(s, 0) * n - expected[s]) <= n / 2 + 1 for s, (_, n) in sizes.items() if s != "a")
    assert abs(got["a"] * 500_000 - expected["a"]) <= 500_000 / 2 + 1
    taken = {r["source"]: (r["taken"], r["target"]) for r in mixing.mix_documents(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
    for s, (n_docs, n) in sizes.items():
        assert abs(taken[s][0] - taken[s][1]) <= max(1, n_docs * n / 4096) / 2 + 1


def test_points_are_spread(spark):
    """Every source holds as many points as slots, and its share of any stretch of the mix is near its share of the whole."""
    counts = {"a": 700, "b": 30, "c": 1, "d": 270}
    rows, lo = [], 0
    for s, n in counts.items():
        rows.append((s, n, lo))
        lo += n
    drawn = mixing.schedule(spark.createDataFrame(rows, "skey string, slots long, lo long")).orderBy("k").collect()
    assert Counter(r["skey"] for r in drawn) == counts
    for s, n in counts.items():
        assert [r["rank"] for r in drawn if r["skey"] == s] == list(range(n))
        seen = np.cumsum([r["skey"] == s for r in drawn])
        assert np.abs(seen - np.arange(1, len(drawn) + 1) * n / len(drawn)).max() < 5


def test_targets_hit_the_cap(spark):
    sizes = {"a": 1000, "b": 10, "c": 5, "d": 400, "e": 0, None: 20}
    rows = spark.createDataFrame([(f"s{k}" if k else "z", k, v) for k, v in sizes.items()], "skey string, source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    expected = water_levels(sizes)
    assert all(abs(got[k] - expected[k]) < 1e-6 for k in sizes) and abs(sum(got.values()) - sum(sizes.values())) < 1e-6


def jaccard_groups(rows):
    sets = []
    for r in rows:
        w = split(r[1])
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)]) if w else frozenset())
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]) and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    return sets, group


def test_similar(docs, empty):
    sets, group = jaccard_groups(ROWS)
    least = defaultdict(list)
    for g, r in zip(group, ROWS):
        least[g].append(r[0])
    smallest = {g: min((i for i in ids if i is not None), default=None) for g, ids in least.items()}
    expected = Counter((r[0], len(s), smallest[g]) for r, s, g in zip(ROWS, sets, group))
    assert tuples(similar.similar_documents(docs), "doc_id", "n_shingles", "component_id") == expected
    assert len(smallest) < len(ROWS) - 5
    kept = similar.one_of_each(docs)
    blank = len({(r[0], r[1]) for r, s in zip(ROWS, sets) if not s})
    assert kept.columns == docs.columns and kept.count() == blank + len({g for g, s in zip(group, sets) if s})
    assert similar.similar_documents(empty).count() == 0


def test_similar_many_candidates(spark):
    """Families of near copies of one text, with edits that only some of them share, at both sides of the bound."""
    rng = random.Random(8)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(60):
        words = base[:]
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(120)] = f"e{rng.randrange(12)}"
        rows.append((k, " ".join(words)))
    sets, group = jaccard_groups(rows)
    least = {g: min(r[0] for h, r in zip(group, rows) if h == g) for g in group}
    out = similar.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert tuples(out, "doc_id", "n_shingles", "component_id") == Counter((r[0], len(s), least[g]) for r, s, g in zip(rows, sets, group))


def test_similar_short_sets(spark):
    """Pairs of 6 to 60 words, each of its own words, where one text has a longer or shorter tail: sets whose prefix reaches above the bound."""
    rng = random.Random(11)
    rows = []
    for n in range(6, 61):
        for k in range(8):
            words = [f"p{n}x{k}w{j}" for j in range(n)]
            tail = rng.randint(1, max(1, (n - 4) // 3 + 1))
            other = words[:-tail] if k % 2 else words + [f"p{n}x{k}t{j}" for j in range(tail)]
            rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(other))]
    sets, group = jaccard_groups(rows)
    least = {}
    for g, r in zip(group, rows):
        least.setdefault(g, r[0])
    assert 300 < sum(least[g] != r[0] for g, r in zip(group, rows)) < 440
    out = similar.similar_documents(spark.createDataFrame(rows, "doc_id long, text string"))
    assert tuples(out, "doc_id", "n_shingles", "component_id") == Counter((r[0], len(s), least[g]) for r, s, g in zip(rows, sets, group))


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + k, 1001 + k) for k in range(40)] + [(7, 7)]
    group = {n: n for e in edges for n in e}
    for a, b in edges:
        a, b = group[a], group[b]
        group = {n: min(a, b) if g in (a, b) else g for n, g in group.items()}
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: g for n, g in group.items() if n in got} and {n for a, b in edges if a != b for n in (a, b)} == set(got)


@pytest.mark.parametrize("window,gram", [(200, 100), (40, 15), (9, 8)])
def test_substrings(docs, empty, window, gram):
    bodies = [(r[1] or "").encode() for r in ROWS]
    seen = Counter(b[k : k + window] for b in bodies for k in range(len(b) - window + 1))
    expected = Counter()
    for row, b in zip(ROWS, bodies):
        cover = np.zeros(len(b), bool)
        for k in range(len(b) - window + 1):
            if seen[b[k : k + window]] > 1:
                cover[k : k + window] = True
        runs = int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum())
        expected[(row[0], len(b), int(cover.sum()), runs, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~cover])).hexdigest())] += 1
    assert tuples(substrings.remove_repeated(docs, window, gram), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == expected
    assert substrings.remove_repeated(empty).count() == 0


def test_large_groups_in_parts(monkeypatch, docs):
    whole = tuples(substrings.remove_repeated(docs, 40, 15), "doc_id", "n_removed", "kept_sha256")
    monkeypatch.setattr(substrings, "RUN_ROWS", 3)
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        assert tuples(substrings.remove_repeated(docs, 40, 15), "doc_id", "n_removed", "kept_sha256") == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def brute_lines(gone):
    expected = Counter()
    for index, row in enumerate(ROWS):
        text, at, kept, spans, n = row[1] or "", 0, [], [], 0
        for k, line in enumerate(text.split("\n")):
            n += bool(split(line))
            if gone(index, k, line):
                spans.append(f"{at}-{at + len(line)}")
            else:
                kept.append(line)
            at += len(line) + 1
        expected[(row[0], n, len(spans), ",".join(spans), hashlib.sha256("\n".join(kept).encode()).hexdigest())] += 1
    return expected


COLUMNS = ["doc_id", "n_lines", "n_removed", "removed_spans", "kept_sha256"]


def test_boilerplate(docs, empty):
    sites = defaultdict(set)
    for row in ROWS:
        for line in (row[1] or "").split("\n"):
            if split(line):
                sites[tuple(split(line))].add(row[3])
    for bound in (2, 3):
        expected = brute_lines(lambda i, k, line: len(sites.get(tuple(split(line)), ())) >= bound)
        assert tuples(lines.remove_boilerplate(docs, bound), *COLUMNS) == expected
    assert lines.remove_boilerplate(empty).count() == 0


def test_spread_near_the_bound(spark):
    rows = spark.range(0, 4000).select("id", F.lit(1).cast("long").alias("d1"), (F.col("id") % 4).alias("d2"), (F.col("id") / 4).cast("int").cast("string").alias("source"))
    rows = rows.filter("d2 <> 1 or source <> '0'")
    got = {r["d2"] for r in lines.boilerplate(rows, 1000).collect()}
    assert got == {0, 2, 3}


def brute_repeats(rows, min_run):
    """Rows in the order of ids that differ; units by a plain scan of the text."""
    out, seen = {}, set()
    for doc_id, text in rows:
        text, parts, at = text or "", [], 0
        for k, c in enumerate(text):
            if c == "\n" or (c in " \t\x0b\x0c\r" and k and text[k - 1] in ".!?"):
                parts.append((at, k + 1))
                at = k + 1
        if at < len(text):
            parts.append((at, len(text)))
        units = [(a, b, tuple(split(text[a:b]))) for a, b in parts if split(text[a:b])]
        gone, group = [], []
        for a, b, words in [*units, (0, 0, None)]:
            if words in seen:
                group.append((a, b, len(words)))
                continue
            seen.add(words)
            if sum(n for _, _, n in group) >= min_run:
                gone += [(a, b) for a, b, _ in group]
            group = []
        seen.discard(None)
        kept, at = "", 0
        for a, b in gone:
            kept += text[at:a]
            at = b
        out[doc_id] = (len(gone), len(units), ",".join(f"{a}-{b}" for a, b in gone), hashlib.sha256((kept + text[at:]).encode()).hexdigest())
    return out


def test_repeats(spark, docs, empty):
    passage = "One sentence stands here. Is it short? Yes! But the next one of this passage has more words than the others.  It ends\there. "
    rng = random.Random(9)
    some = lambda n: " ".join(rng.choice("abcdefghijklm") * rng.randint(1, 4) for _ in range(n))
    rows = [(i, some(30) + ". " * (i % 3) + (passage.upper() if i % 4 else passage) * (1 + i % 2) + some(40) + "\nYes! No? \n\n.\n" + some(3), "x") for i in range(30)]
    rows += [(30, None, "x"), (31, "", "x"), (32, "\n \n", "x"), (33, "Yes! " * 400, "x"), (34, "é. " + passage + "é.", "x"), (35, (passage + "\n") * 8000, "x")]
    rows += [(100 + i, t, "x") for i, t in enumerate(r[1] for r in ROWS)]
    for bound in (1, 16):
        df = spark.createDataFrame(rows, "doc_id long, text string, nth string").repartition(5)
        got = {r["doc_id"]: (r["n_removed"], r["n_units"], r["removed_spans"], r["kept_sha256"]) for r in lines.remove_repeats(df, bound).collect()}
        expected = brute_repeats([r[:2] for r in rows], bound)
        assert got == expected
    assert sum(v[0] > 0 for v in expected.values()) > 25
    assert lines.remove_repeats(docs).count() == len(ROWS) and lines.remove_repeats(empty).count() == 0


def test_digests_tell_self_similar_orders_apart():
    """Thue-Morse orders of two words, or of two letters within a word, have different digests."""
    bits = [bin(k).count("1") % 2 for k in range(4096)]
    for glue in (" ", ""):
        texts = [glue.join("ab"[b] for b in bits), glue.join("ba"[b] for b in bits)]
        body = [t.encode() for t in texts]
        _, _, _, _, d1, d2, _ = lines.units_of(np.frombuffer(b"".join(body), np.uint8), np.array([0, len(body[0]), len(body[0]) + len(body[1])]))
        assert d1[0] != d1[1] and d2[0] != d2[1]


def test_quality(spark, docs, empty):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    out = quality.score_documents(rows, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (out.predicted == out.quality).mean() > 0.95
    odd = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (3, None, 0), (None, 1, 1), (9, 0, 1), (10, 1, 1), (999, 1, 1)], "doc_id long, quality int, score int")
    got = quality.score_documents(docs, odd)
    assert got.count() == len(ROWS) and got.filter("score is null or score < 0 or score > 1").count() == 0
    assert tuples(got, "doc_id", "held_out") == Counter((r[0], crc(r[0], 5) == 0) for r in ROWS)
    assert quality.score_documents(docs, odd.limit(0)).filter("score <> 0.5").count() == 0
    assert quality.score_documents(empty, odd).count() == 0
    kept = quality.accepted(docs, odd)
    assert kept.columns == docs.columns


def test_pipeline(spark):
    folder = "/root/testdata/sf0.001"
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    step = docs
    seen = [step]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, folder).cache()
        assert step.columns == docs.columns
        seen.append(step)
    first, good, distinct, clean, mixed = (x.collect() for x in seen)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rejected = {r["doc_id"] for r in first} - {r["doc_id"] for r in good}
    assert sum(labels.get(i) == 1 for i in rejected) == 0 and rejected
    sets, group = jaccard_groups([(r["doc_id"], r["text"]) for r in good])
    heads = {}
    for g, r, s in zip(group, good, sets):
        key = g if s else ("blank", r["doc_id"])
        heads[key] = min(heads.get(key, r["doc_id"]), r["doc_id"])
    assert sorted(heads.values()) == sorted(r["doc_id"] for r in distinct)
    hit = {r["doc_id"] for r in decontaminate.decontaminate(seen[2], spark.read.parquet(f"{folder}/benchmark.parquet")).filter("contaminated").collect()}
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in distinct} - hit
    assert {r["doc_id"] for r in mixed} <= {r["doc_id"] for r in clean} and max(Counter(r["doc_id"] for r in mixed).values()) <= 3
    assert Counter(r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()) == Counter(r["doc_id"] for r in mixed)
