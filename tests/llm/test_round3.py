"""Packing, spelling variants and divergence of sources against brute force, with nulls, empty and long texts, ties, repeats and odd columns."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_corpus import ROWS, SCHEMA, lower

from tallyloom.llm import decontaminate, divergence, mixing, packing, quality, queries, similar, spelling

VOCABULARY = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


def spoiled_rows():
    """The common rows, texts of misspelt words, a word of 3,000 letters, and a text of a megabyte."""
    rng = random.Random(8)
    roots = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(7, 11))) for _ in range(40)] + ["aaaaaaaa", "abababab", "aaaaaaab"]

    def spoil(word):
        k, c = rng.randrange(len(word)), rng.choice("abcdeÉé")
        return rng.choice([word[:k] + word[k + 1 :], word[:k] + c + word[k:], word[:k] + c + word[k + 1 :]])

    texts = [" ".join(w if rng.random() < 0.8 else spoil(w) for w in rng.choices(roots, k=300)) for _ in range(12)]
    texts += ["x" * 3000 + " " + "x" * 2999 + " Été d'été don't <|endoftext|> 1234 ,. ²5 ́e", "lorem ipsum " * 90_000]
    return ROWS + [(100 + i, t, "en" if i % 2 else None, f"s{i % 3}", 1, "x", 7, "y") for i, t in enumerate(texts)] + [(112, texts[12], "en", "s9", 1, "x", 7, "y")]


MORE = spoiled_rows()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(MORE, SCHEMA).withColumns({c: F.lit(1) for c in ("row", "wid", "term", "n", "curve", "word")}).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    out = packing.pack_documents(docs, VOCABULARY).collect()
    expected = Counter()
    for row in MORE:
        ids = np.array([*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 2], "<u4")
        expected[row[0], ids.tobytes()] += 1
    found, sequences, held = Counter(), defaultdict(list), {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        sequences[r["sequence_id"]].append(r)
        assert len(r["ids"]) == 4 * r["length"] > 0
        key = held.pop("open", None) if r["start"] else None
        if r["start"]:  # the stream goes on with the document that the sequence before cut
            assert key is not None and key[0] == r["doc_id"] and len(key[1]) == 4 * r["start"]
        whole = (key[1] if key else b"") + bytes(r["ids"])
        if len(whole) == 4 * r["doc_tokens"]:
            found[r["doc_id"], whole] += 1
        else:
            held["open"] = (r["doc_id"], whole)
    assert found == expected and not held
    assert sorted(sequences) == list(range(len(sequences)))
    sizes = []
    for k in sorted(sequences):
        at = 0
        for r in sequences[k]:
            assert r["offset"] == at
            at += r["length"]
        sizes.append(at)
    full = [s for s in sizes if s == 4096]
    rest = sizes[len(full) :]
    assert sizes[: len(full)] == full and all(s & (s - 1) == 0 for s in rest) and rest == sorted(set(rest), reverse=True) and all(s < 4096 for s in rest)
    curve = [r["curve"] for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"]))]
    assert curve == sorted(curve)
    assert packing.pack_documents(empty, VOCABULARY).count() == 0


def test_copies_are_neighbours(spark):
    """Documents over one vocabulary lie together: far fewer changes of vocabulary along the curve than by chance."""
    rng = random.Random(4)
    words = {t: [f"{t}{k}word" for k in range(60)] for t in "abcd"}
    rows = [(i, " ".join(rng.choices(words["abcd"[i % 4]], k=80))) for i in range(400)]
    out = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY).orderBy("sequence_id", "offset").collect()
    kinds = [r["doc_id"] % 4 for r in out if not r["start"]]
    assert len(kinds) == 400 and sum(a != b for a, b in zip(kinds, kinds[1:])) < 150


def test_hilbert_key_is_a_curve():
    for bits, axes in ((3, 2), (2, 3), (2, 4)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes), axis=-1).reshape(-1, axes)
        key = packing.hilbert_key(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def brute_words(rows):
    words = Counter()
    for row in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", row[1] or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if row[0] is None else row[0]}:{run}".encode())
            words[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: n for w, n in words.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    a, b = sorted((a, b), key=len)
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def test_spelling(docs, empty):
    words = brute_words(MORE)
    near = {w: [v for v in words if is_near(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 10 * words[w] else None
    expected = Counter()
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        expected[w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None] += 1
    out = Counter(tuple(r) for r in spelling.spelling_variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect())
    assert out == expected
    assert sum(f is not None for f in form.values()) > 20 and ("x" * 3000 in words)
    assert spelling.spelling_variants(empty).count() == 0


def test_chains_of_forms(spark):
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(11)], "word string, form string")
    assert {r["root"] for r in spelling.roots_of(forms, 11).collect()} == {"w11"}


def test_choice_of_pivots():
    rng = np.random.default_rng(2)
    starts = np.sort(np.stack([rng.permutation(7)[:4] for _ in range(200)]), axis=1)
    costs = rng.integers(1, 30, starts.shape).astype(float)
    one, two = spelling.choose_pivots(starts, costs)
    for s, c, a, b in zip(starts, costs, one, two):
        assert s[b] - s[a] >= 2
        assert c[a] + c[b] == min(c[i] + c[j] for i in range(4) for j in range(i + 1, 4) if s[j] - s[i] >= 2)


def brute_divergence(rows, min_docs=10):
    counts, held, groups = defaultdict(Counter), defaultdict(Counter), set()
    for row in rows:
        lang, source = row[2] or "", row[3] or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(row[1]))
        groups.add((lang, source))
        counts[lang, source].update(terms)
        held[lang].update(set(terms))
    kept = {lang: [t for t, n in held[lang].items() if n >= min_docs] for lang, _ in groups}
    share = lambda c, lang: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[u] for u in kept[lang]) + 2 * len(kept[lang])) for t in kept[lang]}
    p = {g: share(counts[g], g[0]) for g in groups}
    f = lambda x, y: (x - y) ** 2 // (x + y)
    out = Counter()
    for lang, source in groups:
        q = share(sum((counts[g] for g in groups if g[0] == lang), Counter()), lang)
        own = p[lang, source]
        parts = {
            "pair": [(sum(f(own[t], p[lang, other][t]) for t in kept[lang]), other) for la, other in groups if la == lang and other != source],
            "term": [(f(own[t], q[t]), t) for t in kept[lang] if counts[lang, source][t] and own[t] > q[t]],
        }
        for part, items in parts.items():
            for rank, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode())), 1):
                if part == "pair" or rank <= 10:
                    out[lang, source, part, item, value, rank] += 1
    return out


@pytest.mark.parametrize("turn_bytes", [48 << 20, 2000])
def test_divergence(docs, empty, turn_bytes, monkeypatch):
    out = divergence.source_divergence(docs, turn_bytes=turn_bytes).select("lang", "source", "part", "item", "value", "rank")
    expected = brute_divergence(MORE)
    assert Counter(tuple(r) for r in out.collect()) == expected
    assert sum(k[2] == "term" for k in expected) > 20
    assert divergence.source_divergence(empty, turn_bytes=turn_bytes).count() == 0


def test_divergence_without_kept_terms(spark):
    rows = spark.createDataFrame([(1, "a b", None, "s1"), (2, None, None, None), (3, "c", None, "s2")], "doc_id long, text string, lang string, source string")
    out = {(r["source"], r["item"]): (r["value"], r["rank"]) for r in divergence.source_divergence(rows).collect()}
    assert out == {("s1", ""): (0, 1), ("s1", "s2"): (0, 2), ("", "s1"): (0, 1), ("", "s2"): (0, 2), ("s2", ""): (0, 1), ("s2", "s1"): (0, 2)}


def test_perfect_hash():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 50, 3000):
        hashes = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        shift = divergence.build_hash(hashes)
        slots = divergence.placed(hashes, len(hashes), shift[divergence.bucket_of(hashes, len(shift))])
        assert sorted(slots) == list(range(len(hashes)))


def test_stored_keys_decide():
    """Words that are not stored are not found, whatever slot their hash names; languages are apart."""
    terms = [f"term{k}" for k in range(500)] + ["", "é" * 9, "x" * 100]
    table = pa.table({"lang": ["en"] * len(terms), "term": terms})
    dealt = pa.Table.from_batches(divergence._shard_hashes(1, 1)(iter(table.to_batches())))
    built = divergence._built((pa.scalar(0, pa.int32()),), dealt)
    hashes = divergence.Hashes(divergence.Hashes.arrays(built.drop(["whole", "bytes"]), 1, 1))
    asked = [*terms, "term500", "x" * 99, "x" * 101, "é" * 8 + "e"]
    data, at = divergence.utf8_of(pa.array(asked))
    slots = hashes.find(data, at[:-1], at[1:], np.zeros(len(asked), np.int64))
    assert sorted(slots[: len(terms)]) == list(range(len(terms))) and (slots[len(terms) :] == -1).all()
    assert (hashes.find(data, at[:-1], at[1:], np.full(len(asked), -1)) == -1).all()


def test_totals_beyond_64_bits_of_product():
    counts, totals = np.array([0, 7, 10**14, 9 * 10**14]), np.array([9 * 10**14] * 4)
    assert divergence.shares(counts, totals, 1000).tolist() == [1 + 10**9 * (int(c) + 2) // (9 * 10**14 + 2000) for c in counts]


def test_registered():
    assert {"op11_packing", "op12_spelling", "op13_divergence"} <= set(queries.QUERIES)


def test_names_of_the_operators_own_columns(spark):
    """Columns that are called like the operators' helpers come through the stages as they are."""
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 0), (4, 1)], "doc_id long, quality int")
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    names = ["__k1", "__k2", "__K1_", "__score", "__times", "__copy", "row", "times"]
    rows = [(i, f"text number {i} of a few words that differ {'x' * i}", f"s{i % 2}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit(c) for c in names})
    for stage in (lambda d: quality.accepted(d, labels), similar.one_of_each, lambda d: decontaminate.clean_documents(d, bench), mixing.mixed_corpus):
        out = stage(docs)
        assert out.columns == docs.columns
        assert out.count() > 0 and out.filter("__k1 <> '__k1' OR __score <> '__score'").count() == 0
