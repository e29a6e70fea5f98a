"""Language and quality models against plain loops: a greedy parse by substring search, and a vote over all cosines."""

import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import language, quality
from test_corpus import ROWS, docs  # noqa: F401  (the fixture)


def naive_phrases(symbols, trained):
    """Longest matches one after another, anew in every chunk; a symbol that was never seen ends its phrase."""
    n = 0
    for at in range(0, len(symbols), language.CHUNK):
        part, i = symbols[at : at + language.CHUNK], 0
        n += 1
        while True:
            j = i
            while j < len(part) and part[i : j + 1] in trained:
                j += 1
            if j == len(part):
                break
            n += 1
            i = j if part[j : j + 1] in trained else j + 1
    return n


def test_language_by_substring_search(docs, monkeypatch):  # noqa: F811
    trained = []
    build = language.suffix_automaton
    monkeypatch.setattr(language, "suffix_automaton", lambda symbols: trained.append(bytes(symbols)) or build(symbols))
    model = language.train(docs)
    assert model.languages == ["en", "fr"] and len(trained) == 2
    want = []
    for row in ROWS:
        text = (row[1] or "").encode()
        if not re.search(r"[^\W\d_]", row[1] or ""):
            want.append((row[0], "und", 0.0))
            continue
        symbols = model.classes[np.frombuffer(text, np.uint8)].tobytes()
        entropy = [naive_phrases(symbols, t) * np.log2(len(t) + 1) / len(text) for t in trained]
        want.append((row[0], model.languages[int(np.argmin(entropy))], 1 / sum(2 ** (min(entropy) - e) for e in entropy)))
    assert max(len((row[1] or "").encode()) for row in ROWS) > 4 * language.CHUNK
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in language.identify(docs).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    for a, b in zip(sorted(got, key=order), sorted(want, key=order), strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9


def naive_terms(text):
    data = text.encode()
    kinds = [int(quality.BYTE_CLASSES[b]) for b in data]
    out = np.zeros(quality.TERMS)
    for a, b in zip(kinds, kinds[1:]):
        out[a * quality.CLASSES + b] += 1 / (len(data) - 1)
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    for lag in range(1, quality.LAGS + 1):
        out[quality.CLASSES**2 + lag - 1] = sum(a == b for a, b in zip(words, words[lag:])) / max(len(words), 1)
    out[-1] = (len(words) - len(set(words))) / max(len(words), 1)
    return np.sqrt(out)


def test_quality_by_all_cosines(spark):
    """More labelled texts than neighbours; where the last neighbour is tied with the next one, the vote is left out."""
    folder = "/root/testdata/sf0.001"
    rows, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = rows.unionByName(rows.limit(1).withColumns({"doc_id": F.lit(-1).cast(rows.schema["doc_id"].dataType), "text": F.lit("")}))
    model = quality.train(rows, labels)
    assert len(model.labels) > quality.NEIGHBOURS
    texts = {r["doc_id"]: r["text"] or "" for r in rows.select("doc_id", "text").collect()}

    def latent(text):
        point = (naive_terms(text) * model.weights) @ model.axes.astype(float)
        return point / max(np.linalg.norm(point), 1e-9)

    truth = {r["doc_id"]: r["quality"] for r in labels.collect() if r["quality"] is not None}
    learned = [i for i in truth if i in texts and zlib.crc32(str(i).encode()) % 5]
    assert len(learned) == len(model.labels)
    own = np.stack([latent(texts[i]) for i in learned])  # every learned vector is that of one of these texts, with its label
    best = (model.vectors.astype(float) @ own.T).max(axis=1)
    assert best.min() > 1 - 1e-5 and sum(truth[i] for i in learned) == model.labels.sum()
    compared = 0
    for r in quality.score_documents(rows, labels).collect():
        cosines = model.vectors.astype(float) @ latent(texts[r["doc_id"]])
        order = np.argsort(-cosines, kind="stable")
        last, following = cosines[order[quality.NEIGHBOURS - 1]], cosines[order[quality.NEIGHBOURS]]
        if last - following < 1e-5 and last > 0:
            continue
        votes = label_votes = 0.0
        for k in order[: quality.NEIGHBOURS]:
            vote = max(cosines[k], 0.0) ** quality.SHARPNESS
            votes, label_votes = votes + vote, label_votes + vote * model.labels[k]
        want = (label_votes + 1e-3 * model.base) / (votes + 1e-3)
        assert abs(r["score"] - want) < 1e-3 and r["predicted"] == int(r["score"] >= 0.3)
        compared += 1
    assert compared > 0.5 * len(texts)
