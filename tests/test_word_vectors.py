"""Word vectors trained in blocks: gradients by brute force, equal reruns, gaps, topics."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import sequences as sq
from tallyloom.operators import word_vectors as wv


def test_a_block_sums_the_pairs_of_every_window(monkeypatch):
    """Against a loop over pairs: a window drawn from 1 to 3 holds a pair d words apart in (4 - d) of 3 cases, none across documents."""
    rng = np.random.default_rng(2)
    learner = wv.Learner(np.full(30, 7), 4, 3, 1, None, (0, 0))
    learner.rows_of(np.arange(30))
    learner.model[1:] = rng.standard_normal((30, 8)) / 2
    model, seen = learner.model.copy(), []
    monkeypatch.setattr(learner, "_move", lambda rows, by, step: seen.append((rows, by.astype(np.float64))))
    words, sizes = rng.integers(0, 30, 100).astype(np.int32), np.array([40, 0, 1, 59])
    learner.learn(words, sizes, lambda done: 1.0)
    got, want = np.zeros((31, 8)), np.zeros((31, 8))
    for rows, by in seen:
        np.add.at(got, rows, by)
        far, pairs = rows[-wv.NEGATIVES :], 0
        assert len(far) == wv.NEGATIVES and (far > 0).all()
    row, doc = words + 1, np.repeat(np.arange(4), sizes)
    for i in range(100):
        pairs = 0.0
        for j in range(max(0, i - 3), min(100, i + 4)):
            if i != j and doc[i] == doc[j]:
                weight = (4 - abs(i - j)) / 3
                g = weight / (1 + np.exp(model[row[i], :4] @ model[row[j], 4:]))
                want[row[i], :4] += g * model[row[j], 4:]
                want[row[j], 4:] += g * model[row[i], :4]
                pairs += weight
        for k in far:
            g = pairs * wv.PER_PAIR / wv.NEGATIVES / (1 + np.exp(-model[row[i], :4] @ model[k, 4:]))
            want[row[i], :4] -= g * model[k, 4:]
            want[k, 4:] -= g * model[row[i], :4]
    assert len(seen) == 1 and np.allclose(got[1:], want[1:], atol=1e-4)


@pytest.fixture(scope="module")
def topics(spark):
    """Documents of two topics that share no words but a few frequent ones."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["and", "of"][x] if x < 2 else f"t{i % 2}w{x}" for x in rng.integers(0, 40, 60))) for i in range(400)]
    return spark.createDataFrame(rows, "doc_id long, text string").cache()


def vectors(docs, **how):
    return {r["doc_id"]: r["vec"] for r in sq.document_vectors(docs, "doc_id", F.split("text", " "), size=8, **how).collect()}


def test_documents_of_a_topic_are_nearer_and_reruns_agree(spark, topics, monkeypatch):
    """With several tasks and a common first round; rows laid out anew give the same vectors to the last bit."""
    monkeypatch.setattr(wv, "LEARNER_WORDS", 4000)
    monkeypatch.setattr(wv, "CORE_WORDS", 8000)
    first, again = vectors(topics), vectors(topics.repartition(5, "text"))
    assert first == again and len(first) == 400
    x = np.array([first[i] for i in range(400)])
    x /= np.linalg.norm(x, axis=1)[:, None]
    likeness = x @ x.T - 2 * np.eye(400)
    near = np.argsort(-likeness, axis=1)[:, :5]
    assert (near % 2 == np.arange(400)[:, None] % 2).mean() > 0.99
    assert vectors(topics, iterations=2) != first


def test_rows_without_text_or_known_words(spark, topics):
    odd = topics.unionByName(spark.createDataFrame([(1000, None), (1001, ""), (1002, "and never-seen")], "doc_id long, text string"))
    found = vectors(odd)
    assert len(found) == 403 and found[1000] == found[1001] == [0.0] * 8 and any(found[1002])
    rare = vectors(odd.where("doc_id >= 1000"))
    assert len(rare) == 3 and all(v == [0.0] * 8 for v in rare.values())
