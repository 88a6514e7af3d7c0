"""Toxicity by a conditional random field: held-out accuracy, exact marginals, odd input."""

import itertools
import random
import zlib

import numpy as np
import pytest

from tidemark.llm import toxicity

STEMS = ["grobi", "fiesu", "blodd"]


def corpus(n=900, seed=1):
    """Toxic documents hold a few inflected words of three stems."""
    rng = random.Random(seed)
    clean = ["".join(rng.choice("aeioubdklmnrst") for _ in range(rng.randrange(2, 8))) for _ in range(800)]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randrange(3, 120))]
        toxic = int(rng.random() < 0.25)
        for _ in range(toxic * rng.randrange(1, 4)):
            words.insert(rng.randrange(len(words)), (rng.choice(STEMS) + rng.choice(["", "a", "en", "isch", f"x{rng.randrange(99)}"])).upper())
        rows.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return rows, labels


def label_table(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, documents, folder):
    rows, labels = corpus()
    out = toxicity.op8_crf_toxicity(spark, folder(documents=documents(rows), labels=label_table(spark, labels)))
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    got = {r["doc_id"]: r for r in out.collect()}
    held = {i for i in got if zlib.crc32(str(i).encode()) % 4 == 2}
    assert held == {i for i, r in got.items() if r["held_out"]}
    truth = {i: t for i, _, t in labels}
    assert sum(got[i]["predicted"] == truth[i] for i in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())
    text = dict(rows)
    for r in got.values():
        for s in r["spans"]:
            assert any(text[r["doc_id"]].lower()[s["start"]:s["end"]].startswith(x) for x in STEMS)


def test_held_out_labels_change_nothing(spark, documents):
    rows, labels = corpus(300)
    docs = documents(rows)
    other = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    a, b = (toxicity.train(docs, label_table(spark, x)) for x in (labels, other))
    assert a.weights == b.weights and a.base_rate == b.base_rate


def test_marginals_are_those_of_all_tag_sequences():
    rng = np.random.default_rng(3)
    for _ in range(20):
        n = int(rng.integers(1, 9))
        places = np.sort(rng.choice(n, size=int(rng.integers(1, n + 1)), replace=False))
        e = rng.normal(0, 2, len(places))
        field = toxicity.Field({}, float(rng.normal()), rng.normal(0, 1, (2, 2)), 0.0)
        emission = np.full(n, field.bias)
        emission[places] += e
        total, toxic = 0.0, np.zeros(n)
        for tags in itertools.product((0, 1), repeat=n):
            score = sum(field.transitions[a, b] + b * emission[i] for i, (a, b) in enumerate(zip((0, *tags), tags)))
            total += np.exp(score)
            toxic += np.exp(score) * np.array(tags)
        assert np.allclose(toxicity.marginals(places, e, n, field), (toxic / total)[places])


@pytest.mark.parametrize("n", [9000, 18000])
def test_a_lexicon_of_many_rare_terms(spark, documents, n):
    """Each term is in well under 2 % of the toxic documents; more documents must not lose any."""
    rng, terms = random.Random(5), 300
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(8))
    lexicon, common = [word() for _ in range(terms)], [word() for _ in range(400)]
    rows, truth = [], {}
    for i in range(n):
        truth[i] = int(rng.random() < 0.25)
        words = rng.choices(common, k=rng.randrange(5, 30)) + rng.choices(lexicon, k=truth[i] * rng.randrange(1, 4))
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
    docs = documents(rows)
    field = toxicity.train(docs, label_table(spark, [(i, 1, t) for i, t in truth.items()]))
    assert sum(any(field.weights.get(f) for f in toxicity.features(t)) for t in lexicon) >= 0.95 * terms
    got = {r["doc_id"]: int(r["score"] >= 0.3) for r in toxicity.score_toxicity(docs, field).collect() if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2}
    for t in (0, 1):
        of = [i for i in got if truth[i] == t]
        assert sum(got[i] == t for i in of) >= 0.97 * len(of)


def test_odd_input(spark, documents):
    rows, labels = corpus(400)
    rows += [(1000, None), (1001, ""), (None, "GROBIEN"), (1002, "wort " * 20_000 + "fiesua"), (1003, "GROBI a"), (1003, "GROBI a"), (1004, "!!!")]
    labels += [(1000, None, None), (1001, 0, 0), (None, 1, 1), (1003, 1, 1), (1003, 1, 0), (5000, 1, 1)]
    docs = documents(rows)
    field = toxicity.train(docs, label_table(spark, labels))
    got = [(r["doc_id"], r["score"] >= 0.3) for r in toxicity.score_toxicity(docs, field).collect() if r["doc_id"] is None or r["doc_id"] >= 1000]
    assert sorted(got, key=str) == sorted([(1000, False), (1001, False), (None, True), (1002, True), (1003, True), (1003, True), (1004, False)], key=str)
    kept = toxicity.drop_toxic(docs, field)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.where("doc_id >= 1000").collect()} == {1000, 1001, 1004}


def test_nothing_to_learn_from(spark, documents):
    docs = documents([(1, "a b"), (2, None)])
    for labels in ([], [(1, 1, 0)], [(9, 1, 1)], [(1, None, None)]):
        out = toxicity.score_toxicity(docs, toxicity.train(docs, label_table(spark, labels))).collect()
        assert [r["score"] for r in out] == [0.0, 0.0]
    empty = documents([])
    assert toxicity.score_toxicity(empty, toxicity.train(empty, label_table(spark, []))).collect() == []
