"""Language identification: held-out accuracy, whole texts, odd input."""

import random
import zlib

from tidemark.llm import language

SYLLABLES = {"aa": ["ko", "mi", "ta"], "bb": ["schr", "ung", "eit"], "cc": ["ção", "lha", "nh"]}


def text(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def corpus(n=300):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        lang = rng.choice(["aa", "aa", "aa", "bb", "cc"])
        rows.append((i, text(rng, lang, rng.randrange(3, 120)), lang if i % 11 else None, "s"))
    return rows


def test_held_out_accuracy_and_columns(spark, documents, folder):
    rows = corpus()
    out = language.op4_byte_cnn_language(spark, folder(documents=documents(rows)))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"]
    got = {r["doc_id"]: r for r in out.collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert {r[0] for r in held} == {i for i, r in got.items() if r["held_out"]}
    right = [got[r[0]]["lang_pred"] == r[2] for r in held if r[2]]
    assert sum(right) >= 0.97 * len(right)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_whole_texts_and_odd_input(documents):
    docs = documents(corpus())
    net = language.train(docs)
    rng = random.Random(2)
    odd = documents([(1, None), (2, ""), (3, " 12 +-!"), (None, text(rng, "bb", 50)), (5, text(rng, "aa", 5) + " " + text(rng, "cc", 20_000)),
                     (6, text(rng, "cc", 9)), (6, text(rng, "cc", 9))])
    got = sorted((r["doc_id"] or 0, r["lang_pred"], r["score"] > 0) for r in language.identify(odd, net).collect())
    assert got == [(0, "bb", True), (1, "und", False), (2, "und", False), (3, "und", False), (5, "cc", True), (6, "cc", True), (6, "cc", True)]


def test_nothing_to_learn_from(documents):
    docs = documents([(i, "some text", None, "s") for i in range(5)])
    assert {r["lang_pred"] for r in language.identify(docs, language.train(docs)).collect()} == {"und"}
    empty = documents([])
    assert language.identify(empty, language.train(empty)).collect() == []
    one = documents([(i, "some text", "xx", "s") for i in range(9)])
    assert {r["lang_pred"] for r in language.identify(one, language.train(one)).collect()} == {"xx"}


def test_tables_give_the_network_s_own_sums():
    import numpy as np
    rng = np.random.default_rng(0)
    x = rng.integers(0, 256, (40, language.WINDOW)).astype(np.uint8)
    net = language.fit(x, np.arange(40) % 3, ["a", "b", "c"], steps=3)
    e = net.embedding[x]
    pooled = [(language._unrolled(e, w) @ f + b).max(axis=1) for w, f, b in zip(language.WIDTHS, net.filters, net.biases)]
    logits = np.maximum(np.concatenate(pooled, axis=1), 0) @ net.dense + net.offset
    want = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
    assert np.abs(language.Predictor(net).log_probabilities(x) - want).max() < 1e-3
