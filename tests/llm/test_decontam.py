"""Greedy string tiling against a plain version, and leaks in any order."""

import random

import numpy as np

from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import decontam
from tidemark.llm.words import WordHashes, grams

ITEM = [f"q{i}" for i in range(40)]


def brute_tiles(doc, item, least=decontam.LEAST_MATCH):
    """Longest unmarked common run first; of equally long ones the first in the item, then in the text."""
    in_doc, in_item, out = set(), set(), []
    while True:
        best = None
        for q in range(len(item)):
            for p in range(len(doc)):
                n = 0
                while q + n < len(item) and p + n < len(doc) and item[q + n] == doc[p + n] and q + n not in in_item and p + n not in in_doc:
                    n += 1
                if n >= least and (best is None or n > best[0]):
                    best = (n, p, q)
        if best is None:
            return out
        out.append(best)
        in_doc.update(range(best[1], best[1] + best[0]))
        in_item.update(range(best[2], best[2] + best[0]))


def seed_tiles(doc, item):
    h = WordHashes()
    a, b = (h.of([w.encode() for w in x]) for x in (doc, item))
    least = decontam.LEAST_MATCH
    if len(a) < least or len(b) < least:
        return []
    hits = [(p, q) for p, x in enumerate(grams(a, least)) for q, y in enumerate(grams(b, least)) if x == y]
    import numpy as np
    return decontam.tiles(np.array([p for p, _ in hits]), np.array([q for _, q in hits])) if hits else []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40), st.lists(st.sampled_from("abc"), max_size=25))
def test_tiles_match_a_plain_version(doc, item):
    assert seed_tiles(doc, item) == brute_tiles(doc, item)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def leaked(docs, bench, **kw):
    return {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, bench, **kw).collect()}


def test_leaks_whole_partial_reordered_and_disguised(spark, documents):
    rng = random.Random(10)
    filler = lambda n: [f"f{rng.randrange(10**6)}" for _ in range(n)]
    blocks = [ITEM[i:i + 8] for i in range(0, 40, 8)]
    rng.shuffle(blocks)
    rows = [(1, " ".join(filler(50) + ITEM + filler(50))), (2, " ".join(w for b in blocks for w in [*filler(30), *b])), (3, " ".join(ITEM[:22])),
            (4, " ".join(ITEM[:17] + filler(9))), (5, ", ".join(w.upper() + "!" for w in ITEM)), (6, " ".join(filler(300))),
            (7, " ".join(filler(25_000) + ITEM)), (8, " ".join(ITEM[::-1])), (9, None), (10, ""), (None, " ".join(ITEM)), (11, " ".join(ITEM)), (11, " ".join(ITEM))]
    bench = benchmark(spark, [(1, " ".join(ITEM)), (2, "too short"), (3, None), (4, ""), (5, " ".join(f"z{i}" for i in range(30)))])
    docs = documents(rows)
    assert leaked(docs, bench) == {(i, 1) for i in (1, 2, 3, 5, 7, None, 11)}
    assert leaked(docs, bench, block_seeds=20) == {(i, 1) for i in (1, 2, 3, 5, 7, None, 11)}
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [4, 6, 8, 9, 10]


def test_empty_tables(spark, documents):
    assert leaked(documents([]), benchmark(spark, [(1, " ".join(ITEM))])) == set()
    docs = documents([(1, " ".join(ITEM))])
    assert leaked(docs, benchmark(spark, [])) == set()
    assert decontam.decontaminate(docs, benchmark(spark, [])).count() == 1


def test_short_items_are_whole_lines_and_scripts_without_blanks_have_seeds(spark, documents):
    han = "模型不应该在训练数据中看到这道题目的答案"
    docs = documents([(1, "some words\nToo short!\nmore words here"), (2, "this is too short a text"), (3, "前言" + han + "结束"), (4, "完全不同的一段话没有任何重复")])
    bench = benchmark(spark, [(1, "too short"), (2, han)])
    assert leaked(docs, bench) == {(1, 1), (3, 2)}


def test_repetitive_pairs_end_soon():
    import time
    start = time.time()
    same = lambda n: decontam.Runs(np.arange(n - 3), np.full(n - 3, 7, dtype=np.uint64))
    assert decontam.tiled(same(20_000), same(2_000)) == [(2_000, 0, 0)]
    words = ["a", "b"]
    rng = random.Random(3)
    doc, item = ([words[rng.randrange(2)] for _ in range(n)] for n in (20_000, 2_000))
    h = WordHashes()
    runs = [decontam.Runs(np.arange(len(x) - 3), grams(h.of([w.encode() for w in x]), 4)) for x in (doc, item)]
    found = decontam.tiled(*runs)
    for n, p, q in found:
        assert doc[p:p + n] == item[q:q + n]
    assert sorted((n for n, _, _ in found), reverse=True) == [n for n, _, _ in found]
    assert time.time() - start < 30


def test_items_that_begin_alike_and_common_seeds(spark, documents):
    """Common seeds are not looked up, yet count for the pairs that share another one."""
    head = [f"h{i}" for i in range(6)]
    item = lambda k: head + [f"i{k}w{j}" for j in range(40)]
    bench = benchmark(spark, [(k, " ".join(item(k))) for k in range(60)])
    docs = documents([(k, " ".join(head + [f"d{k}w{j}" for j in range(30)])) for k in range(40)]
                     + [(100, " ".join(item(7)[:23])), (101, " ".join(item(8)[:22]))])
    assert leaked(docs, bench) == {(100, 7)}
    assert leaked(docs, bench, block_seeds=0) == {(100, 7)}
    sought = decontam.item_seeds(bench).groupBy("sought").count().collect()
    assert {r["sought"]: r["count"] for r in sought} == {False: 60 * 3, True: 60 * 40}


@settings(max_examples=8, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abcdef"), max_size=30), min_size=1, max_size=25), st.lists(st.lists(st.sampled_from("abcdef"), min_size=4, max_size=12), min_size=1, max_size=25))
def test_leaks_match_brute_force(spark, texts, items):
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")
    bench = benchmark(spark, [(k, " ".join(i)) for k, i in enumerate(items)])
    expected = {(k, j) for k, t in enumerate(texts) for j, i in enumerate(items)
                if 2 * sum(n for n, _, _ in brute_tiles(t, i)) >= len(i) and brute_tiles(t, i)}
    assert leaked(docs, bench) == expected


def test_columns_setting_and_staged_tables(spark, documents):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    docs = documents([(1, " ".join(ITEM)), (2, "clean words only in this one")])
    for c in ("_digest", "_doc_", "item", "_id", "_row"):
        docs = docs.withColumn(c, docs.doc_id)
    kept = decontam.decontaminate(docs, benchmark(spark, [(1, " ".join(ITEM))]))
    assert kept.columns == docs.columns and [r["_digest"] for r in kept.collect()] == [2]
    assert spark.conf.get(name) == before
