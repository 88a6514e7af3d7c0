"""Sharding by histogram sort."""

import zlib

import pytest

from tidemark.llm import sharding


def shards(df, **kw):
    return [r.asDict() for r in sharding.shard_documents(df, **kw).collect()]


def check(rows, n):
    """Near equal bytes, and gapless slots."""
    size = {s: 0 for s in range(n)}
    slots = {s: [] for s in range(n)}
    for r in rows:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    for s in slots:
        assert sorted(slots[s]) == list(range(len(slots[s])))
    return size


def test_shards_are_near_equal_and_hold_every_row(documents):
    rows = [(i, f"text {i} " * (i % 17 + 1)) for i in range(4000)]
    got = shards(documents(rows))
    size = check(got, 8)
    want = sum(size.values()) / 8
    assert max(abs(v - want) for v in size.values()) <= 0.02 * want
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(by_id) == 4000
    for i, t in rows:
        assert by_id[i]["size"] == len(t.encode()) + 1 and by_id[i]["text_crc32"] == zlib.crc32(t.encode())


def test_a_text_that_holds_a_third_of_all_rows_is_split(documents):
    rows = [(i, "the same text" if i % 3 else f"another text {i}") for i in range(6000)]
    size = check(shards(documents(rows)), 8)
    want = sum(size.values()) / 8
    assert max(abs(v - want) for v in size.values()) <= 0.02 * want


def test_repeated_rows_of_one_id_are_split_too(documents):
    size = check(shards(documents([(7, "all alike")] * 4000)), 8)
    want = sum(size.values()) / 8
    assert max(abs(v - want) for v in size.values()) <= 0.05 * want


def test_small_groups_of_copies_stay_together(documents):
    got = shards(documents([(i, f"text {i // 4}") for i in range(4000)]))
    where = {}
    for r in got:
        where.setdefault(r["doc_id"] // 4, set()).add(r["shard"])
    assert all(len(s) == 1 for s in where.values())


def test_nulls_empty_and_very_long_texts(documents):
    got = shards(documents([(None, None), (1, None), (2, ""), (3, "é" * 200_000), (3, "é")]))
    check(got, 8)
    assert sorted((r["doc_id"] or 0, r["size"]) for r in got) == [(0, 1), (1, 1), (2, 1), (3, 3), (3, 400_001)]
    assert {r["text_crc32"] for r in got if r["doc_id"] in (None, 1)} == {None}


def test_no_rows(documents):
    assert shards(documents([])) == []


@pytest.mark.parametrize("n", [1, 3])
def test_other_numbers_of_shards(documents, n):
    check(shards(documents([(i, "x" * (i % 50)) for i in range(1000)]), n_shards=n), n)


def test_query_columns(spark, documents, folder):
    out = sharding.op1_histogram_sort_shards(spark, folder(documents=documents([(1, "a"), (2, None)])))
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert out.count() == 2


def test_shards_and_slots_follow_a_full_sort(documents, monkeypatch):
    from pyspark.sql import functions as F

    from tidemark.llm.common import hash_bits
    docs = documents([(i, f"text {i % 700} " * (i % 7 + 1)) for i in range(3000)] + [(None, "one text")] * 300)
    keys = {(r["doc_id"], r["crc"]): (r["t"], r["d"]) for r in docs.select(
        "doc_id", F.crc32(F.col("text").cast("binary")).alias("crc"), hash_bits(38, F.col("text")).alias("t"),
        hash_bits(13, F.col("doc_id")).alias("d")).collect()}

    def ordered():
        got = sorted(shards(docs), key=lambda r: (r["shard"], r["slot"]))
        check(got, 8)
        # Copies of a row differ in nothing but their place, so the order of the keys is all there is.
        order = [keys[r["doc_id"], r["text_crc32"]] for r in got]
        assert order == sorted(order) and len(order) == 3300
        return [(r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in got]
    whole = ordered()
    monkeypatch.setattr(sharding, "MOST_LEAF_ROWS", 20)
    finer = ordered()
    assert sorted(x[:2] for x in finer if x[0]) == sorted(x[:2] for x in whole if x[0])
