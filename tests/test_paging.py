"""Paging rules (page cut, overshoot, stop) as properties, plus multi-bucket numbering."""

import math

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import paging as P


@settings(max_examples=8, deadline=None)
@given(n=st.integers(0, 60), batch=st.integers(1, 9), cap=st.integers(1, 40))
def test_pages(spark, n, batch, cap):
    cap = max(cap, batch)
    df = spark.range(1, n + 1).select((F.col("id") * 3).alias("k"))
    paged = P.paginate(df, "k", batch, cap)
    rows = sorted((r.k, r.idx, r.page_no) for r in paged.collect())
    copied = min(n, batch * math.ceil(cap / batch))
    assert len(rows) == copied
    assert [r[1] for r in rows] == list(range(copied))
    assert [r[0] for r in rows] == [3 * i for i in range(1, copied + 1)]
    assert all(r[2] == r[1] // batch for r in rows)
    ranges = sorted(tuple(r) for r in P.page_ranges(paged, "k").collect())
    assert all(x[3] <= batch for x in ranges)
    assert all(a[2] < b[1] for a, b in zip(ranges, ranges[1:]))   # contiguous, non-overlapping


def test_duplicate_keys_share_a_page(spark):
    df = spark.createDataFrame([(k,) for k in [1, 2, 2, 3, 4, 4, 5]], "k long")
    rows = sorted((r.k, r.page_no) for r in P.paginate(df, "k", 2).collect())
    pages = {}
    for k, p in rows:
        pages.setdefault(k, set()).add(p)
    assert all(len(v) == 1 for v in pages.values())


def test_identity_is_dense_with_ties(spark):
    df = spark.createDataFrame([(k, s) for k in [5, 5, 1, 9] for s in "ab"], "k long, s string")
    got = sorted((r.ident, r.k, r.s) for r in P.assign_identity(df, "k", 10, tie_breakers=["s"]).collect())
    assert [g[0] for g in got] == list(range(10, 18))
    assert [(g[1], g[2]) for g in got] == [(1, "a"), (1, "b"), (5, "a"), (5, "a"), (5, "b"), (5, "b"),
                                          (9, "a"), (9, "b")]


@pytest.mark.parametrize("copies", [False, True])
def test_a_hot_key_is_spread_and_ranked_exactly(spark, copies):
    hot = spark.range(0, 3000).select(F.lit(500).cast("long").alias("k"), (F.lit(0).cast("long") if copies else F.col("id")).alias("v"))
    rest = spark.range(0, 3000).select((F.col("id") * 2 + 1).alias("k"), F.col("id").alias("v"))
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")       # partitions as they are with many rows
    try:
        staged, _ = P.stage_ordered(hot.unionByName(rest), "k", "hot")
    finally:
        spark.conf.set(name, before)
    # No partition holds the whole key.
    assert staged.where("k = 500").groupBy("_part").count().count() > 1
    keys = sorted(r.k for r in staged.collect())
    assert sorted((r.k, r.idx) for r in P.number_staged(staged, "k").collect()) == [(k, keys.index(k)) for k in keys]
    got = sorted(P.number_staged(staged, "k", ties="row").select("idx", "k").collect())
    assert [tuple(r) for r in got] == list(enumerate(keys))


def test_numbering_has_no_single_task_window(spark):
    df = spark.range(0, 3000).withColumnRenamed("id", "k")
    text = P.dense_index(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "SinglePartition" not in text


@settings(max_examples=6, deadline=None)
@given(hot=st.integers(0, 400), rest=st.integers(1, 300), spread=st.integers(1, 40), nulls=st.integers(0, 5), with_tie=st.booleans())
def test_strict_numbers_match_brute_force(spark, hot, rest, spread, nulls, with_tie):
    # Sort all rows by (key, tie-breaker) in Python, NULL keys first, and number 0..n-1.
    rows = [(7, i % spread) for i in range(hot)] + [(100 + 3 * i, i % 5) for i in range(rest)] + [(None, i) for i in range(nulls)]
    df = spark.createDataFrame(rows, "k long, t long")
    out = P.dense_index(df, "k", ties="row", order_by=["t"] if with_tie else None).collect()
    got = sorted((r.idx, r.k, r.t) for r in out)
    assert [g[0] for g in got] == list(range(len(rows)))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    if with_tie:
        assert [(g[1], g[2]) for g in got] == order
    else:
        assert [g[1] for g in got] == [k for k, _ in order]


def test_hot_string_keys_with_a_long_common_prefix(spark):
    words = [f"REF0000000{i % 7}" for i in range(900)] + [f"REF0000{i:05d}" for i in range(100)] + [None] * 3
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "w string, i long").repartition(3)
    order = sorted(words, key=lambda w: (w is not None, w or ""))
    assert sorted((r.idx, r.w or "") for r in P.dense_index(df, "w").collect()) == sorted((order.index(w), w or "") for w in words)
    assert [r.w for r in sorted(P.dense_index(df, "w", ties="row").collect(), key=lambda r: r.idx)] == order
