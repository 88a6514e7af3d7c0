"""Exact top-k against all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import topk

VECTORS = "vec_id long, embedding array<float>, label int, uid string, cell string, score string"


def table(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0, "x", "x", "x") for i, v in rows], VECTORS).repartition(parts)


def brute(rows, k=5):
    import numpy as np
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, q) in enumerate(kept):
        if i % 50 == 0:
            all_scores = sorted((-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(kept) if b != a)
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(all_scores[:k])]
    return sorted(out)


def got(df):
    return sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0).collect()))


@pytest.mark.parametrize("kind", ["gauss", "clusters", "ties"])
def test_matches_all_pairs(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "ROWS_PER_PIVOT", 40)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 64)
    rng = random.Random(7)
    rows = []
    for i in range(900):
        if kind == "gauss":
            v = [rng.gauss(0, 0.3) for _ in range(8)]
        elif kind == "clusters":
            c = random.Random(i % 6)
            v = [c.gauss(0, 3) + rng.gauss(0, 0.05) for _ in range(8)]
        else:
            v = [rng.choice([0.0, 0.01, -0.01]) for _ in range(3)]
        rows.append((i, v))
    assert got(table(spark, rows)) == brute(rows)


def test_one_vector_holds_a_third_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    rng = random.Random(8)
    rows = [(i, [1.0, 2.0] if i % 3 else [rng.gauss(0, 1), rng.gauss(0, 1)]) for i in range(600)]
    assert got(table(spark, rows)) == brute(rows)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0]), (50, None), (100, [None, 1.0]), (150, [float("nan"), 1.0]), (200, [float("inf"), 0.0]), (None, [9.0, 9.0]), (1, [3.0, -1.0]),
            (2, [0.5]), (250, []), (3, [1e30, 0.0])]
    out = got(table(spark, rows))
    assert {r[0] for r in out} == {0, 250} and {r[2] for r in out} == {0, 1, 2, 3, 250}
    assert [r[2] for r in out if r[0] == 250] == [0, 1, 2, 3]


def test_few_rows_and_none(spark):
    assert got(table(spark, [(0, [1.0])])) == []
    assert got(table(spark, [(0, [1.0]), (0, [2.0])])) == [(0, 1, 0, 131072), (0, 1, 0, 131072)]
    assert got(table(spark, [])) == [] and got(table(spark, [(0, None)])) == []


def test_large_components_are_exact(spark):
    """Components beyond 31 bits, and scores beyond what floating point holds."""
    rows = [(0, [9e6, 1.0]), (1, [9e6, 2.0]), (2, [9e6 + 1, 1.0]), (3, [1.0, 9e6]), (50, [-9e6, 3.0]), (4, [2.0 ** 20, 0.01])]
    assert got(table(spark, rows)) == brute(rows)


def test_scores_beyond_64_bits_are_the_nearest_number(spark):
    out = got(table(spark, [(0, [1e12]), (1, [1e12]), (2, [-1e30]), (3, [1.0])]))
    assert out == [(0, 1, 1, 2 ** 63 - 1), (0, 2, 3, 256 * int(256 * float(__import__("numpy").float32(1e12)))), (0, 3, 2, -2 ** 63 + 1)]
