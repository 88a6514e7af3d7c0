"""Hard negatives against brute force: hot tiles, ties, repeated rows, odd input."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int, extra string"


def brute(rows, n_positives=5, n_negatives=10):
    good = [(i, [math.floor(256 * float(np.float32(x))) for x in v], l) for i, v, l in rows
            if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (aid, av, al) in enumerate(good):
        if aid % 10:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(av, v)), i, l) for b, (i, v, l) in enumerate(good) if b != a))
        positives = [(-s, i) for s, i, l in scored if l == al][:n_positives]
        for p, pid in positives:
            found = [(i, -s) for s, i, l in scored if l != al and 30 * p <= -100 * s <= 90 * p][:n_negatives]
            out += [(aid, pid, r + 1, i, p, s) for r, (i, s) in enumerate(found)]
    return sorted(out)


def run(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(parts)
    for name in ("uid", "tile", "block", "score"):
        df = df.withColumn(name, F.lit("y"))
    got = hardneg.hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label"))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, monkeypatch, seed):
    monkeypatch.setattr(hardneg, "TILE_ROWS", 20)
    monkeypatch.setattr(hardneg, "BLOCK_ROWS", 15)
    monkeypatch.setattr(hardneg, "LEAF_ROWS", 4)
    monkeypatch.setattr(hardneg, "NODE_LEAVES", 2)
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(4, 6))
    rows = [(i, [float(x) for x in centres[i % 4] + rng.normal(size=6) * 0.4], int(rng.integers(0, 3))) for i in range(150)]
    # A third of all rows is one vector; ties within and across labels.
    rows += [(1000 + i, [0.5, -0.5, 0.25, 1.0, 0.0, 0.75], i % 3) for i in range(75)]
    assert run(spark, rows) == brute(rows)


def test_nulls_short_vectors_and_odd_labels(spark):
    rows = [(0, [1.0, 0.5], 1), (10, [1.0], 2), (1, [0.9, 0.1], 1), (2, [0.5, 0.2], 2), (3, [0.4, 0.2], None), (4, None, 2), (5, [None, 1.0], 2),
            (6, [float("nan"), 1.0], 2), (7, [float("inf"), 1.0], 2), (None, [0.5, 0.2], 2), (20, [-1.0, -1.0], 1), (8, [], 2)]
    assert run(spark, rows) == brute(rows)


def test_no_rows_no_anchors_and_repeated_ids(spark):
    assert run(spark, []) == [] and run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    rows = [(10, [1.0, 1.0], 1), (10, [1.0, 1.0], 1), (3, [0.5, 0.5], 2)]
    assert run(spark, rows) == brute(rows) == [(10, 10, 1, 3, 131072, 65536)] * 2


def test_scores_are_exact_beyond_floating_point(spark):
    rows = [(0, [2.0 ** 20, 1.0], 1), (1, [2.0 ** 20, 1.0], 1), (2, [2.0 ** 19, 3.0], 2), (3, [2.0 ** 19, 4.0], 2)]
    assert run(spark, rows) == brute(rows)


def test_scores_beyond_64_bits_are_the_nearest_number(spark):
    most = 2 ** 63 - 1
    rows = [(0, [2.0 ** 24], 1), (1, [2.0 ** 26], 1), (2, [2.0 ** 22], 2), (3, [1e30], 2)]
    assert run(spark, rows) == [(0, 1, 1, 2, most, 2 ** 62)]


def test_boxes_bound_all_scores():
    rng = np.random.default_rng(3)
    x, a = np.floor(rng.normal(size=(200, 8)) * 300), np.floor(rng.normal(size=(20, 8)) * 300)
    low, high = hardneg.score_bounds(x.min(axis=0)[None], x.max(axis=0)[None], a)
    s = a @ x.T
    assert (s >= low).all() and (s <= high).all()
