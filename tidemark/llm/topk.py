"""Exact top-k search by a Voronoi kNN join.

Components are turned into integers floor(256 x); the score is the integer inner product.
Pivots, a bounded sample of the vectors, divide all vectors into cells (nearest pivot).  A
cell's summary (rows, greatest distance to its pivot) bounds every score in it from above:
q.x <= q.p + |q| * radius.  A query's k-th best score against the pivots, which are rows
themselves, bounds its result from below.  A query is sent only to the cells whose upper
bound reaches that.  Cells are solved in blocks of rows (a cell may hold most rows): a block's
rows are read first, then the queries that need it stream by in batches, each one matrix product.
No row is copied for the queries, and the blocks' best are merged per query.

Nulls and odd input: vectors that are null or hold null or non-finite components, and rows
without an id, take no part; shorter vectors count as padded with zeros; scores are exact
up to 64 bits, beyond which they count as the nearest number of 64 bits; repeated ids are rows of their own, as queries too; ties go to the
smaller id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table

#: One pivot for so many rows, at least 8 and at most 512 of them.
ROWS_PER_PIVOT, MOST_PIVOTS = 4096, 512
#: Larger components count as this: every score with them is beyond 64 bits, or 0.
LARGEST = 2.0 ** 300
#: The least score stands for none.
LONG = np.iinfo(np.int64)
#: Rows that are solved at once.
BLOCK_ROWS = 8192


def _quantised(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch["embedding"]:
                x = np.array([np.nan if c is None else c for c in v.as_py()], dtype=np.float64) if v.is_valid else np.array([np.nan])
                if not np.isfinite(x).all():
                    out.append(None)
                    continue
                # float64 holds floor(256 x) exactly: a shift of the exponent, then a whole number.
                q = np.zeros(dims, dtype="<f8")
                q[:len(x)] = np.floor(256 * np.clip(x, -LARGEST, LARGEST))
                out.append(q.tobytes())
            whole = pa.RecordBatch.from_arrays([batch["uid"], batch["vec_id"], batch["q"], pa.array(out, pa.binary())], names=["uid", "vec_id", "q", "vec"])
            yield whole.filter(whole["vec"].is_valid())
    return run


def _matrix(vecs, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(vecs), dtype="<f8").reshape(-1, dims)


def _whole(a: np.ndarray) -> np.ndarray:
    return np.array([int(x) for x in a.ravel()], dtype=object).reshape(a.shape)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in floating point where that is exact, else in Python's
    integers; beyond 64 bits the nearest number of 64 bits."""
    most = max(1.0, np.abs(a).max(initial=0)) * max(1.0, np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    return np.clip(_whole(a) @ _whole(b).T, LONG.min + 1, LONG.max).astype(np.int64)


def _cells(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = _matrix(batch["vec"].to_pylist(), pivots.shape[1])
                square = (x * x).sum(axis=1)[:, None] - 2 * (x @ pivots.T) + (pivots * pivots).sum(axis=1)
                cell = square.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch["uid"], batch["vec_id"], batch["q"], batch["vec"], pa.array(cell, pa.int32()),
                     pa.array(np.sqrt(np.maximum(0, square[np.arange(len(x)), cell])), pa.float64())], names=["uid", "vec_id", "q", "vec", "cell", "far"])
    return run


def _needed(pivots: np.ndarray, pivot_uids: np.ndarray, radius: np.ndarray, k: int):
    """The cells that a query must see, and the score its result is known to reach."""
    norms = np.sqrt((pivots * pivots).sum(axis=1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            q = _matrix(batch["vec"].to_pylist(), pivots.shape[1])
            scores = _products(q, pivots)
            own = batch["uid"].to_numpy()[:, None] == pivot_uids
            known = np.sort(np.where(own, np.iinfo(np.int64).min, scores), axis=1)
            floor = known[:, -k] if known.shape[1] >= k else np.full(len(q), np.iinfo(np.int64).min)
            length = np.sqrt((q * q).sum(axis=1))[:, None]
            # Rounding in the floating point bound is far below this margin.
            upper = scores + length * radius + 1 + 1e-9 * length * norms
            cells = [np.flatnonzero(row).tolist() for row in upper >= floor[:, None]]
            yield pa.RecordBatch.from_arrays([batch["uid"], batch["vec_id"], batch["vec"], pa.array(floor), pa.array(cells, pa.list_(pa.int32()))],
                                             names=["uid", "vec_id", "vec", "floor", "cells"])
    return run


def _solve(dims: int, k: int):
    def run(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(rows):
            return pd.DataFrame({"quid": [], "query_id": [], "uid": [], "vec_id": [], "score": []}).astype("int64")
        rows = rows.sort_values(["vec_id", "uid"], ignore_index=True)
        x, uid, vid = _matrix(rows["vec"], dims), rows["uid"].to_numpy(), rows["vec_id"].to_numpy()
        parts = []
        for i in range(0, len(queries), 256):
            part = queries.iloc[i:i + 256]
            scores = _products(_matrix(part["vec"], dims), x)
            scores[part["uid"].to_numpy()[:, None] == uid] = np.iinfo(np.int64).min
            n = min(k, len(x))
            # All rows as good as the n-th; among equals the smaller id comes first.
            edge = np.partition(scores, len(x) - n, axis=1)[:, len(x) - n]
            edge = np.maximum(np.maximum(edge, part["floor"].to_numpy()), np.iinfo(np.int64).min + 1)
            at, col = np.nonzero(scores >= edge[:, None])
            value = scores[at, col]
            order = np.lexsort((col, -value, at))
            at, col, value = at[order], col[order], value[order]
            place = np.arange(len(at)) - np.searchsorted(at, at)
            at, col, value = at[place < n], col[place < n], value[place < n]
            parts.append(pd.DataFrame({"quid": part["uid"].to_numpy()[at], "query_id": part["vec_id"].to_numpy()[at], "uid": uid[col],
                                       "vec_id": vid[col], "score": value}))
        return pd.concat(parts, ignore_index=True)
    return run


def _streamed(dims: int, k: int):
    """Blocks one after the other, each block's rows before the queries that need it."""
    solve = _solve(dims, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, rows = None, [], None
        for batch in batches:
            keys = list(zip(batch["cell"].to_pylist(), batch["block"].to_pylist(), batch["ask"].to_pylist()))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                cell, block, ask = keys[i]
                part = batch.slice(i, j - i).to_pandas()
                if key != (cell, block):
                    key, parts, rows = (cell, block), [], None
                if not ask:
                    parts.append(part)
                    continue
                if rows is None and parts:
                    rows, parts = pd.concat(parts, ignore_index=True), []
                if rows is not None:
                    yield pa.RecordBatch.from_pandas(solve(part, rows), preserve_index=False)
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's k best other rows."""
    spark = vectors.sparkSession
    slim = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("embedding"),
                                                           is_query.alias("q")).withColumn("uid", F.monotonically_increasing_id())
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = slim.agg(F.max(F.size("embedding"))).first()[0]
    if dims is None or dims < 0:
        return empty
    quant = slim.select("uid", "vec_id", F.coalesce("q", F.lit(False)).alias("q"), "embedding").mapInArrow(
        _quantised(dims), "uid long, vec_id long, q boolean, vec binary")
    base = staged(quant, "topk-rows")
    total = base.count()
    if not total:
        return empty
    order = F.xxhash64("uid", F.lit("pivot"))
    chosen = base.orderBy(order, "uid").limit(min(MOST_PIVOTS, max(8, -(-total // ROWS_PER_PIVOT)))).collect()
    pivots, pivot_uids = _matrix([r["vec"] for r in chosen], dims), np.array([r["uid"] for r in chosen])
    rows = staged(base.mapInArrow(_cells(pivots), "uid long, vec_id long, q boolean, vec binary, cell int, far double"), "topk-cells")
    radius, blocks = np.zeros(len(pivots)), np.zeros(len(pivots), dtype=int)
    for r in rows.groupBy("cell").agg(F.max("far").alias("far"), F.count(F.lit(1)).alias("n")).collect():
        radius[r["cell"]], blocks[r["cell"]] = r["far"] + 1e-6 * (1 + r["far"]), -(-r["n"] // BLOCK_ROWS)
    parts = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("cell") + 1)

    asked = staged(rows.where("q").select("uid", "vec_id", "vec").mapInArrow(
        _needed(pivots, pivot_uids, radius, k), "uid long, vec_id long, vec binary, floor long, cells array<int>"), "topk-queries")
    queries = asked.withColumn("cell", F.explode("cells")).where(parts > 0).withColumn("block", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        "cell", "block", F.lit(1).alias("ask"), "uid", "vec_id", "vec", "floor")
    data = rows.select("cell", F.pmod(F.xxhash64("uid"), parts).cast("int").alias("block"), F.lit(0).alias("ask"), "uid", "vec_id", "vec",
                       F.lit(0).cast("long").alias("floor"))
    found = data.unionByName(queries).repartition("cell", "block").sortWithinPartitions("cell", "block", "ask").mapInArrow(
        _streamed(dims, k), "quid long, query_id long, uid long, vec_id long, score long")
    best = Window.partitionBy("quid").orderBy(F.col("score").desc(), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_voronoi_top_k(spark, sf_dir: str) -> DataFrame:
    """The five best matches of every 50th vector among all others."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES = {"op7_voronoi_top_k": op7_voronoi_top_k}
ORACLE = {"op7_voronoi_top_k": """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.e, d.e) AS BIGINT) AS score
    FROM v q JOIN v d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id
), r AS (
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""}
