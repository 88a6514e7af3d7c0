"""Global row numbering and page assignment without a single-partition window.

``row_number() OVER (ORDER BY key)`` with no partition makes Spark move every row to one
task.  Here the rows are range-partitioned by the key and a hash of the row, sorted within
the partitions and written once under ``spark.checkpoint.dir``, each with its partition and
its place in it.  A row's number is its partition's offset (from one count per partition)
plus that place.

The hash (and a salt for repeated rows) is part of the range key, so a key that holds most
rows is spread over many partitions.  Any orderable key type works; NULL keys come first, at every size.  The number
of partitions is Spark's own (``spark.sql.shuffle.partitions``, coalesced by AQE), so nothing
is capped.

With ``ties="rank"`` all copies of a key get the index of its first copy (a page boundary
never splits a key); with ``ties="row"`` numbers are 0..n-1 (``order_by`` breaks ties, then
the row's hash).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

_PLACE_BITS = 33     # monotonically_increasing_id keeps the place in its low 33 bits


def stage_ordered(df: DataFrame, key: str, *name: str, order_by: list | None = None,
                  watch: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, str]:
    """``df`` written once in key order; (frame with ``_part`` and ``_place``, its path).
    ``watch`` may attach an observation to the rows that are written."""
    order = [F.col(key), *(F.col(c) if isinstance(c, str) else c for c in (order_by or []))]
    # The salt divides repeated rows, which have the same hash.
    spread = [*order, F.xxhash64(*[F.col(c) for c in df.columns]), F.col("_salt")]
    rows = df.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*spread).sortWithinPartitions(*spread).drop("_salt")
    if watch is not None:
        rows = watch(rows)
    place = F.monotonically_increasing_id()
    return stage(rows.withColumn("_part", F.spark_partition_id())
                 .withColumn("_place", place.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))), df.sparkSession, *name)


def number_staged(staged: DataFrame, key: str, out: str = "idx", ties: str = "rank") -> DataFrame:
    """Numbers for rows that ``stage_ordered`` wrote."""
    if ties not in ("rank", "row"):
        raise ValueError("ties must be 'rank' or 'row'")
    # One row per partition reaches the driver, as few as the job that wrote them had tasks.
    offsets, at = [], 0
    for r in sorted(staged.groupBy("_part").count().collect()):
        offsets.append((r["_part"], at))
        at += r["count"]
    before = staged.sparkSession.createDataFrame(offsets, "_part int, _offset long")
    rows = staged.join(F.broadcast(before), "_part").withColumn(out, F.col("_offset") + F.col("_place")).drop("_part", "_place", "_offset")
    if ties == "row":
        return rows
    # Only keys that occur more than once need another number than their own.
    again = rows.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"), F.min(out).alias("_first")).where("_n > 1")
    return rows.join(again, F.col(key).eqNullSafe(F.col("_key")), "left").withColumn(
        out, F.coalesce("_first", out)).drop("_key", "_n", "_first")


def dense_index(df: DataFrame, key: str, out: str = "idx", ties: str = "rank", order_by: list | None = None) -> DataFrame:
    """Add ``out`` = 0-based position of the row in key order (stages ``df`` in that order)."""
    return number_staged(stage_ordered(df, key, "index", order_by=order_by)[0], key, out, ties)


def cap_rows(batch: int, cap: int | None) -> int | None:
    """Rows one run copies at most: pages are read whole, so ``batch * ceil(cap / batch)``."""
    if cap is None:
        return None
    return batch * math.ceil(cap / batch)


def assign_pages(indexed: DataFrame, batch: int, cap: int | None = None, idx: str = "idx",
                 out: str = "page_no") -> DataFrame:
    """``page_no = idx div batch``; with a run cap, only rows of the pages the run reads."""
    if batch < 1:
        raise ValueError("batch must be >= 1")
    limit = cap_rows(batch, cap)
    if limit is not None:
        indexed = indexed.filter(F.col(idx) < F.lit(limit))
    return indexed.withColumn(out, F.expr(f"{idx} div {int(batch)}"))


def paginate(df: DataFrame, key: str, batch: int, cap: int | None = None) -> DataFrame:
    """F6 + F7: index by key then cut pages."""
    return assign_pages(dense_index(df, key), batch, cap)


def page_ranges(paged: DataFrame, key: str, page: str = "page_no") -> DataFrame:
    """Key range and row count per page (min/max, never first/last)."""
    return paged.groupBy(page).agg(
        F.min(key).alias("key_from"), F.max(key).alias("key_to"),
        F.count(F.lit(1)).alias("rows"))


def few_page_ranges(staged: DataFrame, key: str, batch: int, cap: int | None = None, page: str = "page_no") -> DataFrame:
    """``page_ranges`` of rows with few keys, in any order: the keys are counted first, and only
    those counts, one row per key, go through a window of one task."""
    counts = staged.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("idx", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    return assign_pages(placed, batch, cap, out=page).groupBy(page).agg(
        F.min(key).alias("key_from"), F.max(key).alias("key_to"), F.sum("rows").alias("rows"))


def lowest(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` rows with the lowest keys, in one pass: every task forwards its lowest ones.
    ``_after`` holds, in the last of them, the key of the row that would be next: if it is the
    same, copies of that key are missing."""
    place, order = F.row_number().over(Window.orderBy(key)), Window.orderBy(key)
    rows = df.orderBy(key).limit(n + 1).withColumn("_place", place).withColumn("_after", F.lead(key).over(order))
    return rows.filter(F.col("_place") <= n).withColumn("_after", F.when(F.col("_place") == n, F.col("_after"))).drop("_place")


def nth_key(df: DataFrame, key: str, n: int):
    """The ``n``-th lowest key, or the last one (None: no rows): every task keeps its ``n``
    lowest keys, so the cost beyond one scan of the key column grows with ``n`` alone."""
    return df.select(key).orderBy(key).limit(n).agg(F.max(key)).first()[0]


def key_at(indexed: DataFrame, key: str, limit: int, idx: str = "idx"):
    """Highest key among the first ``limit`` positions (None: no rows)."""
    return indexed.filter(F.col(idx) < F.lit(limit)).agg(F.max(key)).first()[0]


def assign_identity(df: DataFrame, order_by: str, start: int = 1, out: str = "ident",
                    tie_breakers: list | None = None) -> DataFrame:
    """Dense surrogate ids ``start, start+1, …`` in ``order_by`` order (an IDENTITY column)."""
    indexed = dense_index(df, order_by, out="_pos", ties="row", order_by=tie_breakers)
    return indexed.withColumn(out, F.col("_pos") + F.lit(start)).drop("_pos")
