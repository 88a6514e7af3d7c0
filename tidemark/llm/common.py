"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import remove_path, stage

#: A word is a run of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_open: list[list[str]] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back."""
    out, path = stage(df, df.sparkSession, name)
    if _open:
        _open[-1].append(path)
    return out


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside once the block ends; nothing lazy may read it then."""
    _open.append([])
    try:
        yield
    finally:
        for path in _open.pop():
            remove_path(spark, path)


def n_words(text: Column) -> Column:
    """Words of the whole text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def hash_bits(bits: int, *cols: Column) -> Column:
    """The top ``bits`` bits of a 64-bit hash, as a non-negative long."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 64 - bits)


def bounded_batches(spark: SparkSession, rows: int = 512) -> None:
    """Hand rows with texts to Python in batches that fit a worker's memory even if all are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """The same for what is computed (staged) inside the block; the session's setting comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: Key tables of up to this many rows (some tens of MB) may be broadcast.
BROADCAST_ROWS = 250_000


def broadcast_if_small(keys: DataFrame) -> DataFrame:
    """A staged table of a few narrow columns, marked for broadcast if counting proves it small;
    beyond that the join shuffles."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
