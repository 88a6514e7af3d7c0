"""Reading one increment of a job's source: rows above the cursor, at most a batch.

A source is SQL text with the named parameters ``:last_row_id`` and
``:batch_size`` (run through ``spark.sql(text, args=…)``, so the parameters stay
literals Catalyst can push into the scan), or the name of a registered extract
function ``fn(spark, params) -> DataFrame`` (the "stored procedure" kind), or a
plain callable.  Either way the result is a lazy DataFrame whose first column is
the integer key.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.extract import EXTRACTS

KIND_TEXT, KIND_PROCEDURE, KIND_CALLABLE = "text", "procedure", "callable"


@dataclass(frozen=True)
class Source:
    kind: str
    text: str = ""
    name: str = ""
    fn: Callable[[SparkSession, dict], DataFrame] | None = None
    params: dict = field(default_factory=dict)


def read_increment(spark: SparkSession, source: Source, cursor: int, batch_size: int | None = None) -> DataFrame:
    """The source's rows with key > ``cursor`` (and at most ``batch_size`` when the
    source applies the batch itself, as the SQL contract does)."""
    args = dict(source.params, last_row_id=int(cursor))
    if batch_size is not None:
        args["batch_size"] = int(batch_size)
    if source.kind == KIND_TEXT:
        used = {k: v for k, v in args.items() if f":{k}" in source.text}
        return spark.sql(source.text, args=used)
    if source.kind == KIND_PROCEDURE:
        if source.name not in EXTRACTS:
            raise KeyError(f"no registered extract named {source.name!r}")
        df = EXTRACTS[source.name](spark, args)
    elif source.kind == KIND_CALLABLE and source.fn is not None:
        df = source.fn(spark, args)
    else:
        raise ValueError(f"unknown source kind {source.kind!r}")
    return df.filter(F.col(df.columns[0]) > F.lit(int(cursor)))


def as_extract(source: Source) -> Callable[[SparkSession, dict], DataFrame]:
    """Adapter for ``JobSpec.extract``: the rows above the cursor that the runner hands over.
    SQL text that names ``:batch_size`` gets the run's cap for it (an uncapped run has none, so
    its text must do without)."""
    def fn(spark: SparkSession, params: dict) -> DataFrame:
        more = {k: v for k, v in params.items() if k not in ("last_row_id", "batch_size")}
        own = Source(source.kind, source.text, source.name, source.fn, {**source.params, **more})
        return read_increment(spark, own, params["last_row_id"], params.get("batch_size"))
    return fn


def jdbc_options(url: str, table: str, key: str, lower: int, upper: int, partitions: int,
                 fetch_size: int = 10_000, **extra) -> dict:
    """Options for a partitioned JDBC read of a source table: ``partitions`` range
    queries on ``key`` between ``lower`` and ``upper`` run in parallel on the
    executors; a later ``filter(key > cursor)`` is pushed into each query."""
    if partitions < 1 or upper < lower:
        raise ValueError("need partitions >= 1 and upper >= lower")
    opts = {"url": url, "dbtable": table, "partitionColumn": key, "lowerBound": str(lower),
            "upperBound": str(upper), "numPartitions": str(partitions), "fetchsize": str(fetch_size)}
    opts.update({k: str(v) for k, v in extra.items()})
    return opts


def jdbc_source(spark: SparkSession, cursor: int, **options) -> DataFrame:
    """A database table as a job source (the driver jar must be on the classpath)."""
    df = spark.read.format("jdbc").options(**options).load()
    return df.filter(F.col(options["partitionColumn"]) > F.lit(int(cursor)))
