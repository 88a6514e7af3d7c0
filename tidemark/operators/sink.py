"""Writing extracted rows to targets.

Parquet has no multi-table transaction, so the history is the manifest of the targets: a
commit step writes its rows to one folder ``commit_id=<id>`` of the target (overwriting it, so
a retry with the same id replaces its own orphan), then appends one history row per page, with
the page's key range and the folder that holds it — that append is the commit point.  Readers
go through ``read_target``, which keeps only folders named by a ``Success`` history row that
counts (a semi join Spark turns into dynamic partition pruning).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import STATUS_SUCCESS
from .history import live

COMMIT_COL = "commit_id"


class ArityError(ValueError):
    """Source and target column counts differ."""


def check_arity(df: DataFrame, columns: Sequence[str], job: str = "") -> None:
    """Column counts must match (no Spark job: schema only)."""
    n, m = len(df.columns), len(columns)
    if n != m:
        raise ArityError(f"{job}: the extract has {n} column(s), target_columns lists {m}; they are paired by position")


def check_key(df: DataFrame, job: str = "") -> None:
    """The first source column is the key and must be an integer type (schema only)."""
    kind = df.schema[0].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"{job}: the key column {df.columns[0]!r} is {kind.simpleString()}, not an integer type")


_TEXT_TYPE = re.compile(r"(?:string|varchar|char)\((\d+)\)")


def widths(types: Sequence[tuple[str, str]]) -> dict[str, int]:
    """Declared widths of a target's text columns."""
    return {name: int(m[1]) for name, kind in types if (m := _TEXT_TYPE.fullmatch(kind.strip().lower()))}


def to_types(df: DataFrame, types: Sequence[tuple[str, str]]) -> DataFrame:
    """Cast to a target's types (a bad value fails under ANSI).  ``string(n)`` and ``char(n)``
    also fail on a longer value; listed columns that ``df`` lacks are added as NULL."""
    for name, kind in types:
        m = _TEXT_TYPE.fullmatch(kind.strip().lower())
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string" if m else kind))
        elif m:
            value = F.col(name).cast("string")
            wide = F.concat(F.lit(f"column {name}: value of "), F.length(value).cast("string"), F.lit(f" characters exceeds {m[1]}"))
            df = df.withColumn(name, F.when(F.length(value) > int(m[1]), F.raise_error(wide).cast("string")).otherwise(value))
        else:
            df = df.withColumn(name, F.col(name).cast(kind))
    return df


def to_target(df: DataFrame, columns: Sequence[str], target_schema: T.StructType | None = None) -> DataFrame:
    """Positional mapping: source column *i* becomes ``columns[i]``; names are ignored.
    With a target schema, values are cast to the target types (ANSI: a bad value fails)."""
    check_arity(df, columns)
    out = df.toDF(*columns)
    if target_schema is not None:
        types = {f.name: f.dataType for f in target_schema.fields}
        out = out.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in columns])
    return out


def with_unfilled(df: DataFrame, unfilled: Sequence[tuple[str, str]]) -> DataFrame:
    """Target columns the job never fills stay NULL (typed)."""
    for name, typ in unfilled:
        df = df.withColumn(name, F.lit(None).cast(typ))
    return df


def write_commit(df: DataFrame, location: str, commit_id: str, fmt: str = "parquet") -> None:
    """Write the rows of one commit step into its own folder, replacing what is there."""
    df.write.mode("overwrite").format(fmt).save(f"{location}/{COMMIT_COL}={commit_id}")


def committed_ids(history: DataFrame, sync_key: str | None = None, since_epoch: int = 0) -> DataFrame:
    """Folders whose rows are committed and count: not those that a finished full reload
    replaced, nor those of an unfinished one (``history.live``)."""
    h = live(history if sync_key is None else history.filter(F.col("sync_key") == sync_key))
    folder = F.coalesce("data_id", COMMIT_COL) if "data_id" in h.columns else F.col(COMMIT_COL)
    ids = h.filter((F.col("status") == STATUS_SUCCESS) & F.col(COMMIT_COL).isNotNull()).select(folder.alias(COMMIT_COL)).distinct()
    if since_epoch:
        ids = ids.filter(F.regexp_extract(COMMIT_COL, r"-e([0-9]+)-", 1).try_cast("int") >= since_epoch)
    return ids


def read_target(spark: SparkSession, location: str, history: DataFrame, sync_key: str | None = None,
                fmt: str = "parquet", since_epoch: int = 0) -> DataFrame:
    """Committed rows only: folders without a ``Success`` history row are invisible, and so
    are those that a full reload replaced (``job.full_reload``).  ``since_epoch`` also hides
    what was committed before that epoch."""
    data = spark.read.format(fmt).load(location)
    return data.join(committed_ids(history, sync_key, since_epoch), COMMIT_COL, "left_semi")


def insert_missing(rows: DataFrame, target: DataFrame, key: str, target_key: str | None = None) -> DataFrame:
    """Rows whose key is not yet in the target (dedup-on-insert)."""
    tk = target_key or key
    keys = target.select(F.col(tk).alias(key))
    return rows.join(keys, key, "left_anti")


def sent_log_batch(candidates: DataFrame, sent_log: DataFrame, key: str, batch: int) -> DataFrame:
    """Mark-on-read extract: the ``batch`` lowest keys not in the sent log.  The caller
    appends the batch keys to the log after the target commit (ack-based marking)."""
    return candidates.join(sent_log.select(key), key, "left_anti").orderBy(key).limit(batch)


def flag_batch(queue: DataFrame, batch: int, key: str = "row_id", flag: str = "sent"):
    """``UPDATE TOP (batch) … SET flag = 1 OUTPUT INSERTED.*`` made deterministic by key order.

    Returns (batch rows, queue after marking).  The batch is the ``batch`` lowest
    unsent keys; the rewrite marks keys up to the batch's highest key, so no join
    against the batch is needed."""
    unsent = queue.filter(F.col(flag) == 0)
    picked = unsent.orderBy(key).limit(batch)
    top = picked.select(F.max(key)).scalar()
    after = queue.withColumn(flag, F.when((F.col(flag) == 0) & (F.col(key) <= top), F.lit(1))
                             .otherwise(F.col(flag)))
    return picked.drop(flag), after


def unflag(queue: DataFrame, keys: DataFrame, key: str = "row_id", flag: str = "sent") -> DataFrame:
    """``SET flag = 0 WHERE key IN (…)``: re-queue the listed keys."""
    marks = keys.select(F.col(key).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    out = queue.join(marks, queue[key] == marks["_k"], "left")
    return out.withColumn(flag, F.when(F.col("_hit"), F.lit(0)).otherwise(F.col(flag))).drop("_k", "_hit")


def append_sent_log(keys: DataFrame, location: str, key: str, sent_at=None) -> None:
    """Ack-based marking: after the target commit, log the batch keys as sent."""
    _sent(keys, key, sent_at).write.mode("append").parquet(location)


def _sent(keys: DataFrame, key: str, sent_at, *more: str) -> DataFrame:
    from ..functions.scalars import ts_lit
    out = keys.select(F.col(key).alias("row_id"), *more).distinct()
    return out if sent_at is None else out.withColumn("sent_utc", ts_lit(sent_at))


def log_sent(keys: DataFrame, location: str, key: str, commit_id: str, sent_at=None) -> None:
    """The sent log of a job has one folder per commit step: logging a step twice changes nothing."""
    _sent(keys, key, sent_at).write.mode("overwrite").parquet(f"{location}/{COMMIT_COL}={commit_id}")


def unlogged_commits(committed: DataFrame, sent_log: DataFrame | None) -> DataFrame:
    """Committed folders that the sent log does not hold yet (a run died between the two)."""
    return committed if sent_log is None else committed.join(sent_log.select(COMMIT_COL).distinct(), COMMIT_COL, "left_anti")


def log_unsent(target: DataFrame, missing: DataFrame, location: str, key: str, sent_at=None) -> None:
    """Log the keys of the ``missing`` commits, each into its own folder."""
    _sent(target.join(missing, COMMIT_COL, "left_semi"), key, sent_at, COMMIT_COL).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy(COMMIT_COL).parquet(location)
