"""Run-history analytics: the history table is both audit log and resume cursor.

Every per-job question ("where do I resume", "what was the last run") is one
``groupBy(sync_key)`` with ``max_by``: a declarative aggregate that Spark
combines map-side, so a job owning most of the history never lands whole in one
task.  The history location is partitioned by ``sync_key`` so a one-job lookup
prunes to that folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import col_or_lit
from ..schemas import HISTORY_COLUMNS, STATUS_FAILED, STATUS_SUCCESS
from .paging import dense_index

TAKE_DEFAULT, TAKE_MIN, TAKE_MAX = 50, 1, 500


def for_keys(history: DataFrame, keys: Sequence[str] | None) -> DataFrame:
    return history if not keys else history.filter(F.col("sync_key").isin(list(keys)))


def latest_override(overrides: DataFrame) -> DataFrame:
    """Newest override (highest epoch) per job: ``sync_key, epoch, cursor, after_run_id``."""
    w = overrides.groupBy("sync_key").agg(
        F.max_by(F.struct("epoch", "cursor", "after_run_id"), F.col("epoch")).alias("o"))
    return w.select("sync_key", "o.epoch", "o.cursor", "o.after_run_id")


def live(history: DataFrame) -> DataFrame:
    """``history`` without the pages that do not count: those that a finished full reload
    replaced, and those of a reload that has not finished (or failed).  Per job one marker
    row at most is joined back, so every reader and the cursor see a reload at the same moment."""
    if "reload" not in history.columns:
        return history
    ok = F.col("status") == STATUS_SUCCESS
    done = history.filter(ok & F.col("commit_id").isNull() & F.col("reload").isNotNull()).groupBy("sync_key").agg(
        F.max("reload").alias("_done"), F.max_by("run_id", "reload").alias("_mark"))
    counts = F.when(F.col("reload").isNull(), F.col("_mark").isNull() | (F.col("run_id") > F.col("_mark"))).otherwise(
        F.coalesce(F.col("reload") == F.col("_done"), F.lit(False)))
    return history.join(done, "sync_key", "left").filter(~ok | counts).select(*history.columns)


def next_epoch(history: DataFrame, overrides: DataFrame | None, sync_key: str) -> Column:
    """The first epoch that neither an override nor a reload of the job has used (a scalar)."""
    own = history.filter(F.col("sync_key") == sync_key)
    last = [own.select(F.coalesce(F.max("reload"), F.lit(0))).scalar() if "reload" in history.columns else F.lit(0)]
    if overrides is not None:
        last.append(overrides.filter(F.col("sync_key") == sync_key).select(F.coalesce(F.max("epoch"), F.lit(0))).scalar())
    return (F.greatest(F.lit(0), *last) + 1).cast("int")


def resume_cursor(history: DataFrame, keys: Sequence[str] | None = None,
                  overrides: DataFrame | None = None) -> DataFrame:
    """Position each job resumes after: ``MAX(source_row_id_to)`` of its ``Success``
    rows, 0 without one.  With overrides, only runs newer than the job's latest
    override count, and the override's cursor stands until such a run exists.  Pages of an
    unfinished reload, and those a finished one replaced, do not count.
    Columns ``sync_key, cursor, epoch``."""
    h = live(for_keys(history, keys))
    if "reload" not in h.columns:
        h = h.withColumn("reload", F.lit(None).cast("int"))
    success = F.col("status") == STATUS_SUCCESS
    reloaded = F.coalesce(F.max(F.when(success, F.col("reload"))), F.lit(0))
    if overrides is None:
        out = h.groupBy("sync_key").agg(
            F.coalesce(F.max(F.when(success, F.col("source_row_id_to"))), F.lit(0).cast("long"))
            .alias("cursor"),
            reloaded.alias("epoch"))
    else:
        # One override row per job.  AQE broadcasts it where it is small; a busy job's
        # skewed side is split where it is not.
        ov = latest_override(for_keys(overrides, keys))
        keyed = h.select("sync_key", "run_id", "status", "source_row_id_to", "reload").join(
            ov, "sync_key", "left")
        newer = F.col("after_run_id").isNull() | (F.col("run_id") > F.col("after_run_id"))
        seen = keyed.groupBy("sync_key").agg(
            # A reload that found no rows starts the job anew at 0.
            F.max(F.when(success & newer, F.coalesce("source_row_id_to", F.when(F.col("reload").isNotNull(), 0)))).alias("_pos"),
            F.max("cursor").alias("_ov"), F.max("epoch").alias("_epoch"), reloaded.alias("_reloaded"))
        seen = seen.select(
            "sync_key",
            F.coalesce("_pos", "_ov", F.lit(0).cast("long")).alias("cursor"),
            F.greatest(F.coalesce("_epoch", F.lit(0)), F.col("_reloaded")).alias("epoch"))
        # Jobs rewound before they ever ran: the override alone.
        unseen = ov.join(h.select("sync_key").distinct(), "sync_key", "left_anti").select(
            "sync_key", F.col("cursor").cast("long").alias("cursor"), F.col("epoch"))
        out = seen.unionByName(unseen)
    if keys:
        spark = history.sparkSession
        wanted = spark.createDataFrame([(k,) for k in keys], "sync_key string")
        out = wanted.join(out, "sync_key", "left").select(
            "sync_key", F.coalesce("cursor", F.lit(0).cast("long")).alias("cursor"),
            F.coalesce("epoch", F.lit(0)).alias("epoch"))
    return out


def rewind(history: DataFrame, overrides: DataFrame | None, sync_key: str, cursor) -> DataFrame:
    """One override row lowering where ``sync_key`` resumes: a new epoch, valid for
    runs after the current newest one.  Commit records are never deleted."""
    h = history.filter(F.col("sync_key") == sync_key)
    last_run = h.select(F.coalesce(F.max("run_id"), F.lit(0).cast("long"))).scalar()
    epoch = next_epoch(history, overrides, sync_key)
    return history.sparkSession.range(1).select(
        F.lit(sync_key).alias("sync_key"), epoch.cast("int").alias("epoch"),
        col_or_lit(cursor).cast("long").alias("cursor"), last_run.cast("long").alias("after_run_id"))


def run_start(c: str = "started_utc", unit: str = "hour") -> Column:
    """Runs are scheduled; history rows of one run share its start ``unit``."""
    return F.date_trunc(unit, F.col(c))


def run_rollup(history: DataFrame, unit: str = "hour") -> DataFrame:
    """Roll-up of page rows to one row per (job, start hour), for histories without run ids.
    Pages and rows are those committed: a failure row repeats what its run's pages already hold."""
    ok = F.col("status") == STATUS_SUCCESS
    return history.groupBy("sync_key", run_start(unit=unit).alias("run_start")).agg(
        F.count_if(ok).alias("pages"),
        F.coalesce(F.sum(F.when(ok, F.col("records_read"))), F.lit(0)).cast("long").alias("records_read"),
        F.coalesce(F.sum(F.when(ok, F.col("records_inserted"))), F.lit(0)).cast("long").alias("records_inserted"),
        F.min(F.when(ok, F.col("source_row_id_from"))).alias("source_row_id_from"),
        F.max(F.when(ok, F.col("source_row_id_to"))).alias("source_row_id_to"),
        F.sum("duration_seconds").alias("duration_seconds"),
        F.max(F.col("status") == STATUS_FAILED).alias("any_failed"))


def run_outcome(history: DataFrame, unit: str = "hour") -> DataFrame:
    """Per run: jobs seen, failed jobs, and the process exit code (1 if any failed)."""
    failed = F.col("status") == STATUS_FAILED
    return history.groupBy(run_start(unit=unit).alias("run_start")).agg(
        F.count_distinct("sync_key").alias("jobs"),
        F.count_distinct(F.when(failed, F.col("sync_key"))).alias("failed_jobs"),
        F.max(failed).alias("any_failed"),
    ).withColumn("exit_code", F.when(F.col("any_failed"), 1).otherwise(0))


def job_runs(history: DataFrame) -> DataFrame:
    """One row per (job, run): committed pages and rows (``Success`` rows only), the key range
    they cover, the run's seconds, whether the job failed in it and why."""
    # The row that ends a full reload is no page: it has no position.
    ok, failed = (F.col("status") == STATUS_SUCCESS) & F.col("source_row_id_to").isNotNull(), F.col("status") == STATUS_FAILED
    return history.groupBy("sync_key", "sync_run").agg(
        F.min("run_id").alias("first_run_id"),
        F.count_if(ok).alias("pages"),
        F.coalesce(F.sum(F.when(ok, F.col("records_read"))), F.lit(0)).cast("long").alias("records_read"),
        F.coalesce(F.sum(F.when(ok, F.col("records_inserted"))), F.lit(0)).cast("long").alias("records_inserted"),
        F.min(F.when(ok, F.col("source_row_id_from"))).alias("source_row_id_from"),
        F.max(F.when(ok, F.col("source_row_id_to"))).alias("source_row_id_to"),
        # A failure row's seconds cover the whole attempt, its committed pages included.
        F.coalesce(F.max(F.when(failed, F.col("duration_seconds"))), F.sum("duration_seconds")).alias("duration_seconds"),
        F.max(failed).alias("any_failed"),
        F.max_by("error_message", F.when(failed, F.col("run_id"))).alias("error_message"))


def sync_outcomes(history: DataFrame) -> DataFrame:
    """One row per run: jobs seen, failed jobs and their names, and the exit code."""
    return job_runs(history).groupBy("sync_run").agg(
        F.min("first_run_id").alias("first_run_id"), F.count(F.lit(1)).alias("jobs"), F.count_if("any_failed").alias("failed_jobs"),
        F.array_join(F.sort_array(F.collect_list(F.when(F.col("any_failed"), F.col("sync_key")))), ", ").alias("failed_keys"),
        F.max(F.when(F.col("any_failed"), 1).otherwise(0)).alias("exit_code"))


def copied_ranges(history: DataFrame, sync_key: str) -> DataFrame:
    """The key ranges that the job's commits cover, ``key_from`` to ``key_to``: one per commit
    step, from the key after the one its id names (a commit looked at all keys from there on),
    else, for rows without an id, from the first copied key."""
    pages = live(history).filter((F.col("sync_key") == sync_key) & (F.col("status") == STATUS_SUCCESS) & F.col("source_row_id_to").isNotNull())
    for name in ("commit_id", "data_id"):
        if name not in pages.columns:
            pages = pages.withColumn(name, F.lit(None).cast("string"))
    folder = F.coalesce("data_id", "commit_id")
    before = F.min(F.regexp_extract("commit_id", r"-c(-?[0-9]+)(?:-p[0-9]+)?$", 1).try_cast("long"))
    return pages.groupBy(F.coalesce(folder, F.concat(F.lit("#"), F.col("run_id").cast("string"))).alias("commit_id")).agg(
        F.coalesce(before + 1, F.min("source_row_id_from")).alias("key_from"), F.max("source_row_id_to").alias("key_to"))


def copied_gaps(history: DataFrame, sync_key: str, first: int = 1) -> DataFrame:
    """Key ranges from ``first`` up to the last copied key that no commit covers.  The window is
    over one row per commit step (some tens a run), not over pages or keys."""
    before = Window.orderBy("key_from", "key_to").rowsBetween(Window.unboundedPreceding, -1)
    ranges = copied_ranges(history, sync_key).withColumn("_upto", F.coalesce(F.max("key_to").over(before), F.lit(first - 1)))
    return ranges.filter(F.col("key_from") > F.col("_upto") + 1).select(
        (F.col("_upto") + 1).alias("gap_from"), (F.col("key_from") - 1).alias("gap_to"))


def latest_run(history: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Newest run per job, whatever its outcome."""
    h = for_keys(history, keys)
    w = h.groupBy("sync_key").agg(
        F.max_by(F.struct("run_id", "status", "completed_utc"), F.col("run_id")).alias("r"))
    return w.select("sync_key", "r.run_id", "r.status", "r.completed_utc")


def latest_position(history: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Newest run per job that has a position (``source_row_id_to`` not NULL)."""
    h = for_keys(history, keys).filter(F.col("source_row_id_to").isNotNull())
    w = h.groupBy("sync_key").agg(
        F.max_by(F.struct("run_id", "source_row_id_to", "target_key_to"), F.col("run_id")).alias("r"))
    return w.select("sync_key", "r.run_id", "r.source_row_id_to", "r.target_key_to")


def clamp_take(take: int | None) -> int:
    if take is None:
        return TAKE_DEFAULT
    return max(TAKE_MIN, min(TAKE_MAX, int(take)))


def recent_runs(history: DataFrame, take: int | None = TAKE_DEFAULT,
                keys: Sequence[str] | None = None) -> DataFrame:
    """The ``take`` newest runs per job (clamped to 1..500), newest first.

    ``row_number() <= take`` over ``sync_key`` plans a partial ``WindowGroupLimit``
    before the shuffle, so each map task forwards at most ``take`` rows per job."""
    n = clamp_take(take)
    w = Window.partitionBy("sync_key").orderBy(F.col("run_id").desc())
    ranked = for_keys(history, keys).withColumn("_rn", F.row_number().over(w))
    return ranked.filter(F.col("_rn") <= n).select(*HISTORY_COLUMNS)


def replay_first(history: DataFrame, n: int) -> DataFrame:
    """``INSERT … SELECT TOP (n) … ORDER BY 1``: the first ``n`` rows by the first
    column (ties broken by run id) copied as new runs with fresh, growing ids."""
    first = history.columns[0] if history.columns[0] != "run_id" else "sync_key"
    picked = history.orderBy(F.col(first), F.col("run_id")).limit(n)
    base = history.select(F.coalesce(F.max("run_id"), F.lit(0).cast("long"))).scalar()
    placed = dense_index(picked, first, out="_nth", ties="row", order_by=["run_id"])
    return placed.withColumn("run_id", base + F.col("_nth") + 1).select(*HISTORY_COLUMNS)


def migrate_duration(history: DataFrame) -> DataFrame:
    """Old ``duration_ms`` → ``duration_seconds = ms / 1000.0`` (NULL stays NULL);
    a frame that already has ``duration_seconds`` is returned unchanged."""
    cols = history.columns
    if "duration_ms" not in cols:
        return history
    out = history
    if "duration_seconds" not in cols:
        out = out.withColumn("duration_seconds", F.col("duration_ms").cast("double") / F.lit(1000.0))
    return out.drop("duration_ms")


def timeline(history: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Every run in id order: outcome, ranges, rows inserted, seconds."""
    return for_keys(history, keys).select(
        "run_id", "sync_key", "status", "source_row_id_from", "source_row_id_to",
        "target_key_from", "target_key_to", "records_inserted", "duration_seconds"
    ).orderBy("run_id")
