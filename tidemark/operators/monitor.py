"""Monitoring views over the run history: status, recent failures, display rows,
failure digest.  Clock-free: ``now`` is always a parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schemas import STATUS_FAILED, STATUS_SUCCESS
from .history import for_keys, recent_runs, run_start


def sync_status(history: DataFrame, now, threshold_minutes: int = 60,
                keys: Sequence[str] | None = None) -> DataFrame:
    """Per job: newest run's status and completion (health), newest position, age and
    health flag.  Jobs without history are absent.  One aggregate for all jobs."""
    h = for_keys(history, keys)
    has_pos = F.col("source_row_id_to").isNotNull()
    agg = h.groupBy("sync_key").agg(
        F.max_by(F.struct("status", "completed_utc"), F.col("run_id")).alias("last"),
        F.max_by(F.struct("source_row_id_to", "target_key_to"),
                 F.when(has_pos, F.col("run_id"))).alias("pos"))
    return agg.select(
        "sync_key",
        F.col("pos.source_row_id_to").alias("last_row_id"),
        F.col("pos.target_key_to").alias("last_target_key"),
        F.col("last.status").alias("last_run_status"),
        F.col("last.completed_utc").alias("last_run_completed_utc"),
        S.minutes_since(F.col("last.completed_utc"), now).alias("minutes_since_last_run"),
        S.is_healthy(F.col("last.completed_utc"), F.col("last.status"), threshold_minutes, now)
        .alias("is_healthy"))


def recent_failures(history: DataFrame, now, hours: int = 24,
                    keys: Sequence[str] | None = None) -> DataFrame:
    """``Failed`` runs started within the last ``hours`` before ``now``, newest first."""
    since = F.timestamp_add("HOUR", F.lit(-int(hours)), S.ts_lit(now))
    return (for_keys(history, keys)
            .filter((F.col("status") == STATUS_FAILED) & (F.col("started_utc") > since))
            .orderBy(F.col("started_utc").desc(), F.col("run_id").desc()))


def run_display(history: DataFrame, take: int | None = 50,
                keys: Sequence[str] | None = None) -> DataFrame:
    """The run table of the dashboard as text columns."""
    runs = recent_runs(history, take, keys)
    return runs.select(
        "run_id", "sync_key", "status",
        S.range_text("source_row_id_from", "source_row_id_to").alias("source_range"),
        S.range_text("target_key_from", "target_key_to").alias("target_range"),
        S.ratio_text("records_inserted", "records_read").alias("rows_text"),
        S.seconds_text("duration_seconds").alias("duration_text"),
        S.first_line("error_message").alias("error_line"))


def status_display(status: DataFrame) -> DataFrame:
    """Status row as dashboard text: health word and age."""
    return status.select(
        "sync_key",
        F.when(F.col("is_healthy"), "Healthy").otherwise("Attention needed").alias("health_text"),
        F.coalesce(F.col("last_row_id").cast("string"), F.lit("—")).alias("last_row_text"),
        F.coalesce(F.col("last_run_status"), F.lit("—")).alias("status_text"),
        S.age_text("minutes_since_last_run").alias("age_text"))


def failure_digest(history: DataFrame, unit: str = "hour",
                   job_order: Sequence[str] | None = None) -> DataFrame:
    """One record per run with failures: failed job keys joined with ``", "`` in
    job order (configured order when given, else by name) and their count.
    ``collect_set`` keeps at most one entry per job, so the group stays small."""
    failed = history.filter(F.col("status") == STATUS_FAILED)
    if job_order:
        pos = F.array_position(F.array(*[F.lit(k) for k in job_order]), F.col("sync_key"))
    else:
        pos = F.lit(0)
    agg = failed.groupBy(run_start(unit=unit).alias("run_start")).agg(
        F.array_sort(F.collect_set(F.struct(pos.alias("p"), F.col("sync_key").alias("k")))).alias("jobs"))
    return agg.select(
        "run_start",
        F.array_join(F.transform("jobs", lambda s: s["k"]), ", ").alias("failed_jobs"),
        F.size("jobs").alias("failed_count"))


def failure_notices(history: DataFrame) -> DataFrame:
    """What a notice about a failed run lists: one row per (run, failed job) with the job's
    place among the run's failed jobs (in the order they ran), host, times, the rows its
    committed pages hold and the error, and with all failed jobs of the run in that order."""
    failed, ok = F.col("status") == STATUS_FAILED, F.col("status") == STATUS_SUCCESS
    jobs = history.groupBy("sync_run", "sync_key").agg(
        F.max_by(F.struct("run_id", "host_machine", "started_utc", "completed_utc", "error_message"), F.when(failed, F.col("run_id"))).alias("f"),
        F.coalesce(F.sum(F.when(ok, F.col("records_read"))), F.lit(0)).cast("long").alias("records_read"),
        F.coalesce(F.sum(F.when(ok, F.col("records_inserted"))), F.lit(0)).cast("long").alias("records_inserted"),
    ).filter(F.col("f").isNotNull())
    # A run has as many rows here as it has failed jobs.
    run = Window.partitionBy("sync_run").orderBy("f.run_id")
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return jobs.select(
        "sync_run", F.row_number().over(run).alias("place"), "sync_key",
        F.array_join(F.collect_list("sync_key").over(whole), ", ").alias("failed_jobs"),
        F.count(F.lit(1)).over(whole).alias("failed_count"),
        F.col("f.host_machine").alias("host_machine"), F.col("f.started_utc").alias("started_utc"),
        F.col("f.completed_utc").alias("completed_utc"), "records_read", "records_inserted",
        F.col("f.error_message").alias("error_message"))
