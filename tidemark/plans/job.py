"""The incremental copy job: extract → rows above the resume cursor → pages →
commit-logged writes → history.

Per run, Spark does the work in a few distributed jobs rather than one round trip per
page.  The cursor is handed to the extract, so it reaches the scan.

1. Stage.  The extract is evaluated once, into a table that cuts the lineage and keeps
   numbering and writes on one snapshot: pages are always cut from the rows that were staged.
   A capped run stages only its lowest rows (``paging.lowest``), so that what it writes follows
   the cap, not the backlog; only where copies of one key lie across the cap are they fetched
   by a second pass.  Many rows are then staged in key order (``paging.stage_ordered``).
2. Runs.  A run that catches up (``catch_up``) does what capped runs one after another would do
   with the rows there at its start: the snapshot is staged once, and its pages are dealt to
   runs of at most ``max_records`` rows, each with a ``sync_run`` of its own in the history.
   Chunks do not cross runs; a commit step may hold several.
3. Steps.  Pages form chunks of ``pages_per_commit``, chunks form steps of 1, 1, 2, 4, 8, …
   chunks.  Step by step, the rows are cast and written to a folder of the target, and the
   history rows of its pages are appended: one append is one commit point.  The rows of the next
   step are written meanwhile; its own append waits for the one before.

What a failure loses: the step it happens in, so at most about half of a run's pages; earlier
steps are committed, and the next run starts after them with a step of one chunk.  (A driver that
dies may also lose the step before, if its append was under way.)  A value that
cannot be written therefore stops a job at its own chunk, not before.  Uncommitted folders are
invisible to readers; a retry derives the same id and overwrites its leftover.

A commit id names the job, its epoch and the key before its first row; a folder bears the id
of its first commit.  With a lookback a run may copy late rows without moving the cursor, so
the id then also holds the number of pages that the job had committed before: it advances with
every commit.

A full reload runs under an epoch of its own.  Its pages count, for the cursor and for readers,
from the row on that ends it (``history.live``); a failed reload leaves everything as it was.

Single writer per job: two concurrent runs of one job would race on the same
commit id; no lock is provided.
"""

from __future__ import annotations

import datetime as dt
import re
import socket
import threading
import time
import traceback
import uuid
import zlib
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..functions.scalars import valid_status
from ..operators import history as H
from ..operators import paging as P
from ..operators import sink as K
from ..schemas import (HISTORY_SCHEMA, OVERRIDE_SCHEMA, STATUS_FAILED, STATUS_NO_NEW_DATA,
                       STATUS_SUCCESS)
from ..session import clear_stale, make_dirs, path_exists, remove_path, stage

MAX_BATCH = 100_000
MAX_RUN_RECORDS = 10_000_000
JOB_KEY = re.compile(r"[A-Za-z0-9_.]+")
# Up to this many keys are cut into pages by one task (a table of keys and counts); the rows of a
# run cap of up to this many are taken as the lowest.  More are staged in key order.
FEW_KEYS = 100_000
# Chunks that one task looks at in a row.
BUCKET = 4096
# Gaps whose key ranges go into one filter.
GAPS_AT_ONCE = 500


@dataclass(frozen=True)
class JobSpec:
    """One table to keep in sync.  ``extract(spark, params)`` returns the source rows;
    its first column is the integer key, copied to ``target_columns[0]``.  ``params`` has
    ``last_row_id`` (only greater keys are wanted) and, for a capped run, ``batch_size`` (how
    many of them); a source that uses them reads less, one that does not is cut here."""
    job_key: str
    extract: Callable[[SparkSession, dict], DataFrame]
    target_location: str
    target_columns: Sequence[str]
    batch_size: int = 100
    # None: no cap, the run drains the source.
    max_records: int | None = 1000
    pages_per_commit: int = 1
    params: dict = field(default_factory=dict)
    dedup_on_insert: bool = False
    fmt: str = "parquet"
    # Re-read keys down to ``cursor - lookback`` so rows that became eligible late
    # are caught; implies dedup-on-insert so nothing is copied twice.
    lookback: int = 0
    # Types of the target columns: (name, type) pairs, e.g. ("name1", "string(255)").  Values
    # are cast, too long strings fail the run; names beyond target_columns stay NULL.
    target_types: Sequence[tuple[str, str]] = ()
    # Folder of the log of sent keys: each committed step's keys, logged after its commit, or by
    # the next run if this one dies between the two.
    sent_log: str | None = None

    def validate(self) -> None:
        if not self.job_key or not JOB_KEY.fullmatch(self.job_key):
            raise ValueError("job_key must be letters, digits, '_' or '.'")
        if not 1 <= self.batch_size <= MAX_BATCH:
            raise ValueError(f"batch_size must be in 1..{MAX_BATCH}")
        if self.max_records is not None and not self.batch_size <= self.max_records <= MAX_RUN_RECORDS:
            raise ValueError(f"max_records must be None or in batch_size..{MAX_RUN_RECORDS}")
        if not self.target_columns or any(not c or not c.strip() for c in self.target_columns):
            raise ValueError("target_columns must be non-blank names")
        if self.pages_per_commit < 1:
            raise ValueError("pages_per_commit must be >= 1")


@dataclass(frozen=True)
class Store:
    """Where the run history (and cursor overrides) live; shared storage on a cluster."""
    history_location: str
    overrides_location: str | None = None


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def ensure_history(spark: SparkSession, store: Store) -> None:
    """Create the (empty, ``sync_key``-partitioned) history location when missing."""
    if not path_exists(spark, store.history_location):
        make_dirs(spark, store.history_location)   # readers pass the schema explicitly


def read_history(spark: SparkSession, store: Store) -> DataFrame:
    ensure_history(spark, store)
    return spark.read.schema(HISTORY_SCHEMA).parquet(store.history_location)


def read_overrides(spark: SparkSession, store: Store) -> DataFrame | None:
    if not store.overrides_location or not path_exists(spark, store.overrides_location):
        return None
    return spark.read.schema(OVERRIDE_SCHEMA).parquet(store.overrides_location)


def append_history(spark: SparkSession, store: Store, rows: list[dict]) -> None:
    """Append history rows as one small file per job partition (the commit point)."""
    if not rows:
        return
    names = [f.name for f in HISTORY_SCHEMA.fields]
    df = spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], HISTORY_SCHEMA)
    df = df.withColumn("status", F.when(valid_status("status"), F.col("status")).otherwise(
        F.raise_error(F.concat(F.lit("unknown run status "), F.col("status")))))
    df.coalesce(1).write.mode("append").partitionBy("sync_key").parquet(store.history_location)


def next_run_id(spark: SparkSession, store: Store) -> int:
    """Run ids grow with commit order: one above the current maximum."""
    v = read_history(spark, store).agg(F.max("run_id")).first()[0]
    return int(v or 0) + 1


def current_cursor(spark: SparkSession, store: Store, job_key: str) -> tuple[int, int]:
    """(cursor, epoch) for one job, re-derived from committed history."""
    hist = read_history(spark, store).filter(F.col("sync_key") == job_key)
    overrides = read_overrides(spark, store)
    if overrides is not None:
        overrides = overrides.filter(F.col("sync_key") == job_key)
    # One job's partition only (pruned by the filter); a job with no history and no
    # override has no row and starts at 0.
    row = H.resume_cursor(hist, None, overrides).first()
    return (int(row["cursor"]), int(row["epoch"])) if row is not None else (0, 0)


def committed_pages(spark: SparkSession, store: Store, job_key: str) -> int:
    """Pages the job has committed so far (one history row each)."""
    hist = read_history(spark, store)
    return hist.filter((F.col("sync_key") == job_key) & (F.col("status") == STATUS_SUCCESS)).count()


def rewind(spark: SparkSession, store: Store, job_key: str, cursor: int) -> None:
    """Lower the position ``job_key`` resumes from (re-sync).  Appends an override;
    history and committed data stay."""
    if not store.overrides_location:
        raise ValueError("store has no overrides location")
    row = H.rewind(read_history(spark, store), read_overrides(spark, store), job_key, cursor)
    row.coalesce(1).write.mode("append").parquet(store.overrides_location)


def _history_row(spec: JobSpec, run_id: int, status: str, started, completed, host: str,
                 duration: float | None, key_from=None, key_to=None, read=0, inserted=0,
                 error=None, commit_id=None, sync_run=None, reload=None) -> dict:
    return dict(run_id=run_id, sync_key=spec.job_key, started_utc=started, completed_utc=completed,
                status=status, source_row_id_from=key_from, source_row_id_to=key_to,
                target_key_from=key_from, target_key_to=key_to, records_read=int(read),
                records_inserted=int(inserted), error_message=error, host_machine=host,
                duration_seconds=duration, commit_id=commit_id, sync_run=sync_run, reload=reload)


def check_arity_only(df: DataFrame, spec: JobSpec) -> None:
    K.check_arity(df, spec.target_columns, spec.job_key)


class ChunkFailure(Exception):
    """A copy stopped part-way; ``totals`` holds what was committed before it."""

    def __init__(self, cause: BaseException, totals: dict):
        super().__init__(str(cause))
        self.cause, self.totals = cause, totals


def check_deadline(spec: JobSpec, deadline: float | None) -> None:
    if deadline is not None and time.time() > deadline:
        raise TimeoutError(f"Job {spec.job_key}: run deadline passed")


def step_of(chunk: Column) -> Column:
    """Commit step of a chunk: 0, 1, then doubling runs (2-3, 4-7, …), so that a run of any
    number of chunks takes a few history appends."""
    return F.when(chunk == 0, 0).otherwise(F.floor(F.log2(chunk)) + 1).cast("int")


def _history_frame(spec: JobSpec, ranges: DataFrame, run_id_base: int, started, completed, host: str,
                   duration: float, sync_run: str | None, data_id: str, reload: int | None, several: bool = False) -> DataFrame:
    """History rows of one step, one per page, built on the executors.  ``several``: each run
    that a page belongs to has a ``sync_run`` of its own."""
    sync_run = F.lit(sync_run).cast("string")
    if several:
        sync_run = F.concat(sync_run, F.lit("-"), F.col("run_no").cast("string"))
    return ranges.select(
        (F.lit(run_id_base) + F.col("page_no")).cast("long").alias("run_id"),
        F.lit(started).cast("timestamp_ntz").alias("started_utc"),
        F.lit(completed).cast("timestamp_ntz").alias("completed_utc"),
        F.lit(STATUS_SUCCESS).alias("status"),
        F.col("key_from").cast("long").alias("source_row_id_from"),
        F.col("key_to").cast("long").alias("source_row_id_to"),
        F.col("key_from").cast("long").alias("target_key_from"),
        F.col("key_to").cast("long").alias("target_key_to"),
        F.col("rows").cast("int").alias("records_read"),
        F.col("rows").cast("int").alias("records_inserted"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit(host).alias("host_machine"),
        F.lit(duration).cast("double").alias("duration_seconds"),
        F.col("commit_id"),
        sync_run.alias("sync_run"),
        F.lit(data_id).alias("data_id"),
        F.lit(reload).cast("int").alias("reload"),
        F.lit(spec.job_key).alias("sync_key"))


def key_before(ranges: DataFrame) -> DataFrame:
    """The last key of the chunk before each chunk (``chunk_no``, ``_before``).  Chunk numbers may
    leave some out, where the copies of one key fill more than a page.  Chunks are looked at in
    buckets, and one row per bucket gives the key before each bucket."""
    chunks = ranges.groupBy("chunk_no").agg(F.max("key_to").alias("_to"))
    chunks = chunks.withColumn("_bucket", F.expr(f"chunk_no div {BUCKET}"))
    buckets = chunks.groupBy("_bucket").agg(F.max("_to").alias("_high")).select(
        "_bucket", F.lag("_high").over(Window.orderBy("_bucket")).alias("_high"))
    inside = F.lag("_to").over(Window.partitionBy("_bucket").orderBy("chunk_no"))
    return chunks.withColumn("_inside", inside).join(buckets, "_bucket").select("chunk_no", F.coalesce("_inside", "_high").alias("_before"))


def pages_per_run(spec: JobSpec) -> int | None:
    return None if spec.max_records is None else P.cap_rows(spec.batch_size, spec.max_records) // spec.batch_size


def name_commits(spec: JobSpec, ranges: DataFrame, cursor: int, epoch: int, committed: int, tag: str, few: bool = False,
                 run_pages: int | None = None) -> DataFrame:
    """``ranges`` with each page's ``run_no``, ``chunk_no`` and ``commit_id``: the key before the
    chunk, and with a lookback the pages committed before it.  ``run_pages``: pages of each of
    several runs (None: all are one run)."""
    size = int(spec.pages_per_commit)
    if run_pages is None:
        run, chunk, first = F.lit(0), F.expr(f"page_no div {size}"), F.col("chunk_no") * F.lit(size)
    else:
        chunks = -(-run_pages // size)
        run = F.expr(f"page_no div {run_pages}")
        chunk = F.expr(f"page_no div {run_pages} * {chunks} + page_no % {run_pages} div {size}")
        first = F.col("run_no") * F.lit(run_pages) + F.col("chunk_no") % F.lit(chunks) * F.lit(size)
    ranges = ranges.withColumn("run_no", run.cast("long")).withColumn("chunk_no", chunk)
    name = [F.lit(f"{spec.job_key}-e{epoch}{tag}-c"), F.coalesce("_before", F.lit(cursor)).cast("string")]
    if spec.lookback > 0:
        name += [F.lit("-p"), (F.lit(committed) + first).cast("string")]
    if few:
        # Few pages: a window of one task, without a join that would cut them a second time.
        before = Window.orderBy("chunk_no").rangeBetween(Window.unboundedPreceding, -1)
        ranges = ranges.withColumn("_before", F.max("key_to").over(before))
    else:
        ranges = ranges.join(key_before(ranges), "chunk_no", "left")
    return ranges.withColumn(K.COMMIT_COL, F.concat(*name)).drop("_before")


@dataclass(frozen=True)
class Staged:
    """The rows of a run, written once.  ``few``: few keys, in any order; otherwise in key order."""
    rows: DataFrame
    path: str
    few: bool
    # Longest staged value of each column with a declared width.
    longest: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [c for c in self.rows.columns if c not in ("_part", "_place", "_after")]


def cut_pages(staged: Staged, key: str, batch: int, cap: int | None) -> DataFrame:
    if staged.few:
        return P.few_page_ranges(staged.rows, key, batch, cap)
    keys = staged.rows.select(key, "_part", "_place")
    return P.page_ranges(P.assign_pages(P.number_staged(keys, key), batch, cap), key)


def too_wide(spec: JobSpec, longest: dict) -> list[tuple[str, int, int]]:
    """(column, longest staged value, declared width) of every column with a too long value."""
    widths = K.widths(spec.target_types)
    return [(c, longest[c], widths[c]) for c in widths if longest.get(c) is not None and longest[c] > widths[c]]


def copy_staged(spark: SparkSession, spec: JobSpec, store: Store, staged: Staged, key: str,
                cursor: int, epoch: int, host: str,
                now: Callable[[], dt.datetime] = utc_now, deadline: float | None = None,
                before_history: Callable[[str], None] | None = None, tag: str = "",
                capped: bool = True, sync_run: str | None = None, t0: float | None = None,
                reload: int | None = None, catch_up: bool = False) -> dict:
    """Copy staged rows step by step: per step one folder of the target is written, then the
    history rows of its pages are appended, which commits them."""
    t0, started = time.monotonic() if t0 is None else t0, now()
    totals = dict(read=0, inserted=0, first=None, last=None, pages=0)
    cap = spec.max_records if capped and not catch_up else None
    run_pages = pages_per_run(spec) if catch_up else None
    paths = []

    def append(step, pages: DataFrame, part: DataFrame, base: int, took: float) -> None:
        """Commit a step whose rows are written."""
        _history_frame(spec, pages, base, started, now(), host, took / step["pages"], sync_run, step["commit_id"], reload, run_pages is not None).coalesce(
            1).sortWithinPartitions("run_id").write.mode("append").partitionBy("sync_key").parquet(store.history_location)
        totals["read"] += step["rows"]
        totals["inserted"] += step["rows"]
        totals["first"] = step["first"] if totals["first"] is None else totals["first"]
        totals["last"] = step["last"]
        totals["pages"] += step["pages"]
        if spec.sent_log is not None and reload is None:
            K.log_sent(part, spec.sent_log, key, step["commit_id"], now())
    try:
        K.check_arity(staged.rows.select(*staged.columns), spec.target_columns, spec.job_key)
        committed = committed_pages(spark, store, spec.job_key) if spec.lookback > 0 else 0
        ranges = name_commits(spec, cut_pages(staged, key, spec.batch_size, cap), cursor, epoch, committed, tag, staged.few, run_pages)
        ranges, path = stage(ranges.withColumn("step", step_of(F.col("chunk_no"))), spark, spec.job_key, store_name(store))
        paths.append(path)
        # One row per step: a few dozen at most.
        steps = sorted(ranges.groupBy("step").agg(
            F.count(F.lit(1)).alias("pages"), F.sum("rows").alias("rows"), F.min("key_from").alias("first"),
            F.max("key_to").alias("last"), F.min_by(K.COMMIT_COL, "page_no").alias("commit_id")).collect())
        if not steps:
            return totals
        base, at, appended = next_run_id(spark, store), t0, None
        # However this ends, the append that is under way ends first.
        with ThreadPoolExecutor(1) as appender:
            for step in steps:
                check_deadline(spec, deadline)
                part = staged.rows.filter(F.col(key).between(step["first"], step["last"]))
                rows = part.select(*[F.col(c).alias(t) for c, t in zip(staged.columns, spec.target_columns)])
                rows = K.to_types(rows.sortWithinPartitions(spec.target_columns[0]) if staged.few else rows, spec.target_types)
                K.write_commit(rows, spec.target_location, step["commit_id"], spec.fmt)
                if appended is not None:
                    appended.result()
                check_deadline(spec, deadline)
                if before_history is not None:
                    before_history(step["commit_id"])
                took, at = time.monotonic() - at, time.monotonic()
                pages = ranges.filter(F.col("step") == step["step"])
                appended = appender.submit(inheritable_thread_target(spark)(append), step, pages, part, base, took)
            appended.result()
        return totals
    except Exception as exc:  # noqa: BLE001
        raise ChunkFailure(exc, totals) from exc
    finally:
        for path in paths:
            remove_path(spark, path)


def log_unsent(spark: SparkSession, spec: JobSpec, store: Store, now: Callable[[], dt.datetime] = utc_now) -> None:
    """Log the commits that the sent log lacks: it is derived from the history, so a run that
    died between a commit and its log entry loses nothing."""
    if spec.sent_log is None or not path_exists(spark, spec.target_location):
        return
    log = spark.read.parquet(spec.sent_log) if path_exists(spark, spec.sent_log) else None
    history = read_history(spark, store)
    missing = K.unlogged_commits(K.committed_ids(history, spec.job_key), log)
    if not missing.isEmpty():
        target = K.read_target(spark, spec.target_location, history, spec.job_key, spec.fmt)
        K.log_unsent(target, missing, spec.sent_log, spec.target_columns[0], now())


def store_name(store: Store) -> str:
    """A short name of the store for its staging folders: stores may share job keys."""
    return f"{zlib.crc32(store.history_location.encode()):08x}"


def stage_pending(spark: SparkSession, spec: JobSpec, pending: DataFrame, key: str, store: Store,
                  capped: bool = True, deadline: float | None = None) -> Staged | None:
    """Stage the rows this run copies; None when there are none.  ``pending`` is evaluated once.
    Two exceptions, so that no capped run rewrites a large backlog: copies of one key that lie
    across a small cap, and a cap of more than ``FEW_KEYS`` rows, whose keys are staged first."""
    name = (spec.job_key, store_name(store))
    cap = P.cap_rows(spec.batch_size, spec.max_records) if capped else None
    widths = K.widths(spec.target_types)
    longest = [F.max(F.length(F.col(c).cast("string"))).alias(t) for c, t in zip(pending.columns, spec.target_columns) if t in widths]
    paths, seen = [], None

    def staged(df: DataFrame) -> DataFrame:
        check_deadline(spec, deadline)
        out, path = stage(df, spark, *name)
        paths.append(path)
        return out

    def done(rows: DataFrame, few: bool) -> Staged:
        # What was staged on the way goes; the rows' own table is the last one.
        for path in paths[:-1]:
            remove_path(spark, path)
        found = (seen or rows.agg(*longest).first().asDict()) if longest else {}
        return Staged(rows, paths[-1], few, found)
    try:
        if cap is not None and cap <= FEW_KEYS:
            rows = staged(P.lowest(pending, key, cap))
            waiting, last, after = rows.agg(F.count(F.lit(1)), F.max(key), F.max("_after")).first()
            if after is not None and after == last:
                rows = staged(pending.filter(F.col(key) <= F.lit(last)))
            few = True
        else:
            if cap is None:
                rows = staged(pending)
                seen = rows.agg(*longest, F.count(F.lit(1)).alias("_waiting")).first().asDict()
                waiting = seen.pop("_waiting")
            else:
                keys = staged(pending.select(key))
                waiting = keys.count()
                if waiting > cap:
                    ordered, path = P.stage_ordered(keys, key, *name)
                    paths.append(path)
                    check_deadline(spec, deadline)
                    last = P.key_at(P.number_staged(ordered, key), key, cap)
                    pending = pending.filter(F.col(key) <= F.lit(last))
                rows = staged(pending) if waiting else keys
            few = waiting <= FEW_KEYS
            if not few:
                check_deadline(spec, deadline)
                rows, path = P.stage_ordered(rows, key, *name)
                paths.append(path)
        if waiting:
            return done(rows, few)
    except BaseException:
        for path in paths:
            remove_path(spark, path)
        raise
    for path in paths:
        remove_path(spark, path)
    return None


def run_job(spark: SparkSession, spec: JobSpec, store: Store, deadline: float | None = None,
            now: Callable[[], dt.datetime] = utc_now, host: str | None = None,
            before_history: Callable[[str], None] | None = None, sync_run: str | None = None,
            reload: int | None = None, catch_up: bool = False) -> dict:
    """Copy the rows above the job's cursor, at most ``max_records`` (rounded up to
    whole pages), or with ``catch_up`` all that are there, as runs of so many.  Returns the run's aggregate result (not stored).  A failure is
    recorded as a ``Failed`` history row; pages committed before it have rows of their own.
    ``sync_run`` names the run that the history rows belong to; ``reload`` the epoch of a full
    reload, which starts at key 0.  The result's ``too_wide`` lists every column with a value
    beyond its declared width, known before anything is written."""
    host, sync_run = host or socket.gethostname(), sync_run or uuid.uuid4().hex
    t0, started = time.monotonic(), now()
    totals = dict(read=0, inserted=0, first=None, last=None, pages=0)
    staged, wide = None, []
    sc = spark.sparkContext
    timer = None
    if deadline is not None:
        # Jobs of this run carry a group; at the deadline the group is cancelled, so a
        # long-running stage stops instead of finishing past the run window.
        group = f"tidemark-{spec.job_key}-{uuid.uuid4().hex[:8]}"
        sc.setJobGroup(group, f"sync {spec.job_key}", interruptOnCancel=True)
        timer = threading.Timer(max(0.0, deadline - time.time()), sc.cancelJobGroup, args=(group,))
        timer.daemon = True
        timer.start()
    try:
        spec.validate()
        ensure_history(spark, store)
        # A run whose driver died left its staging table behind; one writer per job
        # means any staging folder of this job now is such a leftover.
        clear_stale(spark, "stage", spec.job_key, store_name(store))
        log_unsent(spark, spec, store, now)
        cursor, epoch = current_cursor(spark, store, spec.job_key) if reload is None else (0, reload)
        check_deadline(spec, deadline)
        low = cursor - max(0, spec.lookback)
        wanted = dict(spec.params, last_row_id=low)
        if spec.max_records is not None:
            wanted["batch_size"] = P.cap_rows(spec.batch_size, spec.max_records)
        src = spec.extract(spark, wanted)
        K.check_arity(src, spec.target_columns, spec.job_key)
        K.check_key(src, spec.job_key)
        key = src.columns[0]
        pending = src.filter(F.col(key) > F.lit(low))
        if (spec.dedup_on_insert or spec.lookback > 0) and path_exists(spark, spec.target_location):
            done = K.read_target(spark, spec.target_location, read_history(spark, store), spec.job_key, spec.fmt)
            # Only target keys above the same bound can match a pending key; the filter
            # reaches the target scan, so the anti join reads the lookback window only.
            done = done.filter(F.col(spec.target_columns[0]) > F.lit(low))
            pending = K.insert_missing(pending, done, key, spec.target_columns[0])
        staged = stage_pending(spark, spec, pending, key, store, capped=not catch_up, deadline=deadline)
        if staged is not None:
            wide = too_wide(spec, staged.longest)
            totals = copy_staged(spark, spec, store, staged, key, cursor, epoch, host, now, deadline,
                                 before_history, sync_run=sync_run, t0=t0, reload=reload, catch_up=catch_up)
        if totals["pages"] == 0:
            row = _history_row(spec, next_run_id(spark, store), STATUS_NO_NEW_DATA, started, now(), host,
                               time.monotonic() - t0, sync_run=sync_run)
            append_history(spark, store, [row])
            return dict(row, pages=0, too_wide=wide)
        return dict(_history_row(spec, 0, STATUS_SUCCESS, started, now(), host, time.monotonic() - t0,
                                 totals["first"], totals["last"], totals["read"], totals["inserted"]),
                    pages=totals["pages"], too_wide=wide)
    except Exception as exc:  # noqa: BLE001 - every failure becomes a Failed result
        if timer is not None:
            timer.cancel()
            sc.setLocalProperty("spark.jobGroup.id", None)
        if isinstance(exc, ChunkFailure):
            totals, exc = exc.totals, exc.cause
        err = "".join(traceback.format_exception_only(type(exc), exc)).strip()
        if wide:
            err += "\ntoo wide: " + ", ".join(f"{c} ({n} > {w})" for c, n, w in wide)
        row = _history_row(spec, 0, STATUS_FAILED, started, now(), host, time.monotonic() - t0,
                           totals["first"], totals["last"], totals["read"], totals["inserted"], error=err, sync_run=sync_run)
        record_failure(spark, store, row)
        return dict(row, pages=totals["pages"], too_wide=wide)
    finally:
        if timer is not None:
            timer.cancel()
            sc.setLocalProperty("spark.jobGroup.id", None)
        if staged is not None:
            remove_path(spark, staged.path)


def full_reload(spark: SparkSession, spec: JobSpec, store: Store, **kw) -> int:
    """Copy everything again from the start, in one uncapped run under a new epoch; returns it.
    The reload becomes current, for readers and the cursor, with the history row that ends it;
    the older commits stay in the log and are no longer read.  A failed reload raises and
    changes nothing: readers and the next run go on as if it had never started."""
    ensure_history(spark, store)
    history = read_history(spark, store)
    epoch = history.sparkSession.range(1).select(H.next_epoch(history, read_overrides(spark, store), spec.job_key)).first()[0]
    t0, sync_run, now = time.monotonic(), kw.pop("sync_run", None) or uuid.uuid4().hex, kw.get("now", utc_now)
    started = now()
    result = run_job(spark, replace(spec, max_records=None, lookback=0, dedup_on_insert=False), store, reload=epoch, sync_run=sync_run, **kw)
    if result["status"] == STATUS_FAILED:
        raise RuntimeError(result["error_message"])
    append_history(spark, store, [_history_row(spec, next_run_id(spark, store), STATUS_SUCCESS, started, now(), result["host_machine"],
                                               time.monotonic() - t0, sync_run=sync_run, reload=epoch)])
    log_unsent(spark, spec, store, now)
    return epoch


def repair_gaps(spark: SparkSession, spec: JobSpec, store: Store, ranges: Sequence[tuple[int, int]] | None = None, **kw) -> dict:
    """Copy the rows that the target lacks in key ranges below the cursor: those that no commit
    covers (``history.copied_gaps``), or the given ``ranges`` (both ends included).  Commits with
    the usual steps; the cursor stays where it is, as it is the highest committed position.
    One row per gap reaches the driver; gaps are repaired ``GAPS_AT_ONCE`` at a time."""
    ensure_history(spark, store)
    history = read_history(spark, store)
    cursor, epoch = current_cursor(spark, store, spec.job_key)
    if ranges is None:
        ranges = [(r["gap_from"], r["gap_to"]) for r in H.copied_gaps(history, spec.job_key).orderBy("gap_from").collect()]
    ranges = [(lo, min(hi, cursor)) for lo, hi in ranges if lo <= min(hi, cursor)]
    host, sync_run, now = kw.get("host") or socket.gethostname(), kw.get("sync_run") or uuid.uuid4().hex, kw.get("now", utc_now)
    t0, started = time.monotonic(), now()
    totals = dict(read=0, inserted=0, first=None, last=None, pages=0)
    try:
        for i in range(0, len(ranges), GAPS_AT_ONCE):
            some = ranges[i:i + GAPS_AT_ONCE]
            low = min(lo for lo, _ in some) - 1
            src = spec.extract(spark, dict(spec.params, last_row_id=low))
            K.check_arity(src, spec.target_columns, spec.job_key)
            K.check_key(src, spec.job_key)
            key = src.columns[0]
            wanted = F.lit(False)
            for lo, hi in some:
                wanted = wanted | F.col(key).between(lo, hi)
            rows = src.filter(wanted)
            if path_exists(spark, spec.target_location):
                done = K.read_target(spark, spec.target_location, read_history(spark, store), spec.job_key, spec.fmt)
                rows = K.insert_missing(rows, done.filter(F.col(spec.target_columns[0]) > F.lit(low)), key, spec.target_columns[0])
            staged = stage_pending(spark, spec, rows, key, store, capped=False)
            if staged is None:
                continue
            try:
                # The pages committed before make the ids of this repair its own.
                tag = f"-g{committed_pages(spark, store, spec.job_key)}"
                got = copy_staged(spark, spec, store, staged, key, low, epoch, host, now, capped=False, tag=tag, sync_run=sync_run,
                                  before_history=kw.get("before_history"))
            except ChunkFailure as exc:
                totals = {**exc.totals, "read": totals["read"] + exc.totals["read"], "inserted": totals["inserted"] + exc.totals["inserted"]}
                raise exc.cause
            finally:
                remove_path(spark, staged.path)
            totals = dict(read=totals["read"] + got["read"], inserted=totals["inserted"] + got["inserted"],
                          first=got["first"] if totals["first"] is None else totals["first"], last=got["last"], pages=totals["pages"] + got["pages"])
    except Exception as exc:  # noqa: BLE001 - recorded, then raised
        err = "".join(traceback.format_exception_only(type(exc), exc)).strip()
        record_failure(spark, store, _history_row(spec, 0, STATUS_FAILED, started, now(), host, time.monotonic() - t0, totals["first"],
                                                  totals["last"], totals["read"], totals["inserted"], error=err, sync_run=sync_run))
        raise
    log_unsent(spark, spec, store, now)
    return totals


def record_failure(spark: SparkSession, store: Store, row: dict) -> None:
    """Best effort: the failure row is written outside any data commit; its own
    error is swallowed so it cannot hide the original one."""
    try:
        ensure_history(spark, store)
        append_history(spark, store, [dict(row, run_id=next_run_id(spark, store))])
    except Exception:  # noqa: BLE001
        pass


RESULT_COLUMNS = ["sync_key", "status", "started_utc", "completed_utc", "source_row_id_from",
                  "source_row_id_to", "records_read", "records_inserted", "pages", "error_message",
                  "duration_seconds"]


def run_jobs(spark: SparkSession, specs: Sequence[JobSpec], store: Store, deadline_seconds: float | None = None,
             now: Callable[[], dt.datetime] = utc_now, before_history: Callable[[str], None] | None = None,
             catch_up: bool = False) -> list[dict]:
    """The results of ``sync_tables``, as ``run_job`` gives them."""
    deadline, sync_run = time.time() + deadline_seconds if deadline_seconds else None, uuid.uuid4().hex
    return [run_job(spark, s, store, deadline, now, before_history=before_history, sync_run=sync_run, catch_up=catch_up) for s in specs]


def sync_tables(spark: SparkSession, specs: Sequence[JobSpec], store: Store,
                deadline_seconds: float | None = None, now: Callable[[], dt.datetime] = utc_now,
                before_history: Callable[[str], None] | None = None, catch_up: bool = False) -> DataFrame:
    """Run every job in order; one failing job does not stop the others.  The deadline
    is checked before each step.  All history rows of the jobs carry the same ``sync_run``.
    With ``catch_up`` every job makes as many capped runs as its waiting rows need (run ``k`` of
    all jobs has the ``sync_run`` with the suffix ``-k``).  Returns one result row per job."""
    results = run_jobs(spark, specs, store, deadline_seconds, now, before_history, catch_up)
    schema = ("sync_key string, status string, started_utc timestamp_ntz, completed_utc timestamp_ntz, "
              "source_row_id_from long, source_row_id_to long, records_read int, records_inserted int, "
              "pages int, error_message string, duration_seconds double")
    return spark.createDataFrame([tuple(r[c] for c in RESULT_COLUMNS) for r in results], schema)


def exit_code(results: DataFrame) -> int:
    """1 when any job of the run failed."""
    return 1 if results.filter(F.col("status") == STATUS_FAILED).limit(1).count() else 0
