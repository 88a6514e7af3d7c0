"""The incremental copy as a Structured Streaming query.

The growing source (new files in a folder) is read in bounded micro-batches
(``maxFilesPerTrigger``); ``trigger(availableNow=True)`` drains what is there
and stops, which is the scheduled-run shape of the batch job.  Each micro-batch
goes through ``foreachBatch``: its rows are paged and committed with the same commit log
as ``run_job``, in whatever key order the files arrive.  ``foreachBatch`` is at-least-once;
the commit id carries the query's id and the batch id, so a replayed batch skips what it
committed before and rewrites its own uncommitted partitions.

``stream_sync_by_key`` reads the source in key order instead, in batches bounded by rows whose
offsets are keys (``key_source``): the stream's own log then says how far it has come.
"""

from __future__ import annotations

import json
import socket
import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..plans import job as J
from ..schemas import STATUS_FAILED, STATUS_SUCCESS
from ..session import remove_path
from .key_source import key_source, planned_keys


def query_id(spark: SparkSession, checkpoint_location: str) -> str:
    """The query's id from its checkpoint: it stays through restarts, and a new checkpoint has a new one."""
    line = spark.read.text(f"{checkpoint_location}/metadata").first()[0]
    return json.loads(line)["id"].replace("-", "")[:12]


def copied_upto(spark: SparkSession, store: J.Store, job_key: str, tag: str) -> int | None:
    """Highest key of a batch that an earlier attempt at it committed.  Pages of a batch are
    committed in key order, so these keys are exactly what that attempt copied."""
    hist = J.read_history(spark, store)
    own = hist.filter((F.col("sync_key") == job_key) & (F.col("status") == STATUS_SUCCESS) & F.col("commit_id").contains(f"{tag}-c"))
    return own.agg(F.max("source_row_id_to")).first()[0]


def stream_sync(spark: SparkSession, source: DataFrame, spec: J.JobSpec, store: J.Store,
                checkpoint_location: str, host: str | None = None,
                before_history: Callable[[str], None] | None = None, available_now: bool = True) -> int:
    """Run the streaming copy until the available input is drained; returns batches seen.
    A failure leaves a ``Failed`` history row and is raised.  Without ``available_now`` the
    query runs batch after batch until the source has nothing more, for sources that bound
    their batches themselves."""
    spec.validate()
    J.ensure_history(spark, store)
    host, sync_run = host or socket.gethostname(), uuid.uuid4().hex
    seen = []

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        seen.append(batch_id)
        J.check_arity_only(batch, spec)
        key = batch.columns[0]
        # The batch id is in the commit ids.  Files may arrive in any key order, so only what
        # this very batch committed before is skipped, not all keys below the cursor.
        tag = f"-s{query_id(spark, checkpoint_location)}b{batch_id}"
        _, epoch = J.current_cursor(spark, store, spec.job_key)
        done = copied_upto(spark, store, spec.job_key, tag)
        rows = batch if done is None else batch.filter(F.col(key) > F.lit(done))
        # A micro-batch is bounded by maxFilesPerTrigger; every row of it is copied.
        staged = J.stage_pending(spark, spec, rows, key, store, capped=False)
        if staged is None:
            return
        try:
            J.copy_staged(spark, spec, store, staged, key, 0 if done is None else done, epoch, host,
                          before_history=before_history, tag=tag, capped=False, sync_run=sync_run)
        finally:
            remove_path(spark, staged.path)

    started, t0 = J.utc_now(), time.monotonic()
    try:
        writer = source.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
        if available_now:
            q = writer.trigger(availableNow=True).start()
            q.awaitTermination()
        else:
            q = writer.start()
            try:
                q.processAllAvailable()
            finally:
                q.stop()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    except Exception as exc:
        J.record_failure(spark, store, J._history_row(spec, 0, STATUS_FAILED, started, J.utc_now(), host, time.monotonic() - t0,
                                                      error=f"{type(exc).__name__}: {exc}"[:4000], sync_run=sync_run))
        raise
    return len(seen)


def stream_sync_by_key(spark: SparkSession, path: str, schema: StructType, spec: J.JobSpec, store: J.Store,
                       checkpoint_location: str, max_rows: int, host: str | None = None,
                       before_history: Callable[[str], None] | None = None) -> int:
    """Copy Parquet files as a stream in key order, at most ``max_rows`` rows a batch (one key's
    rows stay together); returns batches seen.  A new checkpoint starts after the job's cursor,
    an old one goes on where it was, repeating a batch that it had planned but not finished.
    After a rewind the stream needs a new checkpoint, and is refused with the old one."""
    planned = planned_keys(spark, checkpoint_location)
    J.ensure_history(spark, store)
    cursor, _ = J.current_cursor(spark, store, spec.job_key)
    if len(planned) == 2 and cursor < planned[1]:
        raise ValueError(f"job {spec.job_key}: cursor {cursor} lies before the stream's key {planned[1]}; use a new checkpoint")
    # A first batch that is repeated starts at the cursor: what it had committed lies below.
    source = key_source(spark, path, schema, max_rows, min([cursor, *planned[:1]]), planned[0] if planned else None)
    return stream_sync(spark, source, spec, store, checkpoint_location, host, before_history, available_now=False)


def file_source(spark: SparkSession, folder: str, schema, max_files_per_trigger: int = 1,
                name_glob: str | None = None, fmt: str = "parquet") -> DataFrame:
    """A growing folder of files as a stream, a bounded number of files per batch;
    ``name_glob`` keeps only matching file names."""
    reader = (spark.readStream.format(fmt).schema(schema)
              .option("maxFilesPerTrigger", max_files_per_trigger))
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    return reader.load(folder)
