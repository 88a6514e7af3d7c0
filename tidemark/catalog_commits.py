"""Registered queries over what failing, reloading and repaired jobs leave behind."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from .catalog import (_IDX_SQL, _RUN_SQL, _hist, _hist_runs, _response_sql, _target_of, BATCH, HISTORY_PAGES, extract_rows_sql,
                      profile_job, query, response_job)
from .operators import history as H
from .operators import monitor as M
from .operators import quality as Q
from .operators import sink as K
from .plans import job as J
from .session import scratch_path
from .sources import tables as T
from .sources.views_sql import with_views
from .streaming import stream as STR

REPORT_COLUMNS = ["row_id", "ref_no"]


def _store(spark, name: str) -> tuple[str, J.Store]:
    root = scratch_path(spark, name)
    return root, J.Store(f"{root}/history", f"{root}/overrides")


def _report_job(key: str, rows, root: str, **kw) -> J.JobSpec:
    kw = dict(dict(batch_size=BATCH, max_records=None, pages_per_commit=4), **kw)
    return J.JobSpec(key, lambda s, p: rows.filter(F.col("row_id") > p["last_row_id"]), f"{root}/target", REPORT_COLUMNS, **kw)


@query("reload_after_failure", with_views("report") + """, m AS (SELECT max(row_id) * 4 // 5 AS upto FROM report)
SELECT row_id, CASE WHEN row_id <= upto THEN 'old' ELSE ref_no END AS ref_no FROM report, m WHERE row_id > 0""")
def q_reload_after_failure(spark, sf):
    """A full reload that fails on its last row, then a normal run: readers see the older copy
    and the new rows, each once."""
    root, store = _store(spark, "reload-failure")
    rows = T.report(spark, sf).select(*REPORT_COLUMNS)
    upto, last = rows.select(F.expr("max(row_id) * 4 div 5"), F.max("row_id")).first()
    widths = dict(target_types=[("ref_no", "string(20)")])
    J.run_job(spark, _report_job("RELOAD", rows.filter(F.col("row_id") <= upto).withColumn("ref_no", F.lit("old")), root, **widths), store)
    bad = rows.withColumn("ref_no", F.when(F.col("row_id") == last, F.repeat(F.lit("x"), 21)).otherwise(F.col("ref_no")))
    try:
        J.full_reload(spark, _report_job("RELOAD", bad, root, **widths), store)
    except RuntimeError:
        pass
    spec = _report_job("RELOAD", rows, root, **widths)
    J.run_job(spark, spec, store)
    return _target_of(spark, spec, J.read_history(spark, store))


@query("sent_log_after_crash", extract_rows_sql() + "SELECT row_id FROM x")
def q_sent_log_after_crash(spark, sf):
    """A job that committed a run without logging it (as a driver lost between the two leaves
    it), then run on: the log holds every committed key once."""
    root, store = _store(spark, "sent-crash")
    spec = replace(profile_job(spark, sf, root), batch_size=BATCH // 4, max_records=BATCH * 2)
    J.run_job(spark, spec, store)
    logged = replace(spec, sent_log=f"{root}/sent", max_records=None)
    J.run_job(spark, logged, store)
    return spark.read.parquet(logged.sent_log).select("row_id")


_POISON_BATCH = BATCH * 5


@query("poison_row_target", with_views("report") + f""", r AS (
  SELECT row_id, row_number() OVER (ORDER BY row_id) - 1 AS idx, (count(*) OVER () - 1) // {_POISON_BATCH} AS last_page FROM report WHERE row_id > 0)
SELECT 'first' AS attempt, count(*) AS rows, max(row_id) AS last_key FROM r
  WHERE idx < {_POISON_BATCH} * CAST(pow(2, floor(log2(last_page))) AS BIGINT)
UNION ALL SELECT 'last', count(*), max(row_id) FROM r WHERE idx < {_POISON_BATCH} * last_page""")
def q_poison_row_target(spark, sf):
    """A value that does not fit in the last of many one-page commits: the first run keeps all
    steps before its own, further runs get up to its page."""
    root, store = _store(spark, "poison")
    rows = T.report(spark, sf).select(*REPORT_COLUMNS)
    last = rows.agg(F.max("row_id")).first()[0]
    bad = rows.withColumn("ref_no", F.when(F.col("row_id") == last, F.repeat(F.lit("x"), 21)).otherwise(F.col("ref_no")))
    spec = _report_job("POISON", bad, root, batch_size=_POISON_BATCH, pages_per_commit=1, target_types=[("ref_no", "string(20)")])

    def state(attempt):
        return _target_of(spark, spec, J.read_history(spark, store)).agg(
            F.lit(attempt).alias("attempt"), F.count(F.lit(1)).alias("rows"), F.max("row_id").alias("last_key"))
    J.run_job(spark, spec, store)
    first = spark.createDataFrame(state("first").collect(), "attempt string, rows long, last_key long")
    while J.run_job(spark, spec, store)["pages"]:
        pass
    return first.unionByName(state("last"))


@query("gap_repair_target", with_views("report") + "SELECT row_id, ref_no FROM report WHERE row_id > 0")
def q_gap_repair_target(spark, sf):
    """A job whose cursor was moved past rows it had not copied, then repaired: every row once,
    and the cursor where it was."""
    root, store = _store(spark, "gap")
    rows = T.report(spark, sf).select(*REPORT_COLUMNS)
    low, high = rows.select(F.expr("max(row_id) div 3"), F.expr("max(row_id) div 2")).first()
    J.run_job(spark, _report_job("GAP", rows.filter(F.col("row_id") <= low), root), store)
    J.rewind(spark, store, "GAP", high)
    spec = _report_job("GAP", rows, root)
    J.run_job(spark, spec, store)
    before = J.current_cursor(spark, store, "GAP")
    J.repair_gaps(spark, spec, store)
    if J.current_cursor(spark, store, "GAP") != before:
        raise AssertionError("a repair moved the cursor")
    return _target_of(spark, spec, J.read_history(spark, store))


@query("copied_gaps", with_views("sync_history") + """, p AS (
  SELECT source_row_id_from AS f, source_row_id_to AS t FROM sync_history WHERE sync_key = 'JOB0' AND status = 'Success'),
w AS (SELECT f, coalesce(max(t) OVER (ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS upto FROM p)
SELECT upto + 1 AS gap_from, f - 1 AS gap_to FROM w WHERE f > upto + 1""")
def q_copied_gaps(spark, sf):
    return H.copied_gaps(_hist(spark, sf), "JOB0")


def _pages_sql(job: str, rows: str, key: str) -> str:
    index = _IDX_SQL.replace("row_id", key)
    return f"""SELECT '{job}' AS sync_key, 'Success' AS status, min({key}) AS source_row_id_from, max({key}) AS source_row_id_to,
  CAST(count(*) AS INTEGER) AS records_read, CAST(count(*) AS INTEGER) AS records_inserted, CAST(NULL AS VARCHAR) AS error_line
FROM (SELECT {key}, ({index}) // {BATCH} AS page_no FROM {rows}) GROUP BY page_no"""


@query("run_jobs_history", "WITH pr AS (" + extract_rows_sql() + "SELECT row_id FROM x), re AS (" + _response_sql(1, 2) + ")\n"
       + _pages_sql("PROFILE", "pr", "row_id") + "\nUNION ALL " + _pages_sql("RESPONSE", "re", "rsp_cms_no")
       + "".join(f"\nUNION ALL SELECT '{job}', 'NoNewData', NULL, NULL, 0, 0, NULL" for job in ("PROFILE", "RESPONSE"))
       + "".join("\nUNION ALL SELECT 'BROKEN', 'Failed', NULL, NULL, 0, 0, 'RuntimeError: source down'" for _ in range(2)))
def q_run_jobs_history(spark, sf):
    """Three jobs in one scheduled run, the first of them failing, run twice: the pages of both
    others, then that they found nothing new."""
    root, store = _store(spark, "jobs")

    def down(s, p):
        raise RuntimeError("source down")
    profile, response = profile_job(spark, sf, root), response_job(spark, sf, root)
    specs = [J.JobSpec("BROKEN", down, f"{root}/target_broken", ["k"]), replace(profile, max_records=None), replace(response, max_records=None)]
    for _ in range(2):
        J.sync_tables(spark, specs, store)
    return J.read_history(spark, store).select(*HISTORY_PAGES, F.split_part("error_message", F.lit("\n"), F.lit(1)).alias("error_line"))


@query("failure_notices", with_views("sync_history") + f""", j AS (
  SELECT {_RUN_SQL} AS sync_run, sync_key, max(run_id) FILTER (WHERE status = 'Failed') AS failed_id,
    CAST(coalesce(sum(records_read) FILTER (WHERE status = 'Success'), 0) AS BIGINT) AS records_read,
    CAST(coalesce(sum(records_inserted) FILTER (WHERE status = 'Success'), 0) AS BIGINT) AS records_inserted
  FROM sync_history GROUP BY 1, 2 HAVING bool_or(status = 'Failed')),
g AS (SELECT sync_run, string_agg(sync_key, ', ' ORDER BY failed_id) AS failed_jobs, count(*) AS failed_count FROM j GROUP BY 1)
SELECT j.sync_run, CAST(row_number() OVER (PARTITION BY j.sync_run ORDER BY failed_id) AS INTEGER) AS place, j.sync_key, failed_jobs, failed_count,
  h.host_machine, h.started_utc, h.completed_utc, j.records_read, j.records_inserted, h.error_message
FROM j JOIN g ON j.sync_run = g.sync_run JOIN sync_history h ON h.run_id = j.failed_id""")
def q_failure_notices(spark, sf):
    return M.failure_notices(_hist_runs(spark, sf))


_NARROW = [("row_id", "bigint"), ("ref_no", "string(5)"), ("cust_name", "string(12)"), ("nationality", "string(200)"), ("entity", "string(9)")]


@query("width_report", with_views("report") + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, CAST(max(length({c})) AS BIGINT) AS longest, CAST({t[7:-1]} AS BIGINT) AS width FROM report "
    f"WHERE row_id > 0 HAVING max(length({c})) > {t[7:-1]}" for c, t in _NARROW[1:]))
def q_width_report(spark, sf):
    """The too wide columns that a run reports before it writes, from its staging pass."""
    root, store = _store(spark, "widths")
    columns = [c for c, _ in _NARROW]
    rows = T.report(spark, sf).select(*columns)
    spec = J.JobSpec("NARROW", lambda s, p: rows, f"{root}/target", columns, batch_size=BATCH, max_records=None, target_types=_NARROW)
    found = J.run_job(spark, spec, store)["too_wide"]
    return spark.createDataFrame(found, "column_name string, longest long, width long")


@query("target_manifest", with_views("report") + """SELECT count(*) AS rows, true AS few_folders, true AS keys_match
FROM report WHERE row_id > 0""")
def q_target_manifest(spark, sf):
    """Default pages, one commit each: the rows of a target by its manifest, whether its folders
    are far fewer than its commits, and whether each folder holds just the key range named."""
    root, store = _store(spark, "manifest")
    spec = _report_job("PAGES", T.report(spark, sf).select(*REPORT_COLUMNS), root, pages_per_commit=1)
    J.run_job(spark, spec, store)
    history = J.read_history(spark, store)
    named = H.live(history).filter("commit_id IS NOT NULL").groupBy("data_id").agg(
        F.count_distinct("commit_id").alias("commits"), F.min("source_row_id_from").alias("low"), F.max("source_row_id_to").alias("high"),
        F.sum("records_inserted").alias("n"))
    held = K.read_target(spark, spec.target_location, history, "PAGES").groupBy(F.col(K.COMMIT_COL).alias("data_id")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("row_id").alias("first"), F.max("row_id").alias("last"))
    return held.join(named, "data_id", "full").agg(
        F.sum("rows").alias("rows"), (F.count(F.lit(1)) <= F.log2(F.sum("commits")) + 2).alias("few_folders"),
        F.bool_and(F.coalesce((F.col("rows") == F.col("n")) & (F.col("first") == F.col("low")) & (F.col("last") == F.col("high")),
                              F.lit(False))).alias("keys_match"))


@query("target_key_order", with_views("target_profile") + "SELECT true AS sorted_ordered, false AS reversed_ordered")
def q_target_key_order(spark, sf):
    """Key order across partitions: the target sorted by its key, and the other way round."""
    keys = T.target_profile(spark, sf).select("cms_no")
    return Q._scalars(spark, sorted_ordered=Q.key_order(keys.orderBy("cms_no"), "cms_no").scalar(),
                      reversed_ordered=Q.key_order(keys.orderBy(F.col("cms_no").desc()), "cms_no").scalar())


_STREAM_BATCHES = 5


def _streamed_by_key(spark, sf):
    """The orders above the cursor's start, key 0, in key order as a stream, a fifth of them a
    batch; the run is lost in the middle of its third batch and started again."""
    root, store = _store(spark, "key-stream")
    orders = T.load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    bound = orders.filter("o_orderkey > 0").count() // _STREAM_BATCHES + 1
    orders.sort("o_orderkey").write.parquet(f"{root}/incoming")
    spec = J.JobSpec("KEYSTREAM", lambda s, p: orders, f"{root}/target", orders.columns, batch_size=BATCH * 10, pages_per_commit=1)
    seen = []

    def lost(commit_id: str) -> None:
        seen.append("b2-c" in commit_id)
        if seen[-2:] == [True, True]:
            raise RuntimeError("driver lost")

    def run(hook=None):
        STR.stream_sync_by_key(spark, f"{root}/incoming", orders.schema, spec, store, f"{root}/checkpoint", bound, before_history=hook)
    try:
        run(lost)
    except Exception as exc:  # noqa: BLE001
        if "driver lost" not in str(exc):
            raise
    run()
    return spec, J.read_history(spark, store)


@query("key_stream_target", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderkey > 0")
def q_key_stream_target(spark, sf):
    """What a stream by key, lost in the middle of a batch, leaves in its target."""
    return _target_of(spark, *_streamed_by_key(spark, sf))


@query("key_stream_batches", f"""SELECT CAST(batch AS BIGINT) AS batch, count(*) AS rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // (count(*) OVER () // {_STREAM_BATCHES} + 1) AS batch FROM orders WHERE o_orderkey > 0)
GROUP BY batch""")
def q_key_stream_batches(spark, sf):
    """The batches of that stream by its commits: bounded rows, in key order, each key once."""
    ok = _streamed_by_key(spark, sf)[1].filter("status = 'Success'")
    return ok.groupBy(F.regexp_extract("commit_id", r"b(\d+)-c", 1).cast("long").alias("batch")).agg(
        F.sum("records_inserted").cast("long").alias("rows"), F.min("source_row_id_from").alias("first_key"),
        F.max("source_row_id_to").alias("last_key"))
