"""Engine cases: the sync job on tiny frames with real writes."""

import datetime as dt
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidemark.plans import job as J
from tidemark.operators import sink as K

NOW = dt.datetime(2026, 8, 19, 12, 0, 0)


def rows_extract(keys):
    def fn(spark, params):
        data = [(int(k), f"Row{k}") for k in keys]
        return spark.createDataFrame(data, "key long, name string")
    return fn


def spec(scratch, keys, name="JOB1", batch=10, cap=100000, ppc=1, extract=None, dedup=False):
    return J.JobSpec(name, extract or rows_extract(keys), f"{scratch}/target_{name}", ["key_col", "name_col"],
                     batch_size=batch, max_records=max(cap, batch), pages_per_commit=ppc,
                     dedup_on_insert=dedup)


def store(scratch):
    return J.Store(f"{scratch}/history", f"{scratch}/overrides")


def history(spark, st, job="JOB1"):
    return J.read_history(spark, st).filter(F.col("sync_key") == job).orderBy("run_id").collect()


def target_keys(spark, sp, st):
    df = K.read_target(spark, sp.target_location, J.read_history(spark, st), sp.job_key)
    return sorted(r[0] for r in df.select(sp.target_columns[0]).collect())


def test_happy_path(spark, scratch):
    sp, st = spec(scratch, [1, 2, 3]), store(scratch)
    r = J.run_job(spark, sp, st)
    assert r["status"] == "Success" and r["records_read"] == 3
    h = history(spark, st)
    assert [(x.status, x.source_row_id_from, x.source_row_id_to, x.records_inserted) for x in h] == [
        ("Success", 1, 3, 3)]
    assert target_keys(spark, sp, st) == [1, 2, 3]


def test_no_new_data(spark, scratch):
    sp, st = spec(scratch, []), store(scratch)
    r = J.run_job(spark, sp, st)
    assert r["status"] == "NoNewData"
    h = history(spark, st)
    assert len(h) == 1 and h[0].status == "NoNewData" and h[0].source_row_id_to is None
    from tidemark.session import path_exists
    assert not path_exists(spark, sp.target_location)


def test_arity_mismatch(spark, scratch):
    def one_col(spark, params):
        return spark.createDataFrame([(1,)], "only_one_column long")
    sp, st = spec(scratch, [], extract=one_col), store(scratch)
    r = J.run_job(spark, sp, st)
    assert r["status"] == "Failed"
    assert "1 column(s)" in r["error_message"] and "lists 2" in r["error_message"]
    assert history(spark, st)[0].status == "Failed"


def test_failing_job_does_not_stop_others(spark, scratch):
    def boom(spark, params):
        raise RuntimeError("source down")
    st = store(scratch)
    specs = [spec(scratch, [], name="BAD", extract=boom), spec(scratch, [5, 6], name="GOOD")]
    res = {r.sync_key: r for r in J.sync_tables(spark, specs, st).collect()}
    assert res["BAD"].status == "Failed" and "source down" in res["BAD"].error_message
    assert res["GOOD"].status == "Success" and res["GOOD"].records_read == 2
    assert J.exit_code(J.sync_tables(spark, specs[:1], st)) == 1


def test_crash_before_history_hides_rows_and_retry_is_idempotent(spark, scratch):
    sp, st = spec(scratch, [1, 2, 3]), store(scratch)

    def crash(commit_id):
        raise RuntimeError("lost before commit")
    r = J.run_job(spark, sp, st, before_history=crash)
    assert r["status"] == "Failed" and r["records_read"] == 0
    # the data partition exists but is not committed
    assert spark.read.parquet(sp.target_location).count() == 3
    assert target_keys(spark, sp, st) == []
    from tidemark.operators import quality as Q
    left = Q.uncommitted_partitions(spark, sp.target_location, J.read_history(spark, st), "JOB1").collect()
    assert [(r.commit_id, r.rows) for r in left] == [("JOB1-e0-c0", 3)]
    r2 = J.run_job(spark, sp, st)
    assert r2["status"] == "Success"
    assert target_keys(spark, sp, st) == [1, 2, 3]
    assert spark.read.parquet(sp.target_location).count() == 3   # same commit id overwritten
    assert Q.uncommitted_partitions(spark, sp.target_location, J.read_history(spark, st)).count() == 0


def test_second_page_fails_then_resumes(spark, scratch):
    sp, st = spec(scratch, [1, 2, 3, 4, 5], batch=2), store(scratch)
    calls = []

    def fail_second(commit_id):
        calls.append(commit_id)
        if len(calls) == 2:
            raise RuntimeError("page 2 failed")
    r = J.run_job(spark, sp, st, before_history=fail_second)
    assert r["status"] == "Failed" and r["records_read"] == 2 and r["source_row_id_to"] == 2
    assert target_keys(spark, sp, st) == [1, 2]
    r2 = J.run_job(spark, sp, st)
    assert r2["status"] == "Success" and r2["records_read"] == 3
    assert target_keys(spark, sp, st) == [1, 2, 3, 4, 5]


def test_multi_page_rereads_cursor(spark, scratch):
    sp, st = spec(scratch, [1, 2, 3, 4, 5], batch=2), store(scratch)
    J.run_job(spark, sp, st)
    h = history(spark, st)
    assert [(x.source_row_id_from, x.source_row_id_to, x.records_read) for x in h] == [
        (1, 2, 2), (3, 4, 2), (5, 5, 1)]
    assert [x.commit_id for x in h] == ["JOB1-e0-c0", "JOB1-e0-c2", "JOB1-e0-c4"]
    assert J.run_job(spark, sp, st)["status"] == "NoNewData"


@pytest.mark.parametrize("cap,expected", [(2, [1, 2]), (3, [1, 2, 3, 4]), (4, [1, 2, 3, 4])])
def test_run_cap(spark, scratch, cap, expected):
    sp = J.JobSpec("CAP", rows_extract(range(1, 11)), f"{scratch}/t_cap{cap}", ["k", "n"],
                   batch_size=2, max_records=cap)
    st = J.Store(f"{scratch}/h_cap{cap}")
    r = J.run_job(spark, sp, st)
    assert r["records_read"] == len(expected)
    r2 = J.run_job(spark, sp, st)
    assert r2["source_row_id_from"] == len(expected) + 1


def test_resume_position_from_history(spark, scratch):
    st = store(scratch)
    J.ensure_history(spark, st)
    sp = spec(scratch, [])
    rows = [J._history_row(sp, 1, "Success", NOW, NOW, "h", 1.0, 1, 2, 2, 2),
            J._history_row(sp, 2, "Success", NOW, NOW, "h", 1.0, 3, 4, 2, 2),
            J._history_row(sp, 3, "Failed", NOW, NOW, "h", 1.0, error="x"),
            J._history_row(sp, 4, "NoNewData", NOW, NOW, "h", 1.0)]
    J.append_history(spark, st, rows)
    assert J.current_cursor(spark, st, "JOB1") == (4, 0)
    from tidemark.operators import monitor as M
    s = M.sync_status(J.read_history(spark, st), NOW, 60).first()
    assert s.last_run_status == "NoNewData" and s.last_row_id == 4


def test_rewind_recopies_and_dedup_on_insert(spark, scratch):
    st = store(scratch)
    sp = spec(scratch, [1, 2, 3, 4, 5], batch=2)
    J.run_job(spark, sp, st)
    J.rewind(spark, st, "JOB1", 2)
    assert J.current_cursor(spark, st, "JOB1") == (2, 1)
    J.run_job(spark, sp, st)
    assert target_keys(spark, sp, st) == [1, 2, 3, 3, 4, 4, 5, 5]
    assert J.current_cursor(spark, st, "JOB1") == (5, 1)
    # with dedup-on-insert a rewind re-reads but copies nothing twice
    sp2 = spec(scratch, [1, 2, 3, 4, 5], name="JOB2", batch=2, dedup=True)
    J.run_job(spark, sp2, st)
    J.rewind(spark, st, "JOB2", 0)
    r = J.run_job(spark, sp2, st)
    assert r["status"] == "NoNewData"
    assert target_keys(spark, sp2, st) == [1, 2, 3, 4, 5]


def test_spec_validation():
    with pytest.raises(ValueError):
        J.JobSpec("X", rows_extract([]), "/tmp/x", ["a"], batch_size=0).validate()
    with pytest.raises(ValueError):
        J.JobSpec("X", rows_extract([]), "/tmp/x", [" "], batch_size=1, max_records=1).validate()


def test_lookback_catches_late_rows_without_duplicates(spark, scratch):
    st = store(scratch)
    keys = {"now": [1, 2, 4, 5]}

    def extract(spark, params):
        return spark.createDataFrame([(k, f"Row{k}") for k in keys["now"]], "key long, name string")
    sp = J.JobSpec("LATE", extract, f"{scratch}/t_late", ["k", "n"], batch_size=10, max_records=100,
                   lookback=10)
    J.run_job(spark, sp, st)
    keys["now"] = [1, 2, 3, 4, 5, 6]          # 3 became eligible after 5 was copied
    J.run_job(spark, sp, st)
    assert target_keys(spark, sp, st) == [1, 2, 3, 4, 5, 6]


def test_sql_text_source_with_named_parameters(spark):
    from tidemark.sources import increment as INC
    spark.range(1, 21).selectExpr("id AS row_id", "id * 2 AS v").createOrReplaceTempView("src_rows")
    src = INC.Source(INC.KIND_TEXT, text="SELECT row_id, v FROM src_rows WHERE row_id > :last_row_id "
                                          "ORDER BY row_id LIMIT :batch_size")
    got = [r.row_id for r in INC.read_increment(spark, src, 5, 3).collect()]
    assert got == [6, 7, 8]
    plan = INC.read_increment(spark, src, 5, 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_ack_sent_log(spark, scratch):
    batch = spark.range(1, 4).withColumnRenamed("id", "key")
    K.append_sent_log(batch, f"{scratch}/sent", "key", NOW)
    K.append_sent_log(batch.filter("key > 2"), f"{scratch}/sent", "key", NOW)
    log = spark.read.parquet(f"{scratch}/sent")
    cands = spark.range(1, 6).withColumnRenamed("id", "row_id")
    assert [r.row_id for r in K.sent_log_batch(cands, log, "row_id", 10).collect()] == [4, 5]


def test_stream_copies_each_batch_whole_and_skips_replays(spark, scratch):
    from tidemark.streaming import stream as STR
    src = f"{scratch}/incoming"
    for lo in (1, 8):
        spark.range(lo, lo + 7).selectExpr("id AS key", "concat('Row', id) AS name") \
            .coalesce(1).write.mode("append").parquet(src)
    st = store(scratch)
    sp = J.JobSpec("STREAM", rows_extract([]), f"{scratch}/t_stream", ["k", "n"], batch_size=2, max_records=2)
    source = STR.file_source(spark, src, "key long, name string", max_files_per_trigger=1)
    assert STR.stream_sync(spark, source, sp, st, f"{scratch}/ckpt") == 2
    assert target_keys(spark, sp, st) == list(range(1, 15))
    # a restart with the same checkpoint sees no new files and copies nothing
    source = STR.file_source(spark, src, "key long, name string", max_files_per_trigger=1)
    STR.stream_sync(spark, source, sp, st, f"{scratch}/ckpt")
    assert target_keys(spark, sp, st) == list(range(1, 15))


def test_cap_rounds_to_whole_pages_and_commits(spark, scratch):
    sp = J.JobSpec("PRE", rows_extract(range(1, 30)), f"{scratch}/t_pre", ["k", "n"],
                   batch_size=3, max_records=7, pages_per_commit=2)
    st = J.Store(f"{scratch}/h_pre")
    r = J.run_job(spark, sp, st)
    assert (r["records_read"], r["source_row_id_to"], r["pages"]) == (9, 9, 3)
    assert target_keys(spark, sp, st) == list(range(1, 10))
    r = J.run_job(spark, sp, st)
    assert (r["source_row_id_from"], r["source_row_id_to"]) == (10, 18)
    assert [h.commit_id for h in history(spark, st, "PRE")][-3:] == ["PRE-e0-c9", "PRE-e0-c9", "PRE-e0-c15"]


def test_uncapped_run_drains_the_source(spark, scratch):
    sp = J.JobSpec("ALL", rows_extract(range(1, 30)), f"{scratch}/t_all", ["k", "n"], batch_size=2, max_records=None)
    st = J.Store(f"{scratch}/h_all")
    assert J.run_job(spark, sp, st)["records_read"] == 29
    h = history(spark, st, "ALL")
    assert len(h) == len({x.commit_id for x in h}) == 15      # one commit per page, as the spec says
    assert target_keys(spark, sp, st) == list(range(1, 30))
    assert J.run_job(spark, sp, st)["status"] == "NoNewData"


def test_rewind_before_first_run_and_per_job_epochs(spark, scratch):
    st = store(scratch)
    J.ensure_history(spark, st)
    J.rewind(spark, st, "NEW", 7)           # job without history
    assert J.current_cursor(spark, st, "NEW") == (7, 1)
    J.rewind(spark, st, "NEW", 3)
    assert J.current_cursor(spark, st, "NEW") == (3, 2)
    assert J.current_cursor(spark, st, "OTHER") == (0, 0)


def test_jdbc_options_are_partitioned():
    from tidemark.sources import increment as INC
    o = INC.jdbc_options("jdbc:sqlserver://db", "dbo.src", "RowID", 0, 1000, 8, user="u")
    assert (o["partitionColumn"], o["numPartitions"], o["upperBound"], o["user"]) == ("RowID", "8", "1000", "u")
    with pytest.raises(ValueError):
        INC.jdbc_options("x", "t", "k", 5, 1, 2)


def test_deadline_cancels_running_job(spark, scratch):
    def slow(spark, params):
        # a heavy but finite aggregation; the deadline fires long before it ends
        big = spark.range(0, 3_000_000_000, numPartitions=64)
        return big.groupBy((F.col("id") % 1000).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    st = store(scratch)
    sp = J.JobSpec("SLOW", slow, f"{scratch}/t_slow", ["k", "n"], batch_size=10, max_records=100)
    import time as _t
    t0 = _t.time()
    res = J.sync_tables(spark, [sp], st, deadline_seconds=3).collect()[0]
    assert res.status == "Failed"
    assert _t.time() - t0 < 60
    assert history(spark, st, "SLOW")[0].status == "Failed"
    # the session is usable afterwards
    assert spark.range(3).count() == 3


def test_monitoring_over_real_runs(spark, scratch):
    from tidemark.operators import history as H
    from tidemark.operators import monitor as M
    st = store(scratch)
    clock = iter([dt.datetime(2026, 8, 19, 11, m) for m in range(0, 59)])

    def now():
        return next(clock)
    good = spec(scratch, [1, 2, 3, 4, 5], name="GOOD", batch=2)
    J.run_job(spark, good, st, now=now)

    def boom(spark, params):
        raise RuntimeError("source down\nat step 2")
    J.run_job(spark, spec(scratch, [], name="BAD", extract=boom), st, now=now)
    hist = J.read_history(spark, st)
    status = {r.sync_key: r for r in M.sync_status(hist, NOW, 60).collect()}
    assert status["GOOD"].is_healthy and status["GOOD"].last_row_id == 5
    assert not status["BAD"].is_healthy and status["BAD"].last_run_status == "Failed"
    runs = H.recent_runs(hist, 2, ["GOOD"]).collect()
    assert [r.source_row_id_to for r in runs] == [5, 4]
    fails = M.recent_failures(hist, NOW).collect()
    assert [r.sync_key for r in fails] == ["BAD"]
    shown = M.run_display(hist, 50, ["BAD"]).first()
    assert shown.error_line.startswith("RuntimeError: source down") and "\n" not in shown.error_line
    digest = M.failure_digest(hist).collect()
    assert [(d.failed_jobs, d.failed_count) for d in digest] == [("BAD", 1)]


def test_history_follows_in_doubling_steps(spark, scratch):
    keys = [3, 5, 8, 13, 21, 34, 55]
    sp, st = spec(scratch, keys, batch=1, cap=100, ppc=1), store(scratch)
    first = []
    r = J.run_job(spark, sp, st, before_history=first.append)
    assert r["status"] == "Success" and r["records_read"] == 7 and r["pages"] == 7
    h = history(spark, st)
    assert [(x.source_row_id_from, x.records_inserted) for x in h] == [(k, 1) for k in keys]
    assert [x.commit_id for x in h] == [f"JOB1-e0-c{k}" for k in [0, *keys[:-1]]]
    assert first == ["JOB1-e0-c0", "JOB1-e0-c3", "JOB1-e0-c5", "JOB1-e0-c13"]       # chunks 0, 1, 2-3, 4-6
    assert abs(sum(x.duration_seconds for x in h) - r["duration_seconds"]) < r["duration_seconds"] / 2
    assert target_keys(spark, sp, st) == keys
    assert J.run_job(spark, sp, st)["status"] == "NoNewData"


def late_spec(scratch, keys, **kw):
    def extract(spark, params):
        return spark.createDataFrame([(k, f"Row{k}") for k in keys["now"]], "key long, name string")
    return J.JobSpec("LATE", extract, f"{scratch}/t_late", ["k", "n"], batch_size=10, max_records=100, lookback=10, **kw)


def test_late_row_then_new_rows_keeps_both(spark, scratch):
    keys, st = {"now": [1, 2, 4, 5]}, store(scratch)
    sp = late_spec(scratch, keys)
    for now in ([1, 2, 4, 5], [1, 2, 3, 4, 5], [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]):
        keys["now"] = now
        J.run_job(spark, sp, st)
        assert target_keys(spark, sp, st) == now


def test_two_late_only_runs_keep_both(spark, scratch):
    keys, st = {"now": [1, 9]}, store(scratch)
    sp = late_spec(scratch, keys)
    for now in ([1, 9], [1, 5, 9], [1, 3, 5, 7, 9], [1, 3, 5, 7, 9]):
        keys["now"] = now
        J.run_job(spark, sp, st)
        assert target_keys(spark, sp, st) == now


def test_lookback_crash_and_retry(spark, scratch):
    keys, st = {"now": [1, 9]}, store(scratch)
    sp = late_spec(scratch, keys)
    J.run_job(spark, sp, st)
    keys["now"] = [1, 4, 9]

    def crash(commit_id):
        raise RuntimeError("lost")
    assert J.run_job(spark, sp, st, before_history=crash)["status"] == "Failed"
    assert target_keys(spark, sp, st) == [1, 9]
    assert J.run_job(spark, sp, st)["status"] == "Success"
    assert target_keys(spark, sp, st) == [1, 4, 9]
    assert spark.read.parquet(sp.target_location).count() == 3      # the retry replaced its own leftover


def stream_files(spark, src, ranges):
    for lo, hi in ranges:
        spark.range(lo, hi).selectExpr("id AS key", "concat('Row', id) AS name").coalesce(1).write.mode("append").parquet(src)


def test_stream_files_out_of_key_order(spark, scratch):
    from tidemark.streaming import stream as STR
    src, st = f"{scratch}/incoming", store(scratch)
    stream_files(spark, src, [(101, 201), (1, 101)])
    sp = J.JobSpec("STREAM", rows_extract([]), f"{scratch}/t_stream", ["k", "n"], batch_size=20, max_records=20)
    assert STR.stream_sync(spark, STR.file_source(spark, src, "key long, name string"), sp, st, f"{scratch}/ckpt") == 2
    assert target_keys(spark, sp, st) == list(range(1, 201))


def test_stream_crash_in_a_batch_and_retry(spark, scratch):
    from tidemark.streaming import stream as STR
    src, st = f"{scratch}/incoming", store(scratch)
    stream_files(spark, src, [(101, 111), (1, 11)])
    sp = J.JobSpec("STREAM", rows_extract([]), f"{scratch}/t_stream", ["k", "n"], batch_size=2, max_records=2)
    calls = []

    def crash(commit_id):
        calls.append(commit_id)
        if len(calls) == 6:
            raise RuntimeError("lost in the second batch")
    with pytest.raises(Exception):
        STR.stream_sync(spark, STR.file_source(spark, src, "key long, name string"), sp, st, f"{scratch}/ckpt", before_history=crash)
    assert history(spark, st, "STREAM")[-1].status == "Failed"
    assert target_keys(spark, sp, st) == [1, 2, *range(101, 111)]
    STR.stream_sync(spark, STR.file_source(spark, src, "key long, name string"), sp, st, f"{scratch}/ckpt")
    assert target_keys(spark, sp, st) == [*range(1, 11), *range(101, 111)]


def test_target_types_fail_a_too_long_value_and_add_unfilled_columns(spark, scratch):
    def typed(name, width):
        return J.JobSpec(name, rows_extract([1, 2, 300]), f"{scratch}/t_{name}", ["k", "n"], batch_size=10, max_records=100,
                         target_types=[("k", "bigint"), ("n", f"string({width})"), ("note", "string(9)")])
    st = store(scratch)
    r = J.run_job(spark, typed("NARROW", 5), st)
    assert r["status"] == "Failed" and "exceeds 5" in r["error_message"]
    assert J.run_job(spark, typed("WIDE", 6), st)["status"] == "Success"
    df = K.read_target(spark, f"{scratch}/t_WIDE", J.read_history(spark, st), "WIDE")
    assert sorted(tuple(x) for x in df.select("k", "n", "note").collect()) == [(1, "Row1", None), (2, "Row2", None), (300, "Row300", None)]


def test_key_must_be_an_integer(spark, scratch):
    def text_key(spark, params):
        return spark.createDataFrame([("a", "b")], "key string, name string")
    r = J.run_job(spark, spec(scratch, [], extract=text_key), store(scratch))
    assert r["status"] == "Failed" and "not an integer" in r["error_message"]


def test_cursor_reaches_the_source(spark, scratch):
    from tidemark.sources import increment as INC
    spark.range(1, 21).selectExpr("id AS row_id", "id * 2 AS v").createOrReplaceTempView("cursor_rows")
    src = INC.Source(INC.KIND_TEXT, text="SELECT row_id, v FROM cursor_rows WHERE row_id > :last_row_id")
    seen = []

    def extract(s, params):
        seen.append(params)
        df = INC.as_extract(src)(s, params)
        assert "SinglePartition" not in df._jdf.queryExecution().executedPlan().toString()
        return df
    sp, st = J.JobSpec("TEXT", extract, f"{scratch}/t_text", ["k", "v"], batch_size=4, max_records=8), store(scratch)
    J.run_job(spark, sp, st)
    J.run_job(spark, sp, st)
    assert [(p["last_row_id"], p["batch_size"]) for p in seen] == [(0, 8), (8, 8)]
    assert target_keys(spark, sp, st) == list(range(1, 17))


def test_runs_have_ids(spark, scratch):
    from tidemark.operators import history as H

    def boom(spark, params):
        raise RuntimeError("down")
    st = store(scratch)
    good, bad = spec(scratch, range(1, 8), name="GOOD", batch=2), spec(scratch, [], name="BAD", extract=boom)
    # Two runs in one hour, one across the hour.
    for clock in ([(11, 0)] * 40, [(11, 30)] * 40, [(11, 59)] * 3 + [(12, 1)] * 40):
        it = iter([dt.datetime(2026, 8, 19, h, m) for h, m in clock])
        J.sync_tables(spark, [good, bad], st, now=lambda: next(it))
    hist = J.read_history(spark, st)
    runs = [r.asDict() for r in H.job_runs(hist).orderBy("first_run_id").collect()]
    assert [(r["sync_key"], r["pages"], r["records_read"], r["any_failed"]) for r in runs] == [
        ("GOOD", 4, 7, False), ("BAD", 0, 0, True), ("GOOD", 0, 0, False), ("BAD", 0, 0, True), ("GOOD", 0, 0, False), ("BAD", 0, 0, True)]
    assert len({r["sync_run"] for r in runs}) == 3
    out = H.sync_outcomes(hist).collect()
    assert [(r.jobs, r.failed_jobs, r.failed_keys, r.exit_code) for r in out] == [(2, 1, "BAD", 1)] * 3


def test_a_partly_failed_run_counts_its_committed_pages_once(spark, scratch):
    from tidemark.operators import history as H
    calls = []

    def fail_third(commit_id):
        calls.append(commit_id)
        if len(calls) == 3:
            raise RuntimeError("page failed")
    sp, st = spec(scratch, range(1, 11), batch=2), store(scratch)
    J.run_job(spark, sp, st, before_history=fail_third)
    r = H.job_runs(J.read_history(spark, st)).first()
    assert (r.pages, r.records_read, r.records_inserted, r.any_failed) == (2, 4, 4, True) and "page failed" in r.error_message


def test_stores_with_the_same_job_key_leave_each_other_alone(spark, scratch):
    from tidemark.session import path_exists, scratch_path
    other = J.Store(f"{scratch}/other")
    live = scratch_path(spark, "stage", "JOB1", J.store_name(other))
    spark.range(3).write.parquet(live)
    J.run_job(spark, spec(scratch, [1]), store(scratch))
    assert path_exists(spark, live)


def test_new_files_are_seen_in_one_session(spark, scratch):
    from tidemark.sources import tables as T
    spark.range(10).write.parquet(f"{scratch}/orders.parquet")
    assert T.load(spark, scratch, "orders").count() == 10
    spark.range(10).write.mode("append").parquet(f"{scratch}/orders.parquet")
    assert T.load(spark, scratch, "orders").count() == 20


def test_leftover_staging_of_a_dead_run_is_removed(spark, scratch):
    from tidemark.session import path_exists, scratch_path
    st = store(scratch)
    left = scratch_path(spark, "stage", "DEAD", J.store_name(st))
    other = scratch_path(spark, "stage", "DEAD.2", J.store_name(st))
    spark.range(3).write.parquet(left)
    spark.range(3).write.parquet(other)
    sp = spec(scratch, [1, 2], name="DEAD")
    assert J.run_job(spark, sp, st)["status"] == "Success"
    assert not path_exists(spark, left)
    assert path_exists(spark, other)          # another job's folder is left alone


def test_full_reload_replaces_what_readers_see(spark, scratch):
    st = store(scratch)
    first = spec(scratch, [1, 2, 3], batch=2)
    J.run_job(spark, first, st)
    second = spec(scratch, [2, 3, 4, 5], batch=2, cap=2)
    epoch = J.full_reload(spark, second, st)
    df = K.read_target(spark, second.target_location, J.read_history(spark, st), "JOB1", since_epoch=epoch)
    assert sorted(r.key_col for r in df.collect()) == [2, 3, 4, 5]
    # A reload that fails leaves the older epoch as it was, and the next run continues the reload.
    with pytest.raises(RuntimeError):
        J.full_reload(spark, second, st, before_history=lambda c: (_ for _ in ()).throw(RuntimeError("lost")))
    df = K.read_target(spark, second.target_location, J.read_history(spark, st), "JOB1", since_epoch=epoch)
    assert sorted(r.key_col for r in df.collect()) == [2, 3, 4, 5]


def test_sent_log_follows_commits(spark, scratch):
    from dataclasses import replace
    calls = []

    def fail_second(commit_id):
        calls.append(commit_id)
        if len(calls) == 2:
            raise RuntimeError("page 2 failed")
    sp, st = replace(spec(scratch, range(1, 6), batch=2), sent_log=f"{scratch}/sent"), store(scratch)
    J.run_job(spark, sp, st, before_history=fail_second)
    assert sorted(r.row_id for r in spark.read.parquet(sp.sent_log).collect()) == [1, 2]
    J.run_job(spark, sp, st)
    assert sorted(r.row_id for r in spark.read.parquet(sp.sent_log).collect()) == [1, 2, 3, 4, 5]


def test_rows_of_the_next_step_are_written_during_an_append(spark, scratch, monkeypatch):
    sp, st = spec(scratch, [1, 2, 3, 4], batch=1), store(scratch)
    write, frame, started, met = K.write_commit, J._history_frame, threading.Semaphore(0), []

    def written(*a, **kw):
        started.release()
        write(*a, **kw)

    def appended(*a, **kw):
        if len(met) < 2:                                    # of the steps 0, 1 and 2-3, two have one after them
            met.append(started.acquire(timeout=20))
        return frame(*a, **kw)
    monkeypatch.setattr(K, "write_commit", lambda *a, **kw: (written if a[2] != "JOB1-e0-c0" else write)(*a, **kw))
    monkeypatch.setattr(J, "_history_frame", appended)
    assert J.run_job(spark, sp, st)["status"] == "Success"
    assert met == [True, True]
    assert [x.commit_id for x in history(spark, st)] == ["JOB1-e0-c0", "JOB1-e0-c1", "JOB1-e0-c2", "JOB1-e0-c3"]
    assert target_keys(spark, sp, st) == [1, 2, 3, 4]


def test_a_step_that_fails_during_an_append_keeps_the_step_before(spark, scratch, monkeypatch):
    sp, st = spec(scratch, [1, 2, 3, 4], batch=1), store(scratch)
    write, frame = K.write_commit, J._history_frame

    def fails(df, location, commit_id, fmt="parquet"):
        if commit_id == "JOB1-e0-c1":
            raise RuntimeError("no space")
        write(df, location, commit_id, fmt)

    def slow(*a, **kw):
        time.sleep(1)
        return frame(*a, **kw)
    with monkeypatch.context() as m:
        m.setattr(K, "write_commit", fails)
        m.setattr(J, "_history_frame", slow)
        r = J.run_job(spark, sp, st)
    assert (r["status"], r["records_read"], r["source_row_id_to"], r["error_message"]) == ("Failed", 1, 1, "RuntimeError: no space")
    assert target_keys(spark, sp, st) == [1]
    assert J.run_job(spark, sp, st)["records_read"] == 3
    assert target_keys(spark, sp, st) == [1, 2, 3, 4]


def test_an_append_that_fails_stops_the_run(spark, scratch, monkeypatch):
    sp, st = spec(scratch, [1, 2, 3, 4], batch=1), store(scratch)
    frame = J._history_frame

    def fails(spec_, pages, *a, **kw):
        if pages.first()["commit_id"] == "JOB1-e0-c1":
            raise RuntimeError("no history")
        return frame(spec_, pages, *a, **kw)
    with monkeypatch.context() as m:
        m.setattr(J, "_history_frame", fails)
        r = J.run_job(spark, sp, st)
    assert (r["status"], r["records_read"], r["error_message"]) == ("Failed", 1, "RuntimeError: no history")
    assert target_keys(spark, sp, st) == [1]
    assert J.run_job(spark, sp, st)["records_read"] == 3
    assert target_keys(spark, sp, st) == [1, 2, 3, 4]
