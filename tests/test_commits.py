"""Commits while writing, reloads, the recovered sent log, capped runs, gap repair, key order."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_job import history, rows_extract, spec, store, target_keys
from tidemark.operators import history as H
from tidemark.operators import paging as P
from tidemark.operators import quality as Q
from tidemark.operators import sink as K
from tidemark.plans import job as J
from tidemark.session import checkpoint_root


def bad_last(n, wide=("n", 6)):
    def fn(s, p):
        return s.createDataFrame([(k, "x" * 9 if k == n else f"Row{k}") for k in range(1, n + 1)], "key long, name string")
    return fn


def test_a_failed_reload_changes_nothing(spark, scratch):
    st = store(scratch)
    first = spec(scratch, range(1, 31), batch=5)
    J.run_job(spark, first, st)
    calls = []

    def fail_late(commit_id):
        calls.append(commit_id)
        if len(calls) == 3:
            raise RuntimeError("lost")
    more = spec(scratch, range(1, 51), batch=5)
    with pytest.raises(RuntimeError):
        J.full_reload(spark, more, st, before_history=fail_late)
    assert target_keys(spark, first, st) == list(range(1, 31))       # two committed steps of the reload do not count
    assert J.current_cursor(spark, st, "JOB1") == (30, 0)
    r = J.run_job(spark, more, st)
    assert (r["source_row_id_from"], r["records_read"]) == (31, 20)
    assert target_keys(spark, more, st) == list(range(1, 51))
    epoch = J.full_reload(spark, spec(scratch, [2, 4, 60], batch=5), st)
    assert epoch == 2 and target_keys(spark, more, st) == [2, 4, 60]
    assert J.current_cursor(spark, st, "JOB1") == (60, 2)
    assert Q.reconcile_counts(K.read_target(spark, more.target_location, J.read_history(spark, st), "JOB1"), J.read_history(spark, st),
                              "key_col", "JOB1").first()["agree"]
    # A later rewind counts from the reload on, and a reload of an empty source empties the target.
    J.rewind(spark, st, "JOB1", 2)
    assert J.current_cursor(spark, st, "JOB1") == (2, 3)
    assert J.full_reload(spark, spec(scratch, [], batch=5), st) == 4
    assert target_keys(spark, more, st) == [] and J.current_cursor(spark, st, "JOB1") == (0, 4)


def test_a_reload_needs_no_overrides(spark, scratch):
    st = J.Store(f"{scratch}/history")
    J.run_job(spark, spec(scratch, [1, 2, 3]), st)
    assert J.full_reload(spark, spec(scratch, [2, 3]), st) == 1
    assert target_keys(spark, spec(scratch, []), st) == [2, 3]


def test_keys_committed_but_not_logged_are_logged_by_the_next_run(spark, scratch, monkeypatch):
    sp, st = replace(spec(scratch, range(1, 31), batch=10), sent_log=f"{scratch}/sent"), store(scratch)
    log, calls = K.log_sent, []

    def lost(*a, **kw):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("driver lost before the log")
        log(*a, **kw)
    monkeypatch.setattr(K, "log_sent", lost)
    r = J.run_job(spark, sp, st)
    assert r["status"] == "Failed" and r["records_read"] == 30
    assert spark.read.parquet(sp.sent_log).count() == 20
    for _ in range(2):
        J.run_job(spark, sp, st)
        assert sorted(r.row_id for r in spark.read.parquet(sp.sent_log).collect()) == list(range(1, 31))


def test_a_bad_row_in_the_last_page_keeps_the_earlier_steps(spark, scratch):
    st = store(scratch)
    sp = replace(spec(scratch, [], batch=2, extract=bad_last(40)), target_types=[("name_col", "string(6)")])
    r = J.run_job(spark, sp, st)
    assert r["status"] == "Failed" and r["too_wide"] == [("name_col", 9, 6)] and "name_col (9 > 6)" in r["error_message"]
    assert target_keys(spark, sp, st) == list(range(1, 33))          # chunks 0, 1, 2-3, 4-7, 8-15
    while J.run_job(spark, sp, st)["pages"]:
        pass
    assert target_keys(spark, sp, st) == list(range(1, 39))          # all but the bad page
    assert [h.status for h in history(spark, st)].count("Failed") >= 2
    mended = replace(sp, extract=rows_extract(range(1, 41)))
    assert J.run_job(spark, mended, st)["records_read"] == 2
    assert target_keys(spark, sp, st) == list(range(1, 41))


def test_many_commits_share_few_folders(spark, scratch):
    sp, st = spec(scratch, range(1, 201), batch=2), store(scratch)
    J.run_job(spark, sp, st)
    h = history(spark, st)
    assert len({x.commit_id for x in h}) == 100 and len({x.data_id for x in h}) == 8
    assert {x.data_id for x in h} <= {x.commit_id for x in h}
    assert target_keys(spark, sp, st) == list(range(1, 201))


def test_histories_without_folders_are_read_by_commit(spark, scratch):
    sp, st = spec(scratch, [1, 2, 3]), store(scratch)
    J.run_job(spark, sp, st)
    old = J.read_history(spark, st).drop("data_id", "reload")
    assert K.read_target(spark, sp.target_location, old, "JOB1").count() == 3
    assert H.resume_cursor(old).first()["cursor"] == 3


def test_a_capped_run_takes_the_lowest_keys_only(spark, scratch):
    plan = spark.range(1000).withColumnRenamed("id", "key").select("key").orderBy("key").limit(10).agg(F.max("key"))
    assert "TakeOrderedAndProject" in plan._jdf.queryExecution().executedPlan().toString()
    assert P.nth_key(spark.range(100, 0, -1).toDF("key"), "key", 10) == 10
    assert P.nth_key(spark.range(3).toDF("key"), "key", 10) == 2
    assert P.nth_key(spark.range(0).toDF("key"), "key", 10) is None
    staged = []
    stage = J.stage

    def watched(df, *a):
        staged.append(df.count())
        return stage(df, *a)
    J.stage, st = watched, store(scratch)
    try:
        J.run_job(spark, spec(scratch, range(1, 5001), batch=10, cap=30), st)
    finally:
        J.stage = stage
    assert staged == [30, 3]                        # the rows copied and their pages; nothing of the backlog


@pytest.mark.parametrize("few", [100_000, 3])
def test_copies_of_a_key_share_a_page_either_way(spark, scratch, monkeypatch, few):
    monkeypatch.setattr(J, "FEW_KEYS", few)
    monkeypatch.setattr(J, "BUCKET", 2)
    keys = [1, 2, 2, 2, 2, 3, 4, 5, 5, 6, 7, 8, 9, 9]
    sp, st = spec(scratch, keys, batch=2, cap=6), store(scratch)
    sums = [J.run_job(spark, spec(scratch, keys[:5], batch=2), st)["records_read"], J.run_job(spark, replace(sp, max_records=None, batch_size=1, pages_per_commit=2, extract=rows_extract(keys[:7])), st)["records_read"]]
    while (r := J.run_job(spark, sp, st))["pages"]:
        sums.append(r["records_read"])
    assert target_keys(spark, sp, st) == keys and sum(sums) == len(keys) and len(sums) > 1
    h = [(x.source_row_id_from, x.source_row_id_to) for x in history(spark, st) if x.status == "Success"]
    assert all(a[1] < b[0] for a, b in zip(h, h[1:]))


def test_a_gap_is_repaired_without_moving_the_cursor(spark, scratch):
    st = store(scratch)
    J.run_job(spark, spec(scratch, range(1, 11), batch=3), st)
    J.rewind(spark, st, "JOB1", 20)
    sp = spec(scratch, range(1, 31), batch=3)
    J.run_job(spark, sp, st)
    gaps = H.copied_gaps(J.read_history(spark, st), "JOB1")
    assert [tuple(r) for r in gaps.collect()] == [(11, 20)]

    def lost(commit_id):
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        J.repair_gaps(spark, sp, st, before_history=lost)
    assert target_keys(spark, sp, st) == [*range(1, 11), *range(21, 31)]
    got = J.repair_gaps(spark, sp, st)
    assert (got["read"], got["first"], got["last"], got["pages"]) == (10, 11, 20, 4)
    assert target_keys(spark, sp, st) == list(range(1, 31))
    assert J.current_cursor(spark, st, "JOB1") == (30, 1)
    assert J.repair_gaps(spark, sp, st)["read"] == 0 and gaps.count() == 1 and H.copied_gaps(J.read_history(spark, st), "JOB1").count() == 0
    # Rows that became eligible inside a covered range, named by the caller; copied ones stay single.
    late = spec(scratch, range(0, 35), batch=3)
    assert J.repair_gaps(spark, late, st, ranges=[(0, 5), (28, 99)])["read"] == 1
    assert target_keys(spark, sp, st) == list(range(0, 31))


def test_gaps_in_several_slices(spark, scratch, monkeypatch):
    monkeypatch.setattr(J, "GAPS_AT_ONCE", 2)
    st = store(scratch)
    J.run_job(spark, spec(scratch, [k for k in range(1, 41) if k % 10], batch=5), st)
    got = J.repair_gaps(spark, spec(scratch, range(1, 60), batch=5), st, ranges=[(k, k) for k in (10, 20, 30, 50)])
    assert got["read"] == 3
    assert target_keys(spark, spec(scratch, []), st) == [k for k in range(1, 41) if k != 40]


def ordered(df):
    return Q.key_order(df, "key").first()["ordered"]


def test_key_order_within_and_across_partitions(spark):
    def of(*parts):
        rows = [(p, i, k) for p, keys in enumerate(parts) for i, k in enumerate(keys)]
        rdd = spark.sparkContext.parallelize(range(len(parts)), len(parts)).flatMap(lambda p: [(k,) for q, _, k in rows if q == p])
        return spark.createDataFrame(rdd, "key long")
    assert ordered(of([1, 2, 2], [], [2, 5])) and ordered(of([None, None, 1], [3])) and ordered(of([]))
    assert not ordered(of([1, 3, 2])) and not ordered(of([1, 5], [], [4])) and not ordered(of([1, None])) and not ordered(of([1], [None]))
    assert ordered(spark.range(100).toDF("key")) and not ordered(spark.range(100, 0, -1).toDF("key"))


def test_a_run_leaves_no_staging_behind(spark, scratch):
    import glob
    before = set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/tidemark/stage-*"))
    st = store(scratch)
    J.run_job(spark, spec(scratch, range(1, 20), batch=2, cap=8), st)
    J.run_job(spark, replace(spec(scratch, [], batch=2, extract=bad_last(30)), target_types=[("name_col", "string(6)")]), st)
    J.full_reload(spark, spec(scratch, range(1, 9), batch=2), st)
    assert set(glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/tidemark/stage-*")) == before


def test_unknown_status_is_refused(spark, scratch):
    st = store(scratch)
    J.ensure_history(spark, st)
    with pytest.raises(Exception, match="unknown run status"):
        J.append_history(spark, st, [J._history_row(spec(scratch, []), 1, "Done", None, None, "h", 1.0) | {"started_utc": J.utc_now()}])


def test_a_source_is_read_once_a_run(spark, scratch):
    """Capped, uncapped, with few and with many keys: the extract is evaluated once."""
    def read(cap, keys, at="few"):
        seen = spark.sparkContext.accumulator(0)

        def counted(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch
        sp = spec(f"{scratch}/{cap}-{at}", [], batch=10, cap=cap or 10, ppc=2,
                  extract=lambda s, p: s.range(1, keys + 1).selectExpr("id AS key", "'x' AS name").mapInArrow(counted, "key long, name string"))
        st = store(f"{scratch}/{cap}-{at}")
        assert J.run_job(spark, replace(sp, max_records=cap), st)["records_read"] == min(cap or keys, keys)
        return seen.value
    assert read(30, 500) == 500 and read(None, 500) == 500
    J.FEW_KEYS, few = 50, J.FEW_KEYS
    try:
        assert read(None, 500, "many") == 500
    finally:
        J.FEW_KEYS = few


@pytest.mark.parametrize("few", [100_000, 3])
def test_catching_up_leaves_what_capped_runs_leave(spark, scratch, monkeypatch, few):
    """One extract for the whole backlog; pages, commits and runs as one capped run after another makes them."""
    monkeypatch.setattr(J, "FEW_KEYS", few)
    left, calls = {}, {True: 0, False: 0}
    for catch_up in (False, True):
        def extract(s, p):
            calls[catch_up] += 1
            return rows_extract(range(1, 58))(s, p)
        sp, st = spec(f"{scratch}/{catch_up}", [], batch=2, cap=10, ppc=2, extract=extract), store(f"{scratch}/{catch_up}")
        while J.sync_tables(spark, [sp], st, catch_up=catch_up).first().status == "Success":
            pass
        h = history(spark, st)
        runs = [x.sync_run for x in h]
        left[catch_up] = ([(x.run_id, x.status, x.source_row_id_from, x.source_row_id_to, x.records_read, x.commit_id) for x in h],
                          [sorted(set(runs), key=runs.index).index(r) for r in runs], target_keys(spark, sp, st))
    assert left[True] == left[False] and left[True][2] == list(range(1, 58))
    assert calls == {False: 7, True: 2}


def test_a_lost_catch_up_goes_on_after_its_commits(spark, scratch):
    steps = []

    def lost(commit_id):
        steps.append(commit_id)
        if len(steps) == 3:
            raise RuntimeError("lost")
    sp, st = spec(scratch, range(1, 42), batch=2, cap=4, ppc=1), store(scratch)
    assert J.run_job(spark, sp, st, before_history=lost, catch_up=True)["status"] == "Failed"
    assert target_keys(spark, sp, st) == [1, 2, 3, 4]
    assert J.run_job(spark, sp, st, catch_up=True)["records_read"] == 37
    assert target_keys(spark, sp, st) == list(range(1, 42))


def test_copies_beyond_a_cap_are_fetched(spark, scratch):
    sp, st = spec(scratch, [1, 2, 2, 2, 3], batch=2, cap=2), store(scratch)
    assert J.run_job(spark, sp, st)["records_read"] == 4 and target_keys(spark, sp, st) == [1, 2, 2, 2]
    assert J.run_job(spark, sp, st)["records_read"] == 1 and target_keys(spark, sp, st) == [1, 2, 2, 2, 3]


def test_a_stream_of_many_files_has_a_bounded_number_of_batches(spark, scratch, monkeypatch):
    from tidemark import catalog as C
    monkeypatch.setattr(C, "STREAM_LOADS", 2)
    orders = spark.range(1, 41).selectExpr("id AS o_orderkey", "id % 5 AS o_custkey", "'F' AS o_orderstatus", "1D AS o_totalprice",
                                           "timestamp_ntz'1998-01-01' AS o_orderdate", "'1-URGENT' AS o_orderpriority")
    orders.repartition(6).write.parquet(f"{scratch}/orders.parquet")
    spark.range(5).selectExpr("id AS c_custkey", "'n' AS c_name", "1 AS c_nationkey", "1D AS c_acctbal", "'M' AS c_mktsegment").write.parquet(f"{scratch}/customer.parquet")
    spark.range(2).selectExpr("CAST(id AS INT) AS n_nationkey", "'N' AS n_name").write.parquet(f"{scratch}/nation.parquet")
    sp, hist = C._streamed(spark, scratch)
    batches = {r[0] for r in hist.select(F.regexp_extract("commit_id", r"b(\d+)-c", 1)).collect()}
    assert 1 <= len(batches) <= 2
    assert target_keys(spark, sp, J.Store(sp.target_location.replace("/target", "/history"))) == list(range(1, 41))
