"""Plan assertions: the physical plans are the ones we want at scale."""

import datetime as dt

from tidemark.operators import extract as X
from tidemark.operators import history as H
from tidemark.operators import paging as P
from tidemark.sources import tables as T

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def full_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()   # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_cursor_pushed_to_parquet_scan(spark):
    ext = X.profile_extract(T.report(spark, SF), T.raw_report(spark, SF), dt.date(1998, 6, 15), 400,
                            cursor=700)
    text = plan(ext)
    assert "GreaterThan(o_orderkey,700)" in text.replace(" ", "")


def test_extract_reads_each_table_once_and_projects(spark):
    ext = X.profile_extract(T.report(spark, SF), T.raw_report(spark, SF), dt.date(1998, 6, 15), 400)
    text = plan(ext)
    assert text.count("orders.parquet") == 1
    assert text.count("lineitem.parquet") == 1
    # the parent side only reads the columns the view needs
    assert "l_discount" not in text and "l_tax" not in text


def test_dense_index_has_no_single_partition(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    idx = P.dense_index(df, "k")
    text = full_plan(idx)
    assert "SinglePartition" not in text
    got = sorted(r[0] for r in idx.select("idx").collect())
    assert got == list(range(5000))


def test_recent_runs_limits_before_shuffle(spark):
    text = plan(H.recent_runs(T.sync_history(spark, SF), 5))
    assert "WindowGroupLimit" in text


def test_status_is_one_aggregate(spark):
    from tidemark.operators import monitor as M
    text = plan(M.sync_status(T.sync_history(spark, SF), dt.datetime(2024, 1, 31), 60))
    assert text.count("Exchange hashpartitioning") == 1


def _before_first_exchange(text: str, op: str) -> bool:
    """True when ``op`` appears below (map side of) some hash exchange in the plan text."""
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for below in lines[i + 1:]:
                if len(below) - len(below.lstrip(" :+-")) <= depth:
                    break
                if op in below:
                    return True
    return False


def test_parent_view_combines_map_side(spark):
    # A parent key holding a third of all lines must send one partial row per map
    # task, so the partial aggregate sits below the shuffle.
    text = plan(T.raw_report(spark, SF))
    assert "REPARTITION_BY_COL" not in text
    assert _before_first_exchange(text, "partial_max(l_shipdate")


def test_extract_winner_combines_map_side(spark):
    ext = X.profile_extract(T.report(spark, SF), T.raw_report(spark, SF), dt.date(1998, 6, 15), 400)
    assert _before_first_exchange(plan(ext), "partial_max_by")


def test_override_join_is_broadcast_at_run_time(spark):
    # No hint: AQE sees one override row per job and broadcasts it.
    hist = T.sync_history(spark, SF)
    ov = spark.createDataFrame([("JOB1", 1, 5, 10)], "sync_key string, epoch int, cursor long, after_run_id long")
    text = full_plan(H.resume_cursor(hist, None, ov))
    assert "BroadcastHashJoin" in text.split("Initial Plan")[0]


def test_run_job_pushes_the_cursor_to_the_scan(spark, scratch):
    from tidemark import catalog as C
    from tidemark.plans import job as J
    spec = C.profile_job(spark, SF, scratch)
    src = spec.extract(spark, dict(spec.params, last_row_id=700, batch_size=1000))
    assert "GreaterThan(o_orderkey,700)" in plan(src).replace(" ", "")
    J.run_job(spark, spec, J.Store(f"{scratch}/history"))
