"""The stream by key: bounded batches, restarts, odd keys."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.types import IntegerType, LongType, StringType, StructType

from tidemark.plans import job as J
from tidemark.streaming import key_source as KS
from tidemark.streaming import stream as STR

SCHEMA = StructType().add("key", LongType()).add("name", StringType())


def put(spark, folder, keys, files=1):
    rows = spark.createDataFrame([(k, f"Row{k}") for k in keys], SCHEMA)
    rows.repartition(files).write.mode("append").parquet(folder)


def setup(scratch, **kw):
    spec = J.JobSpec("KEYS", lambda s, p: None, f"{scratch}/target", ["k", "n"], batch_size=2, **kw)
    return spec, J.Store(f"{scratch}/history", f"{scratch}/overrides")


def copied(spark, spec, store):
    history = J.read_history(spark, store)
    from tidemark.operators import sink as K
    return sorted(r.k for r in K.read_target(spark, spec.target_location, history, spec.job_key).collect())


def batches(spark, store):
    rows = J.read_history(spark, store).filter("status = 'Success'").selectExpr(
        r"cast(regexp_extract(commit_id, 'b(\\d+)-c', 1) as int) AS b", "records_inserted AS n").groupBy("b").sum("n").orderBy("b")
    return [r[1] for r in rows.collect()]


def test_batches_hold_at_most_the_rows_asked_for(spark, scratch):
    spec, store = setup(scratch)
    put(spark, f"{scratch}/in", [*range(1, 12), None], files=3)         # keys lie across the files
    assert STR.stream_sync_by_key(spark, f"{scratch}/in", SCHEMA, spec, store, f"{scratch}/ck", 4) == 3
    assert copied(spark, spec, store) == list(range(1, 12)) and batches(spark, store) == [4, 4, 3]
    put(spark, f"{scratch}/in", range(12, 14))
    assert STR.stream_sync_by_key(spark, f"{scratch}/in", SCHEMA, spec, store, f"{scratch}/ck", 4) == 1
    assert copied(spark, spec, store) == list(range(1, 14))
    assert STR.stream_sync_by_key(spark, f"{scratch}/in", SCHEMA, spec, store, f"{scratch}/ck", 4) == 0


def test_a_key_is_never_split(spark, scratch):
    spec, store = setup(scratch)
    put(spark, f"{scratch}/in", [1, 2, 2, 2, 2, 2, 3, 4, 4, 5], files=2)
    STR.stream_sync_by_key(spark, f"{scratch}/in", SCHEMA, spec, store, f"{scratch}/ck", 3)
    assert copied(spark, spec, store) == [1, 2, 2, 2, 2, 2, 3, 4, 4, 5] and batches(spark, store) == [1, 5, 3, 1]


@pytest.mark.parametrize("at", [3, 5])
def test_restart_in_the_middle_of_a_batch(spark, scratch, at):
    """Lost in the first batch or in the second: no row is lost or doubled."""
    spec, store = setup(scratch, pages_per_commit=1)
    put(spark, f"{scratch}/in", range(1, 21), files=2)
    calls = []

    def lost(commit_id):
        calls.append(commit_id)
        if len(calls) == at:
            raise RuntimeError("lost")
    with pytest.raises(Exception, match="lost"):
        STR.stream_sync_by_key(spark, f"{scratch}/in", SCHEMA, spec, store, f"{scratch}/ck", 8, before_history=lost)
    assert copied(spark, spec, store) == list(range(1, {3: 5, 5: 11}[at]))    # steps of 1, 1 and 2 pages
    assert STR.stream_sync_by_key(spark, f"{scratch}/in", SCHEMA, spec, store, f"{scratch}/ck", 8) == {3: 3, 5: 2}[at]
    assert copied(spark, spec, store) == list(range(1, 21)) and batches(spark, store) == [8, 8, 4]


def test_a_new_checkpoint_starts_after_the_cursor_and_a_rewind_needs_one(spark, scratch):
    spec, store = setup(scratch)
    put(spark, f"{scratch}/in", range(1, 11))
    J.ensure_history(spark, store)
    J.rewind(spark, store, "KEYS", 4)
    STR.stream_sync_by_key(spark, f"{scratch}/in", SCHEMA, spec, store, f"{scratch}/ck", 3)
    assert copied(spark, spec, store) == list(range(5, 11))
    J.rewind(spark, store, "KEYS", 0)
    with pytest.raises(ValueError, match="new checkpoint"):
        STR.stream_sync_by_key(spark, f"{scratch}/in", SCHEMA, spec, store, f"{scratch}/ck", 3)


def test_no_rows_and_bad_arguments(spark, scratch):
    spec, store = setup(scratch)
    put(spark, f"{scratch}/in", [])
    STR.stream_sync_by_key(spark, f"{scratch}/in", SCHEMA, spec, store, f"{scratch}/ck", 3)
    assert J.current_cursor(spark, store, "KEYS")[0] == 0
    with pytest.raises(ValueError, match="integer"):
        KS.key_source(spark, scratch, StructType().add("name", StringType()).add("key", IntegerType()), 3)
    with pytest.raises(ValueError, match="at least 1"):
        KS.key_source(spark, scratch, SCHEMA, 0)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-20, 20), min_size=1), st.integers(1, 8))
def test_cut_key(keys, most):
    keys = sorted(keys)
    cut = KS.cut_key(np.array(keys[:most + 1]), most)
    held = [k for k in keys if k <= cut]
    assert held and (len(held) <= most or len(set(held)) == 1)
    assert len(held) == len(keys) or len([k for k in keys if k <= keys[len(held)]]) > most
