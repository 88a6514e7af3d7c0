"""Property: repeated runs drain any source exactly once."""

import uuid

from hypothesis import HealthCheck, given, settings, strategies as st

from tidemark.operators import sink as K
from tidemark.plans import job as J


# Each example writes below its own fresh folder, so sharing the function-scoped
# scratch fixture across examples is safe.
@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(0, 23), batch=st.integers(1, 5), cap_pages=st.integers(1, 4), ppc=st.integers(1, 3),
       gap=st.integers(1, 3))
def test_runs_drain_source_exactly_once(spark, scratch, n, batch, cap_pages, ppc, gap):
    keys = [1 + i * gap for i in range(n)]
    root = f"{scratch}/{uuid.uuid4().hex[:8]}"

    def extract(s, params):
        return s.createDataFrame([(k, f"Row{k}") for k in keys], "key long, name string")
    cap = batch * cap_pages
    sp = J.JobSpec("P", extract, f"{root}/t", ["k", "v"], batch_size=batch, max_records=cap, pages_per_commit=ppc)
    store = J.Store(f"{root}/h")
    statuses = []
    for _ in range(n // cap + 2):
        r = J.run_job(spark, sp, store)
        statuses.append(r["status"])
        assert r["records_read"] <= cap
        if r["status"] == "NoNewData":
            break
    assert statuses[-1] == "NoNewData" and "Failed" not in statuses
    hist = J.read_history(spark, store).orderBy("run_id").collect()
    pages = [h for h in hist if h.status == "Success"]
    assert sum(h.records_inserted for h in pages) == n
    assert all(h.records_read <= batch for h in pages)
    assert all(a.source_row_id_to < b.source_row_id_from for a, b in zip(pages, pages[1:]))
    copied = []
    if pages:
        df = K.read_target(spark, sp.target_location, J.read_history(spark, store), "P")
        copied = sorted(r.k for r in df.collect())
    assert copied == keys
