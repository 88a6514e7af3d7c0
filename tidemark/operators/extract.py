"""The extract: latest eligible row per business reference, from two branches.

Branch 1 ("direct") judges a child row by its own status; branch 2 ("joined") by
the status of its parent row.  Per reference (``ref_no``) each branch picks one
winner, the row with the highest key; branch 1 chooses its winner over
``[as_of - window, ∞)`` and then requires it to lie before ``as_of``, branch 2
chooses over ``[as_of - window, as_of)``.  NULL references never qualify.

Plan shape (one scan of the child, one join, one aggregate):

    child ─filter(ref_no, key > cursor)─┐
                                        ├─ left join on FK ─ filter(branch flags)
    parent ─filter(status, window)──────┘        │
                         groupBy(ref_no): max_by(row, key if branch 1),
                                          max_by(row, key if branch 2)
                                                 │
                                  inline the (≤ 2) winners per reference

``max_by`` is a declarative aggregate, so Spark combines map-side before the
shuffle: a reference holding a third of all rows still sends one partial row per
map task, never its whole group.  The join is left to AQE (broadcast when the
filtered parent is small at run time, sort-merge otherwise).
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import col_or_lit, dmy, midnight, truncate_text

BRANCH_DIRECT = 1
BRANCH_JOINED = 2

REPORT_PAYLOAD = ["row_id", "dtl_row_id", "ref_no", "cust_id1", "cust_id2", "cust_name",
                  "cust_dob", "nationality", "imported_at", "user_id", "entity", "responded_at"]
RAW_PAYLOAD = (["responded_at", "status", "error_message", "b2b_error_message", "from_year",
                "to_year"] + [f"m{i}" for i in range(1, 13)]
               + ["total_limit", "total_outstanding", "special_name"])


def winners(report: DataFrame, raw_report: DataFrame, as_of, window_days: int = 1,
            cursor=None, pick: str = "max", branches: Iterable[str] = ("direct", "joined"),
            dedup: bool = True, raw_columns: Iterable[str] = (), ok_status: str = "OK") -> DataFrame:
    """Winner rows of the chosen branches: ``branch`` plus the child payload columns
    (plus ``raw_<c>`` parent columns for branch 2 when ``raw_columns`` is given).

    ``cursor`` (int or scalar Column) keeps keys above it.  For ``pick="max"`` it is
    applied below the winner choice (safe: a group whose max is above the cursor
    keeps that max; any other group yields nothing), for ``pick="min"`` after it.
    ``dedup`` drops a branch-2 winner that branch 1 already returned (same key).
    """
    if pick not in ("max", "min"):
        raise ValueError("pick must be 'max' or 'min'")
    branches = tuple(branches)
    use_direct, use_joined = "direct" in branches, "joined" in branches
    if not (use_direct or use_joined):
        raise ValueError("at least one branch")
    raw_columns = list(raw_columns)
    lower, upper = midnight(as_of, window_days), midnight(as_of, 0)
    key = F.col("row_id")

    child = report.filter(F.col("ref_no").isNotNull())
    if cursor is not None and pick == "max":
        child = child.filter(key > col_or_lit(cursor))
    payload = [F.col(c) for c in REPORT_PAYLOAD]

    if use_joined:
        parent = (raw_report
                  .filter((F.col("status") == ok_status) & (F.col("responded_at") >= lower)
                          & (F.col("responded_at") < upper))
                  .select(F.col("row_id").alias("_parent_id"),
                          *[F.col(c).alias(f"raw_{c}") for c in raw_columns]))
        cands = child.join(parent, child.raw_report_id == parent._parent_id,
                           "left" if use_direct else "inner")
        payload += [F.col(f"raw_{c}") for c in raw_columns]
        joined_flag = F.col("_parent_id").isNotNull()
    else:
        cands = child
        joined_flag = F.lit(False)

    direct_flag = ((F.col("dtl_row_id") > 0) & (F.col("status_detailed") == ok_status)
                   & (F.col("responded_at") >= lower)) if use_direct else F.lit(False)
    cands = cands.filter(direct_flag | joined_flag)

    by = F.max_by if pick == "max" else F.min_by
    row = F.struct(*payload)
    aggs = []
    if use_direct:
        aggs.append(by(row, F.when(direct_flag, key)).alias("w1"))
    if use_joined:
        aggs.append(by(row, F.when(joined_flag, key)).alias("w2"))
    picked = cands.groupBy("ref_no").agg(*aggs)

    def above(w: str) -> Column:
        if cursor is not None and pick == "min":
            return F.col(f"{w}.row_id") > col_or_lit(cursor)
        return F.lit(True)

    items = []
    d_ok = None
    if use_direct:
        d_ok = F.col("w1").isNotNull() & (F.col("w1.responded_at") < upper) & above("w1")
        items.append(F.when(d_ok, F.struct(F.lit(BRANCH_DIRECT).alias("branch"), F.col("w1").alias("w"))))
    if use_joined:
        j_ok = F.col("w2").isNotNull() & above("w2")
        if dedup and d_ok is not None:
            j_ok = j_ok & ~(d_ok & (F.col("w1.row_id") == F.col("w2.row_id")))
        items.append(F.when(j_ok, F.struct(F.lit(BRANCH_JOINED).alias("branch"), F.col("w2").alias("w"))))

    rows = picked.select(F.inline(F.filter(F.array(*items), lambda x: x.isNotNull())))
    return rows.select("branch", "w.*")


def profile_rows(w: DataFrame, txn_codes=("SCP", "SCP"), keep_branch: bool = False) -> DataFrame:
    """Project winners to the 11-column profile target shape."""
    code = F.when(F.col("branch") == BRANCH_DIRECT, F.lit(txn_codes[0])).otherwise(F.lit(txn_codes[1]))
    cols = [
        F.col("row_id").alias("cms_no"),
        F.col("cust_id1").alias("id_no1"),
        F.col("cust_id2").alias("id_no2"),
        F.col("cust_name").alias("name1"),
        dmy(F.col("cust_dob")).alias("dob"),
        F.col("nationality"),
        F.col("imported_at").alias("create_date"),
        truncate_text(F.col("user_id"), 10).alias("last_update_by"),
        truncate_text(F.col("entity"), 16).alias("ent_key"),
        F.col("ref_no"),
        code.alias("txn_code"),
    ]
    return w.select(*(([F.col("branch")] if keep_branch else []) + cols))


def profile_extract(report: DataFrame, raw_report: DataFrame, as_of, window_days: int = 1,
                    cursor=None, dedup: bool = True, pick: str = "max",
                    branches=("direct", "joined"), keep_branch: bool = False,
                    txn_codes=("SCP", "SCP")) -> DataFrame:
    """The profile job's extract: one row per key (when ``dedup``), 11 columns."""
    w = winners(report, raw_report, as_of, window_days, cursor, pick, branches, dedup)
    return profile_rows(w, txn_codes, keep_branch)


def direct(report: DataFrame, as_of, window_days: int = 1, pick: str = "max", cursor=None) -> DataFrame:
    return profile_extract(report, report, as_of, window_days, cursor, pick=pick, branches=("direct",))


def joined(report: DataFrame, raw_report: DataFrame, as_of, window_days: int = 1,
           pick: str = "max", cursor=None) -> DataFrame:
    return profile_extract(report, raw_report, as_of, window_days, cursor, pick=pick,
                           branches=("joined",))


def response_extract(report: DataFrame, raw_report: DataFrame, detail_header: DataFrame, as_of,
                     window_days: int = 1, cursor=None, dedup: bool = True, pick: str = "max",
                     branches=("direct", "joined"), keep_branch: bool = False) -> DataFrame:
    """The response job's extract (22 columns).  Same winners as the profile job;
    branch 1 takes its response fields from the detail header (``dtl_row_id``),
    branch 2 from the raw report it was judged by."""
    w = winners(report, raw_report, as_of, window_days, cursor, pick, branches, dedup,
                raw_columns=RAW_PAYLOAD)
    hdr = detail_header.select(
        F.col("row_id").alias("_hdr_id"), F.col("status").alias("h_status"),
        F.col("error").alias("h_error"), F.col("warning").alias("h_warning"),
        F.col("from_year").alias("h_from_year"), F.col("to_year").alias("h_to_year"),
        *[F.col(f"m{i}").alias(f"h_m{i}") for i in range(1, 13)],
        F.col("lim_tot").alias("h_lim_tot"), F.col("bal_tot").alias("h_bal_tot"),
        F.col("special_name").alias("h_special_name"))
    for c in RAW_PAYLOAD:
        if f"raw_{c}" not in w.columns:
            w = w.withColumn(f"raw_{c}", F.lit(None))
    if "direct" in branches:
        w = w.join(hdr, (F.col("branch") == BRANCH_DIRECT) & (w.dtl_row_id == hdr._hdr_id), "left")
        w = w.filter((F.col("branch") != BRANCH_DIRECT) | F.col("_hdr_id").isNotNull())
    else:
        for c in hdr.columns:
            w = w.withColumn(c, F.lit(None))
    d = F.col("branch") == BRANCH_DIRECT

    def pick_col(h: str, r: str) -> Column:
        return F.when(d, F.col(h)).otherwise(F.col(r))

    cols = [
        F.col("row_id").alias("rsp_cms_no"),
        pick_col("responded_at", "raw_responded_at").alias("rsp_entry_date"),
        pick_col("h_status", "raw_status").alias("rsp_mode"),
        pick_col("h_error", "raw_error_message").alias("rsp_error"),
        pick_col("h_warning", "raw_b2b_error_message").alias("rsp_warning"),
        pick_col("h_from_year", "raw_from_year").alias("rsp_from_year"),
        pick_col("h_to_year", "raw_to_year").alias("rsp_to_year"),
        *[pick_col(f"h_m{i}", f"raw_m{i}").alias(f"rsp_mom{i}") for i in range(1, 13)],
        pick_col("h_lim_tot", "raw_total_limit").cast("string").alias("rsp_lim_tot"),
        pick_col("h_bal_tot", "raw_total_outstanding").cast("string").alias("rsp_bal_tot"),
        pick_col("h_special_name", "raw_special_name").alias("rsp_special_name"),
    ]
    return w.select(*(([F.col("branch")] if keep_branch else []) + cols))


def branch_top(extract_by_branch: DataFrame, key: str, batch: int) -> DataFrame:
    """Per-branch ``TOP (batch)`` made deterministic by key order, then ``UNION ALL``."""
    parts = [extract_by_branch.filter(F.col("branch") == b).orderBy(key).limit(batch)
             for b in (BRANCH_DIRECT, BRANCH_JOINED)]
    return parts[0].unionByName(parts[1])


def first_batch(extract: DataFrame, key: str, batch: int) -> DataFrame:
    """``TOP (batch) … ORDER BY key`` over the combined extract."""
    return extract.orderBy(key).limit(batch)


# Registry of named extracts (the "stored procedure" source kind): each takes the
# Spark session, the job parameters and returns a lazy DataFrame.
EXTRACTS: dict = {}


def register_extract(name: str):
    def deco(fn):
        EXTRACTS[name] = fn
        return fn
    return deco
