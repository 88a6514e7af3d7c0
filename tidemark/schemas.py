"""Canonical schemas of the sync data model.

Column names are ours; widths are the declared target widths that the
width-fit check (``quality.width_fit``) compares against.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Run history: one row per committed page, per empty run and per failure.
HISTORY_SCHEMA = T.StructType([
    T.StructField("run_id", T.LongType(), False),
    T.StructField("sync_key", T.StringType(), False),
    T.StructField("started_utc", T.TimestampNTZType(), False),
    T.StructField("completed_utc", T.TimestampNTZType(), True),
    T.StructField("status", T.StringType(), False),
    T.StructField("source_row_id_from", T.LongType(), True),
    T.StructField("source_row_id_to", T.LongType(), True),
    T.StructField("target_key_from", T.LongType(), True),
    T.StructField("target_key_to", T.LongType(), True),
    T.StructField("records_read", T.IntegerType(), False),
    T.StructField("records_inserted", T.IntegerType(), False),
    T.StructField("error_message", T.StringType(), True),
    T.StructField("host_machine", T.StringType(), True),
    T.StructField("duration_seconds", T.DoubleType(), True),
    T.StructField("commit_id", T.StringType(), True),
    # The scheduled run that the row belongs to (all jobs of one sync_tables call).
    T.StructField("sync_run", T.StringType(), True),
    # The target folder that holds the page's rows; several commits share one.  NULL (older
    # rows): the folder is named by the commit.
    T.StructField("data_id", T.StringType(), True),
    # Epoch of the full reload that wrote the row.  A reload ends with a Success row without
    # a commit: only from then on its pages count, and older ones no longer do.
    T.StructField("reload", T.IntegerType(), True),
])

HISTORY_COLUMNS = [f.name for f in HISTORY_SCHEMA.fields if f.name not in ("commit_id", "sync_run", "data_id", "reload")]

# The three run outcomes the history records.
STATUS_SUCCESS = "Success"
STATUS_NO_NEW_DATA = "NoNewData"
STATUS_FAILED = "Failed"
STATUSES = (STATUS_SUCCESS, STATUS_NO_NEW_DATA, STATUS_FAILED)

# Resume-cursor overrides written by ``history.rewind``.
OVERRIDE_SCHEMA = T.StructType([
    T.StructField("sync_key", T.StringType(), False),
    T.StructField("epoch", T.IntegerType(), False),
    T.StructField("cursor", T.LongType(), False),
    T.StructField("after_run_id", T.LongType(), False),
])

# Target shape of the profile job (11 copied columns, 2 never filled) with widths.
PROFILE_TARGET = [
    ("cms_no", None), ("id_no1", 50), ("id_no2", 50), ("name1", 255), ("dob", 10),
    ("nationality", 10), ("create_date", None), ("last_update_by", 20), ("ent_key", 20),
    ("ref_no", 20), ("txn_code", 10),
]
PROFILE_UNFILLED = [("status", 50), ("cms_status", 50)]
PROFILE_COLUMNS = [c for c, _ in PROFILE_TARGET]

# Target shape of the response job (22 columns).
RESPONSE_TARGET = (
    [("rsp_cms_no", None), ("rsp_entry_date", None), ("rsp_mode", 50), ("rsp_error", None),
     ("rsp_warning", None), ("rsp_from_year", None), ("rsp_to_year", None)]
    + [(f"rsp_mom{i}", 50) for i in range(1, 13)]
    + [("rsp_lim_tot", 25), ("rsp_bal_tot", 25), ("rsp_special_name", 255)]
)
RESPONSE_COLUMNS = [c for c, _ in RESPONSE_TARGET]
