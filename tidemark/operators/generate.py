"""Set-based test-data generators.  Each takes a seed frame with a 1-based ``n``
column (from ``spark.range`` or from a table) and derives every value from ``n``:
no loops, no driver-side rows, and reproducible pseudo-random values
(``scalars.rand_int``: integer arithmetic any SQL engine reproduces) where the original used random numbers.

Fixed values of the seed scripts: ``REF`` + 10 digits, ``ID`` + 8 digits,
``Test Customer <n>``, birth date ``10950 + n % 18250`` days back, ``FOREIGN``
when ``n % 5 = 0`` else ``MY``, user ``system``, entity ``1 + n % 5`` as 3
digits, status ``OK``, years 2023-2026, limit ``10000 + n % 50000``, balance
``5000 + n % 20000``, response time ``day + (n % 86400)`` seconds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import add_days, add_seconds, col_or_lit, concat_text, dmy, rand_int, ts_lit, zero_pad

SECONDS_PER_DAY = 86400


def seeds_from(df: DataFrame, key: str) -> DataFrame:
    """Seed rows ``n = key + 1`` from an existing table (one per row)."""
    return df.select((F.col(key) + 1).cast("long").alias("n"))


def _child(n: Column, ident: Column, d: Column, dob_base, dtl_id: Column, raw_id: Column) -> list:
    return [
        ident.alias("row_id"), dtl_id.alias("dtl_row_id"), raw_id.alias("raw_report_id"),
        F.concat(F.lit("REF"), zero_pad(ident, 10)).alias("ref_no"),
        F.concat(F.lit("ID"), zero_pad(ident, 8)).alias("cust_id1"),
        F.lit(None).cast("string").alias("cust_id2"),
        concat_text("Test Customer ", ident.cast("string")).alias("cust_name"),
        add_days(ts_lit(dob_base), -(F.lit(10950) + ident % 18250)).alias("cust_dob"),
        F.when(n % 5 == 0, "FOREIGN").otherwise("MY").alias("nationality"),
        d.alias("imported_at"), F.lit("system").alias("user_id"),
        zero_pad(F.lit(1) + n % 5, 3).alias("entity"),
        F.lit("OK").alias("status_detailed"), d.alias("responded_at"),
    ]


def gen_dated_pairs(seeds: DataFrame, plan: Sequence[tuple]) -> tuple[DataFrame, DataFrame]:
    """Parent/child pairs with ``row_id = n``; the first ``plan[0][1]`` seeds are dated
    ``plan[0][0]``, the next ``plan[1][1]`` the second day, and so on (counts may be
    scalar Columns).  Returns (parent, child)."""
    n = F.col("n")
    total = None
    day = None
    for date, count in plan:
        total = col_or_lit(count) if total is None else total + col_or_lit(count)
        day = F.when(n <= total, ts_lit(date)) if day is None else day.when(n <= total, ts_lit(date))
    s = seeds.filter((n >= 1) & (n <= total)).withColumn("_d", add_seconds(day, n % SECONDS_PER_DAY))
    d = F.col("_d")
    parent = s.select(n.alias("row_id"), F.lit("OK").alias("status"), d.alias("responded_at"))
    child = s.select(*_child(n, n, d, plan[-1][0], n, n))
    return parent, child


def _parent_values(n: Column) -> list:
    return ([F.lit(2023).alias("from_year"), F.lit(2026).alias("to_year")]
            + [F.lit("0").alias(f"m{i}") for i in range(1, 13)])


def gen_linked(seeds: DataFrame, seed_date, base_child=0, base_raw=0, base_header=0):
    """Child + raw report + detail header per seed, ids continuing after the given
    bases (``ISNULL(MAX(id), 0)``).  Returns (child, raw_report, detail_header)."""
    n = F.col("n")
    s = seeds.withColumn("_d", add_seconds(ts_lit(seed_date), n % SECONDS_PER_DAY))
    d = F.col("_d")
    child_id = col_or_lit(base_child) + n
    raw_id = col_or_lit(base_raw) + n
    hdr_id = col_or_lit(base_header) + n
    limit = (F.lit(10000) + n % 50000).cast("decimal(18,2)")
    balance = (F.lit(5000) + n % 20000).cast("decimal(18,2)")
    child = s.select(*_child(n, child_id, d, seed_date, hdr_id, raw_id))
    raw = s.select(raw_id.alias("row_id"), d.alias("responded_at"), F.lit("OK").alias("status"),
                   F.lit(None).cast("string").alias("error_message"),
                   F.lit(None).cast("string").alias("b2b_error_message"), *_parent_values(n),
                   limit.alias("total_limit"), balance.alias("total_outstanding"),
                   F.lit(None).cast("string").alias("special_name"))
    header = s.select(hdr_id.alias("row_id"), F.lit("OK").alias("status"),
                      F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("warning"),
                      *_parent_values(n), limit.alias("lim_tot"), balance.alias("bal_tot"),
                      F.lit(None).cast("string").alias("special_name"))
    return child, raw, header


def gen_target_dummy(seeds: DataFrame, year: int = 2026, seed: int = 42) -> DataFrame:
    """Dummy profile-target rows: random day and time in ``year``, random birth date
    18-79 years back, cyclic nationality / code / statuses."""
    n = F.col("n")
    start = dt.date(year, 1, 1)
    day_offset = rand_int(365, seed, n, 1)
    ms_offset = rand_int(SECONDS_PER_DAY * 1000, seed, n, 2)
    created = F.timestamp_add("MILLISECOND", ms_offset, add_days(ts_lit(start), day_offset))
    years_ago = F.lit(18) + rand_int(62, seed, n, 3)
    dob = add_days(F.timestamp_add("YEAR", -years_ago, ts_lit(start)), -rand_int(365, seed, n, 4))
    return seeds.select(
        n.alias("cms_no"),
        zero_pad(rand_int(999999999999, seed, n, 5), 12).alias("id_no1"),
        F.when(n % 4 == 0, F.concat(F.lit("A"), zero_pad(rand_int(99999999, seed, n, 6), 8)))
        .alias("id_no2"),
        concat_text("Test Customer ", n.cast("string")).alias("name1"),
        dmy(dob).alias("dob"),
        F.when(n % 10 == 0, "SG").when(n % 10 == 1, "ID").when(n % 10 == 2, "PH").otherwise("MY")
        .alias("nationality"),
        created.alias("create_date"),
        F.lit("BATCH").alias("last_update_by"),
        zero_pad(rand_int(99999999999, seed, n, 7), 11).alias("ent_key"),
        zero_pad(n, 10).alias("ref_no"),
        F.when(n % 2 == 0, "SCP").otherwise("USC").alias("txn_code"),
        F.when(n % 3 == 0, "NEW").when(n % 3 == 1, "SENT").otherwise("FAILED").alias("status"),
        F.when(n % 3 == 0, "PENDING").when(n % 3 == 1, "SUCCESS").otherwise("ERROR").alias("cms_status"),
    )
