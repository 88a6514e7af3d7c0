"""The derived views of ``tables.py`` as DuckDB SQL, for the correctness oracle.

Only the driver's raw tables are registered in the oracle engine, so each oracle
query starts with ``WITH`` clauses built from these texts.
"""

from __future__ import annotations

REPORT = """report AS (
  SELECT o.o_orderkey AS row_id,
    CASE WHEN o.o_orderkey % 7 = 0 THEN 0 ELSE o.o_orderkey END AS dtl_row_id,
    o.o_orderkey AS raw_report_id,
    CASE WHEN o.o_orderkey % 50 = 3 THEN NULL
         ELSE concat('REF', right(concat('0000000000', CAST(o.o_custkey AS VARCHAR)), 10)) END AS ref_no,
    concat('ID', right(concat('00000000', CAST(o.o_custkey AS VARCHAR)), 8)) AS cust_id1,
    CASE WHEN o.o_orderkey % 4 = 0 THEN concat('A', CAST(o.o_orderkey AS VARCHAR)) END AS cust_id2,
    c.c_name AS cust_name, o.o_orderdate AS cust_dob, n.n_name AS nationality,
    o.o_orderdate AS imported_at, o.o_orderpriority AS user_id, c.c_mktsegment AS entity,
    CASE o.o_orderstatus WHEN 'F' THEN 'OK' WHEN 'O' THEN 'PENDING' ELSE 'FAIL' END AS status_detailed,
    o.o_orderdate AS responded_at
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

_MONTHS = ",\n    ".join(
    f"CAST(count(CASE WHEN month(l_shipdate) = {m} THEN 1 END) AS VARCHAR) AS m{m}"
    for m in range(1, 13))

RAW_REPORT = f"""raw_report AS (
  SELECT l_orderkey AS row_id, max(l_shipdate) AS responded_at,
    CASE WHEN min(l_returnflag) = 'A' THEN 'OK' ELSE 'ERR' END AS status,
    CASE WHEN min(l_returnflag) = 'A' THEN NULL ELSE concat('E', min(l_returnflag)) END AS error_message,
    CASE WHEN count(*) > 5 THEN 'many lines' END AS b2b_error_message,
    CAST(year(min(l_shipdate)) AS INT) AS from_year, CAST(year(max(l_shipdate)) AS INT) AS to_year,
    {_MONTHS},
    CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_limit,
    CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_outstanding,
    max(l_linestatus) AS special_name
  FROM lineitem GROUP BY l_orderkey)"""

_HEADER_MONTHS = ",\n    ".join(
    f"CASE WHEN month(o_orderdate) = {m} THEN '1' ELSE '0' END AS m{m}" for m in range(1, 13))

DETAIL_HEADER = f"""detail_header AS (
  SELECT o_orderkey AS row_id,
    CASE WHEN o_orderstatus = 'P' THEN 'HOLD' ELSE 'OK' END AS status,
    CASE WHEN o_orderstatus = 'P' THEN concat('partial ', o_orderpriority) END AS error,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'urgent' END AS warning,
    CAST(year(o_orderdate) AS INT) AS from_year, CAST(year(o_orderdate) + 1 AS INT) AS to_year,
    {_HEADER_MONTHS},
    CAST(o_totalprice AS DECIMAL(18,2)) AS lim_tot,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) - CAST(1 AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS bal_tot,
    o_orderpriority AS special_name
  FROM orders)"""

SYNC_HISTORY = """sync_history AS (
  SELECT event_id + 1 AS run_id, concat('JOB', CAST(user_id % 5 AS VARCHAR)) AS sync_key,
    ts AS started_utc, CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS completed_utc,
    CASE event_type WHEN 'error' THEN 'Failed' WHEN 'view' THEN 'NoNewData' ELSE 'Success' END AS status,
    CASE WHEN event_type IN ('error','view') THEN NULL ELSE event_id * 100 + 1 END AS source_row_id_from,
    CASE WHEN event_type IN ('error','view') THEN NULL ELSE event_id * 100 + 100 END AS source_row_id_to,
    CASE WHEN event_type IN ('error','view') THEN NULL ELSE event_id * 100 + 1 END AS target_key_from,
    CASE WHEN event_type IN ('error','view') THEN NULL ELSE event_id * 100 + 100 END AS target_key_to,
    CAST(CASE WHEN event_type IN ('error','view') THEN 0 ELSE 100 END AS INT) AS records_read,
    CAST(CASE WHEN event_type IN ('error','view') THEN 0 ELSE 100 END AS INT) AS records_inserted,
    CASE WHEN event_type = 'error' THEN concat('boom ', CAST(event_id AS VARCHAR), chr(10), 'at step') END AS error_message,
    concat('host', CAST(user_id % 3 AS VARCHAR)) AS host_machine, value AS duration_seconds
  FROM events)"""

TARGET_PROFILE = """target_profile AS (
  SELECT row_id AS cms_no, ref_no, imported_at AS create_date FROM report
  WHERE row_id > 0 AND row_id <= (SELECT max(row_id) * 4 // 5 FROM report) AND row_id % 13 <> 0
  UNION ALL
  SELECT row_id AS cms_no, ref_no, imported_at AS create_date FROM report
  WHERE row_id > 0 AND row_id <= (SELECT max(row_id) * 4 // 5 FROM report) AND row_id % 170 = 1)"""

TARGET_CURSOR_SQL = "(SELECT max(row_id) * 4 // 5 FROM report)"

QUEUE = """queue AS (
  SELECT o_orderkey AS row_id,
    concat('ID', right(concat('00000000', CAST(o_custkey AS VARCHAR)), 8)) AS id_no,
    o_orderdate AS create_date, CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
    CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS sent
  FROM orders)"""

SENT_LOG = """sent_log AS (SELECT DISTINCT cms_no AS row_id FROM target_profile)"""

VIEWS = {
    "report": REPORT, "raw_report": RAW_REPORT, "detail_header": DETAIL_HEADER,
    "sync_history": SYNC_HISTORY, "target_profile": TARGET_PROFILE, "queue": QUEUE,
    "sent_log": SENT_LOG,
}
# Views that other views read from.
DEPENDS = {"target_profile": ["report"], "sent_log": ["target_profile"]}


def with_views(*names: str) -> str:
    """``WITH`` prefix holding the named views (and what they depend on), in order."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return "WITH " + ",\n".join(VIEWS[n] for n in order) + "\n"
