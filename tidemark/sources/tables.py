"""Driver tables and the sync data model derived from them.

The sync engine works on a child table (``report``), its parent (``raw_report``),
a second parent (``detail_header``), a run history and copied target rows.  The
driver ships TPC-H-like tables instead, so these functions derive the model
from them with plain DataFrame code; every view grows with the input tables.
``views_sql.py`` holds the same definitions as SQL text for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import zero_pad

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table, listing its files anew: files added since are seen."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Child rows keyed by ``row_id``; FK ``raw_report_id``; business ref ``ref_no``."""
    return report_from(load(spark, sf_dir, "orders"), load(spark, sf_dir, "customer"),
                       load(spark, sf_dir, "nation"))


def report_from(o: DataFrame, c: DataFrame, n: DataFrame) -> DataFrame:
    """The child view over given orders / customer / nation frames (orders may be a stream)."""
    key = F.col("o_orderkey")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, c.c_nationkey == n.n_nationkey)
        .select(
            key.alias("row_id"),
            F.when(key % 7 == 0, F.lit(0).cast("bigint")).otherwise(key).alias("dtl_row_id"),
            key.alias("raw_report_id"),
            F.when(key % 50 == 3, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("REF"), zero_pad(F.col("o_custkey"), 10))).alias("ref_no"),
            F.concat(F.lit("ID"), zero_pad(F.col("o_custkey"), 8)).alias("cust_id1"),
            F.when(key % 4 == 0, F.concat(F.lit("A"), key.cast("string"))).alias("cust_id2"),
            F.col("c_name").alias("cust_name"),
            F.col("o_orderdate").alias("cust_dob"),
            F.col("n_name").alias("nationality"),
            F.col("o_orderdate").alias("imported_at"),
            F.col("o_orderpriority").alias("user_id"),
            F.col("c_mktsegment").alias("entity"),
            F.when(F.col("o_orderstatus") == "F", "OK")
            .when(F.col("o_orderstatus") == "O", "PENDING")
            .otherwise("FAIL").alias("status_detailed"),
            F.col("o_orderdate").alias("responded_at"),
        )
    )


def raw_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parent rows, one per order that has line items (so some FKs are orphans)."""
    # Partial aggregation runs map-side before the shuffle (string min/max make it a
    # sort-based aggregate), so an order holding a third of all lines still sends
    # one partial row per map task.  Month and decimal casts are computed once per
    # line, below the aggregate.
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus", "l_shipdate",
        F.month("l_shipdate").alias("_month"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("_price"),
        F.col("l_quantity").cast("decimal(18,2)").alias("_qty"))
    flag = F.min("l_returnflag")
    return li.groupBy(F.col("l_orderkey").alias("row_id")).agg(
        F.max("l_shipdate").alias("responded_at"),
        F.when(flag == "A", "OK").otherwise("ERR").alias("status"),
        F.when(flag == "A", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("E"), flag)).alias("error_message"),
        F.when(F.count(F.lit(1)) > 5, "many lines").alias("b2b_error_message"),
        F.year(F.min("l_shipdate")).cast("int").alias("from_year"),
        F.year(F.max("l_shipdate")).cast("int").alias("to_year"),
        *[F.count(F.when(F.col("_month") == m, 1)).cast("string").alias(f"m{m}") for m in range(1, 13)],
        F.sum("_price").cast("decimal(18,2)").alias("total_limit"),
        F.sum("_qty").cast("decimal(18,2)").alias("total_outstanding"),
        F.max("l_linestatus").alias("special_name"),
    )


def detail_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second parent (``report.dtl_row_id → row_id``), one row per order."""
    o = load(spark, sf_dir, "orders")
    month = F.month("o_orderdate")
    total = F.col("o_totalprice").cast("decimal(18,2)")
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        F.when(F.col("o_orderstatus") == "P", "HOLD").otherwise("OK").alias("status"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("partial "), F.col("o_orderpriority")))
        .alias("error"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "urgent").alias("warning"),
        F.year("o_orderdate").cast("int").alias("from_year"),
        (F.year("o_orderdate") + 1).cast("int").alias("to_year"),
        *[F.when(month == m, "1").otherwise("0").alias(f"m{m}") for m in range(1, 13)],
        total.alias("lim_tot"),
        (total - F.lit(1).cast("decimal(18,2)")).cast("decimal(18,2)").alias("bal_tot"),
        F.col("o_orderpriority").alias("special_name"),
    )


def sync_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run history: five jobs, all three outcomes, NULL completions, two-line errors."""
    e = load(spark, sf_dir, "events")
    eid = F.col("event_id")
    no_range = F.col("event_type").isin("error", "view")
    lo = F.when(no_range, F.lit(None).cast("bigint")).otherwise(eid * 100 + 1)
    hi = F.when(no_range, F.lit(None).cast("bigint")).otherwise(eid * 100 + 100)
    rows = F.when(no_range, 0).otherwise(100).cast("int")
    return e.select(
        (eid + 1).alias("run_id"),
        F.concat(F.lit("JOB"), (F.col("user_id") % 5).cast("string")).alias("sync_key"),
        F.col("ts").alias("started_utc"),
        F.when(eid % 97 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("ts")).alias("completed_utc"),
        F.when(F.col("event_type") == "error", "Failed")
        .when(F.col("event_type") == "view", "NoNewData").otherwise("Success").alias("status"),
        lo.alias("source_row_id_from"), hi.alias("source_row_id_to"),
        lo.alias("target_key_from"), hi.alias("target_key_to"),
        rows.alias("records_read"), rows.alias("records_inserted"),
        F.when(F.col("event_type") == "error",
               F.concat(F.lit("boom "), eid.cast("string"), F.lit("\n"), F.lit("at step")))
        .alias("error_message"),
        F.concat(F.lit("host"), (F.col("user_id") % 3).cast("string")).alias("host_machine"),
        F.col("value").alias("duration_seconds"),
    )


def target_cursor(spark: SparkSession, sf_dir: str) -> Column:
    """Position the target was copied up to: four fifths of the highest key (lazy scalar).
    The key's own table holds it; the joins of ``report`` are not needed."""
    return load(spark, sf_dir, "orders").select(F.expr("max(o_orderkey) * 4 div 5")).scalar()


def target_profile(spark: SparkSession, sf_dir: str, rep: DataFrame | None = None) -> DataFrame:
    """Copied target rows below the cursor, with gaps (key % 13 = 0) and duplicates (key % 170 = 1)."""
    rep = rep if rep is not None else report(spark, sf_dir)
    below = rep.filter((F.col("row_id") > 0) & (F.col("row_id") <= target_cursor(spark, sf_dir)))
    cols = [F.col("row_id").alias("cms_no"), "ref_no", F.col("imported_at").alias("create_date")]
    copied = below.filter(F.col("row_id") % 13 != 0).select(*cols)
    doubled = below.filter(F.col("row_id") % 170 == 1).select(*cols)
    return copied.unionByName(doubled)


def queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retired flag queue ``(row_id, id_no, create_date, amount, sent)``."""
    o = load(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("row_id"),
        F.concat(F.lit("ID"), zero_pad(F.col("o_custkey"), 8)).alias("id_no"),
        F.col("o_orderdate").alias("create_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("amount"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("sent"),
    )


def sent_log(target: DataFrame) -> DataFrame:
    """Keys already sent, as the retired design logged them: distinct target keys."""
    return target.select(F.col("cms_no").alias("row_id")).distinct()
