"""Reconciliation and data-quality checks: duplicates, gaps, late rows, linkage,
extract contract, column widths, cursor drift.  Each is one or two distributed
aggregates or anti joins; results are small report frames."""

from __future__ import annotations

import re

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import col_or_lit
from .history import live


def _scalars(spark: SparkSession, **named) -> DataFrame:
    """One row of named scalar subqueries (no cross join)."""
    return spark.range(1).select(*[c.alias(n) for n, c in named.items()])


def count_of(df: DataFrame):
    return df.select(F.count(F.lit(1))).scalar()


def link_counts(report: DataFrame, raw_report: DataFrame, detail_header: DataFrame) -> DataFrame:
    """Table sizes and fully linked children in one row."""
    spark = report.sparkSession
    return _scalars(spark,
                    report_rows=count_of(report),
                    raw_report_rows=count_of(raw_report),
                    detail_header_rows=count_of(detail_header),
                    fully_linked=count_of(fully_linked(report, raw_report, detail_header)))


def fully_linked(report: DataFrame, raw_report: DataFrame, detail_header: DataFrame) -> DataFrame:
    """Children whose both parents exist (three-way inner join)."""
    r = report.select("row_id", "raw_report_id", "dtl_row_id")
    p = raw_report.select(F.col("row_id").alias("_p"))
    h = detail_header.select(F.col("row_id").alias("_h"))
    return (r.join(p, r.raw_report_id == p._p).join(h, r.dtl_row_id == h._h)
            .select("row_id", "raw_report_id", "dtl_row_id"))


def fk_orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str = "row_id") -> DataFrame:
    """Children whose (non-NULL) FK names no parent."""
    keys = parent.select(F.col(pk).alias(fk))
    return child.filter(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def fk_set_null(child: DataFrame, parent: DataFrame, fk: str, pk: str = "row_id") -> DataFrame:
    """``ON DELETE SET NULL`` as a table job: FKs naming no parent become NULL."""
    keys = parent.select(F.col(pk).alias("_pk")).withColumn("_hit", F.lit(True))
    out = child.join(keys, child[fk] == keys["_pk"], "left")
    return out.withColumn(fk, F.when(F.col("_hit"), F.col(fk))).drop("_pk", "_hit")


def fk_cascade(child: DataFrame, key_map: DataFrame, fk: str, old: str = "old_id", new: str = "new_id") -> DataFrame:
    """``ON UPDATE CASCADE`` as a table job: FKs follow the parent key map."""
    m = key_map.select(F.col(old).alias("_old"), F.col(new).alias("_new"))
    out = child.join(m, child[fk] == m["_old"], "left")
    return out.withColumn(fk, F.coalesce(F.col("_new"), F.col(fk))).drop("_old", "_new")


def duplicate_keys(target: DataFrame, key: str) -> DataFrame:
    """Keys present more than once in the target, with their copy count."""
    return (target.groupBy(key).agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))


def key_gaps(source_keys: DataFrame, target: DataFrame, cursor, key: str = "row_id",
             target_key: str = "cms_no") -> DataFrame:
    """Keys at or below the cursor that should be in the target and are not."""
    below = source_keys.filter((F.col(key) > 0) & (F.col(key) <= col_or_lit(cursor)))
    have = target.select(F.col(target_key).alias(key))
    return below.join(have, key, "left_anti")


def late_eligible(extract: DataFrame, target: DataFrame, cursor, key: str = "cms_no",
                  target_key: str = "cms_no") -> DataFrame:
    """Rows eligible today whose key is already at or below the cursor but was never copied."""
    below = extract.filter(F.col(key) <= col_or_lit(cursor))
    have = target.select(F.col(target_key).alias(key))
    return below.join(have, key, "left_anti")


def reconcile_counts(target: DataFrame, history: DataFrame, key: str,
                     sync_key: str | None = None) -> DataFrame:
    """Target rows, distinct target keys and rows the history says were inserted."""
    spark = target.sparkSession
    h = live(history if sync_key is None else history.filter(F.col("sync_key") == sync_key))
    # One pass over the target for both counts.
    both = target.select(F.struct(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("keys"))).scalar()
    logged = h.filter(F.col("status") == "Success").select(
        F.coalesce(F.sum("records_inserted"), F.lit(0)).cast("long")).scalar()
    out = _scalars(spark, target_rows=both.getField("rows"), distinct_keys=both.getField("keys"), logged_inserted=logged)
    return out.withColumn("agree", (F.col("target_rows") == F.col("distinct_keys"))
                          & (F.col("target_rows") == F.col("logged_inserted")))


def key_order(df: DataFrame, key: str) -> DataFrame:
    """One row, ``ordered``: the rows come in ascending key order (NULL first, equal keys
    allowed).  Each partition is checked in place, row against row before; its first and last
    key then meet those of its neighbours, so one row per partition is all that one task sees."""
    placed = df.select(F.col(key).cast("long").alias("_key"), F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_at"))
    inside = Window.partitionBy("_part").orderBy("_at")
    steps = placed.withColumn("_before", F.lag("_key").over(inside)).withColumn("_first", F.row_number().over(inside) == 1)
    # A NULL after a key is out of order; a key after a NULL is not.
    back = ~F.col("_first") & F.coalesce(F.col("_key") < F.col("_before"), F.col("_key").isNull() & F.col("_before").isNotNull())
    parts = steps.groupBy("_part").agg(F.count_if(back).alias("_back"), F.min_by("_key", "_at").alias("_low"), F.max_by("_key", "_at").alias("_high"))
    seam = Window.orderBy("_part")
    parts = parts.withColumn("_seam", F.lag("_high").over(seam)).withColumn("_n", F.row_number().over(seam))
    torn = (F.col("_n") > 1) & F.coalesce(F.col("_low") < F.col("_seam"), F.col("_low").isNull() & F.col("_seam").isNotNull())
    return parts.agg((F.count_if(torn | (F.col("_back") > 0)) == 0).alias("ordered"))


def extract_contract(extract: DataFrame, key: str, cursor, batch: int,
                     expected_columns: int) -> DataFrame:
    """The extract's promises, checked in one aggregate: keys unique and above the
    cursor, at most ``batch`` rows, in key order, right width, numeric key."""
    numeric = dict(extract.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    agg = extract.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("distinct_keys"),
                      F.min(key).alias("min_key"), F.max(key).alias("max_key"))
    return agg.select(
        "rows", "distinct_keys", "min_key", "max_key",
        (F.col("rows") == F.col("distinct_keys")).alias("keys_unique"),
        F.coalesce(F.col("min_key") > col_or_lit(cursor), F.lit(True)).alias("above_cursor"),
        (F.col("rows") <= F.lit(batch)).alias("within_batch"),
        F.lit(len(extract.columns) == expected_columns).alias("arity_ok"),
        F.lit(numeric).alias("key_numeric"),
        key_order(extract, key).scalar().alias("ordered"))


def width_fit(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """Per string column: longest value against the declared width, before any write."""
    cols = [c for c in widths if c in df.columns]
    agg = df.agg(*[F.max(F.length(c)).cast("long").alias(c) for c in cols])
    long = agg.unpivot([], cols, "column_name", "max_len")
    wmap = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(int(widths[c])).cast("long"))])
    return long.select("column_name", "max_len", wmap[F.col("column_name")].alias("width")).withColumn(
        "fits", F.coalesce(F.col("max_len") <= F.col("width"), F.lit(True)))


def cursor_drift(cursors: DataFrame, targets: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """History cursor against the highest key actually in each job's target."""
    spark = cursors.sparkSession
    parts = [df.agg(F.max(k).alias("target_max_key")).select(F.lit(job).alias("sync_key"), "target_max_key")
             for job, (df, k) in targets.items()]
    if parts:
        tmax = parts[0]
        for p in parts[1:]:
            tmax = tmax.unionByName(p)
    else:
        tmax = spark.createDataFrame([], "sync_key string, target_max_key long")
    out = cursors.select("sync_key", F.col("cursor").alias("history_cursor")).join(tmax, "sync_key", "left")
    return out.withColumn("drift", F.col("target_max_key") - F.col("history_cursor")).withColumn(
        "in_sync", F.coalesce(F.col("drift") == 0, F.lit(False)))


def date_profile(df: DataFrame, ts: str) -> DataFrame:
    """Rows, distinct days, first and last instant of a timestamp column."""
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_distinct(F.to_date(ts)).alias("distinct_dates"),
                  F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def day_counts(df: DataFrame, ts: str, days: Sequence) -> DataFrame:
    """Rows on each given day, as conditional sums in one pass."""
    return df.agg(*[F.sum(F.when(F.to_date(ts) == F.lit(d), 1).otherwise(0)).cast("long").alias(f"day{i + 1}_rows")
                    for i, d in enumerate(days)])


def next_base_id(df: DataFrame, key: str = "row_id") -> DataFrame:
    """``ISNULL(MAX(key), 0)``: ids of new rows start after it."""
    return df.agg(F.coalesce(F.max(key), F.lit(0).cast("long")).alias("base_id"))


def uncommitted_partitions(spark: SparkSession, target_location: str, history: DataFrame,
                           sync_key: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Target partitions no ``Success`` history row names: leftovers of runs that
    stopped between the data write and the commit (invisible to ``read_target``;
    the next run from the same cursor overwrites them)."""
    from .sink import COMMIT_COL, committed_ids
    parts = spark.read.format(fmt).load(target_location).groupBy(COMMIT_COL).agg(
        F.count(F.lit(1)).alias("rows"))
    if sync_key is not None:
        parts = parts.filter(F.col(COMMIT_COL).rlike(f"^{re.escape(sync_key)}-e[0-9]+-"))
    return parts.join(committed_ids(history, sync_key), COMMIT_COL, "left_anti")
