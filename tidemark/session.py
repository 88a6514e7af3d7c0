"""Spark session helpers and the shared scratch location.

Everything that must survive an executor (or driver) loss is written below the
folder named by ``spark.checkpoint.dir``.  On a cluster that setting points at
shared storage; this module only fills it in when it is unset (local tests).
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of the library relies on.  AQE re-plans joins and
# coalesces shuffle partitions at run time; skew-join splitting handles a hot key.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def spark_session(master: str | None = None, app: str = "tidemark",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            # A machine-local folder would vanish with its executor (or never be seen
            # by the others): a cluster must name a shared one.
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        # Only reached in local runs and tests: nothing configured a shared folder.
        path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    name = "-".join(p for p in parts if p) or "scratch"
    return f"{root}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem, so it works on any store."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def make_dirs(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hpath)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this library created itself (a run's staging table)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


def clear_stale(spark: SparkSession, *parts: str) -> int:
    """Delete the scratch folders named ``parts`` (any suffix id) that an earlier run
    left behind when its driver died before cleaning up.  Only safe with one writer
    per name, which the job runner requires anyway.  Returns how many were removed."""
    name = "-".join(p for p in parts if p)
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/tidemark")
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(base):
        return 0
    pattern = re.compile(re.escape(name) + r"-[0-9a-f]{12}")
    removed = 0
    for st in fs.listStatus(base):
        if st.isDirectory() and pattern.fullmatch(st.getPath().getName()):
            fs.delete(st.getPath(), True)
            removed += 1
    return removed


def stage(df, spark: SparkSession, *name: str):
    """Materialise ``df`` once as a Parquet table under the shared checkpoint folder and
    return (frame reading it, its path).  Cuts the lineage like ``checkpoint()`` but
    computes the input only once and gives the read-back real file splits."""
    path = scratch_path(spark, "stage", *name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


__all__ = ["spark_session", "checkpoint_root", "scratch_path", "path_exists", "make_dirs", "remove_path", "clear_stale",
           "stage", "DEFAULT_CONF"]
