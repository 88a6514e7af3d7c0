"""A streaming source whose offsets are keys and whose batches are bounded by rows.

Parquet files (one or a growing folder) are read as a stream in key order.  The first column
of the schema is the integer key.  A batch covers the keys above the last offset, up to the
key that fills ``maxRowsPerBatch``; a key is never split, so a batch is larger only if one key
alone has more rows.  Rows with a null key have no place in the order and are not read.

Choosing an offset reads footers and the key column of those row groups whose statistics reach
below the key sought: with files written in key order that cost follows the batch, not the
table.  It holds ``maxRowsPerBatch`` keys plus those of one row group.  The rows themselves are
read by tasks, one per row group that the batch touches, each with the key range as a filter.

As with the batch job's cursor, a key that arrives below the last offset is not seen again.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegralType, StructType

from ..session import path_exists

# The reader runs in Python workers, which need no installed copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "key_range"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    url = urlparse(path)
    return (pafs.LocalFileSystem(), url.path) if url.scheme in ("", "file") else pafs.FileSystem.from_uri(path)


@dataclass
class RowGroup(InputPartition):
    """Row group ``group`` of a file, whose keys lie in ``low`` to ``high`` (None: unknown);
    as a partition, the rows with ``after`` < key <= ``upto``."""
    file: str
    group: int
    low: int | None
    high: int | None
    after: int = 0
    upto: int = 0


def row_groups(handle, file: str, key: str) -> list[RowGroup]:
    """The row groups of an open file with the key ranges that their statistics give."""
    meta, out = pq.ParquetFile(handle).metadata, []
    for g in range(meta.num_row_groups):
        group = meta.row_group(g)
        column = next(c for c in map(group.column, range(group.num_columns)) if c.path_in_schema == key)
        stats = column.statistics
        known = stats is not None and stats.has_min_max
        if known or stats is None or stats.null_count != group.num_rows:
            out.append(RowGroup(file, g, stats.min if known else None, stats.max if known else None))
    return out


def cut_key(lowest: np.ndarray, most: int) -> int:
    """The key that ends a batch, from the (at most ``most`` + 1) lowest waiting keys in order."""
    if len(lowest) <= most:
        return int(lowest[-1])
    below = lowest[lowest < lowest[most]]
    return int(below[-1]) if len(below) else int(lowest[most])


class KeyRangeReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.key = options["path"], schema[0].name
        self.most, self.first = int(options["maxRowsPerBatch"]), int(options["startingAfter"])
        self.at = max(self.first, int(options["plannedUpto"]))
        self.schema = to_arrow_schema(schema)
        if self.most < 1:
            raise ValueError("maxRowsPerBatch must be at least 1")
        self.known: dict[tuple, list[RowGroup]] = {}

    def groups(self) -> list[RowGroup]:
        """All row groups of the files that are there now; footers are read once per file."""
        fs, root = file_system(self.path)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.Directory:
            found = [f for f in fs.get_file_info(pafs.FileSelector(root, recursive=True))
                     if f.type == pafs.FileType.File and f.base_name.endswith(".parquet") and f.base_name[0] not in "._"]
        else:
            found = [info] if info.type == pafs.FileType.File else []
        now = {}
        for f in found:
            seen = (f.path, f.mtime_ns, f.size)
            if seen in self.known:
                now[seen] = self.known[seen]
            else:
                with fs.open_input_file(f.path) as handle:
                    now[seen] = row_groups(handle, f.path, self.key)
        self.known = now
        return [g for part in now.values() for g in part]

    def keys(self, group: RowGroup) -> np.ndarray:
        fs, _ = file_system(self.path)
        with fs.open_input_file(group.file) as handle:
            return pq.ParquetFile(handle).read_row_group(group.group, columns=[self.key]).column(0).drop_null().to_numpy()

    def next_key(self, after: int) -> int:
        """Where the batch that starts after a key ends; that key itself if nothing waits."""
        waiting = [g for g in self.groups() if g.high is None or g.high > after]
        lowest = np.empty(0, dtype=np.int64)
        for g in sorted(waiting, key=lambda g: (g.low is not None, g.low or 0)):
            if len(lowest) > self.most and g.low is not None and g.low > lowest[self.most]:
                break
            keys = self.keys(g).astype(np.int64)
            lowest = np.sort(np.concatenate([lowest, keys[keys > after]]))[:self.most + 1]
        return cut_key(lowest, self.most) if len(lowest) else after

    def initialOffset(self) -> dict:
        # Spark asks for it when it plans the first batch, after that batch's end is known.
        return {"key": self.first}

    def latestOffset(self) -> dict:
        self.at = self.next_key(self.at)
        return {"key": self.at}

    def partitions(self, start: dict, end: dict) -> list[RowGroup]:
        # A restarted query first repeats its last planned batch.
        after, upto = start["key"], end["key"]
        self.at = max(self.at, upto)
        out = [RowGroup(g.file, g.group, g.low, g.high, after, upto) for g in self.groups()
               if (g.high is None or g.high > after) and (g.low is None or g.low <= upto)] if upto > after else []
        return out or [RowGroup("", 0, None, None)]

    def read(self, partition: RowGroup) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fs, _ = file_system(self.path)
        with fs.open_input_file(partition.file) as handle:
            batches = pq.ParquetFile(handle).iter_batches(batch_size=8192, row_groups=[partition.group], columns=self.schema.names)
            for batch in batches:
                key = batch.column(self.key)
                inside = pc.and_(pc.greater(key, partition.after), pc.less_equal(key, partition.upto))
                rows = pa.Table.from_batches([batch.filter(inside)]).select(self.schema.names).cast(self.schema)
                yield from rows.to_batches()


class KeyRangeSource(DataSource):
    """Options: ``path``, ``maxRowsPerBatch``, ``startingAfter`` (the key before the first) and
    ``plannedUpto`` (for an old checkpoint, the last key that it has planned)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema: StructType) -> KeyRangeReader:
        after = self.options.get("startingAfter", "0")
        return KeyRangeReader(dict(path=self.options["path"], maxRowsPerBatch=self.options["maxRowsPerBatch"],
                                   startingAfter=after, plannedUpto=self.options.get("plannedUpto", after)), schema)


def key_source(spark: SparkSession, path: str, schema: StructType, max_rows: int, after: int = 0,
               planned: int | None = None) -> DataFrame:
    """The Parquet files of ``path`` as a stream by the first column's key.  With a new checkpoint
    it starts after ``after``, with an old one after ``planned``, the last key planned there."""
    if not isinstance(schema[0].dataType, IntegralType):
        raise ValueError(f"the key {schema[0].name!r} must be an integer")
    if max_rows < 1:
        raise ValueError("max_rows must be at least 1")
    spark.dataSource.register(KeyRangeSource)
    return (spark.readStream.format(NAME).schema(schema).option("maxRowsPerBatch", max_rows)
            .option("startingAfter", after).option("plannedUpto", after if planned is None else planned).load(path))


def planned_keys(spark: SparkSession, checkpoint_location: str) -> list[int]:
    """End keys of the last two batches that a stream's checkpoint has planned, the latest first."""
    if not path_exists(spark, f"{checkpoint_location}/offsets"):
        return []
    lines = spark.read.text(f"{checkpoint_location}/offsets").select(
        F.col("_metadata.file_name").try_cast("long").alias("batch"), F.get_json_object("value", "$.key").try_cast("long").alias("key"))
    return [r["key"] for r in lines.filter("batch IS NOT NULL AND key IS NOT NULL").orderBy(F.col("batch").desc()).limit(2).collect()]
