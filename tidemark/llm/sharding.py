"""Sharding by histogram sort.

Rows are ordered by a 63-bit key (hash of the text, hash of the id, salt of the row), so
copies of a text lie side by side and yet a text that holds a third of all rows spans many
keys.  The splitters between shards come from exact counts: a histogram over key prefixes,
refined again and again only where a wanted splitter falls inside a bin that is heavier
than the tolerance, or where a bin has too many rows for one task.  Then every row is
exchanged once, to the task of its final bin, where it gets its slot.

Nulls and odd input: a null text has no bytes (size 1) and a null checksum; a null id is an
id like any other; repeated rows are rows of their own (the salt lets a splitter fall
between them); an empty table gives no rows.  Equal texts stay in one shard unless their
group is heavier than the tolerance and a splitter falls inside it.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import hash_bits, staged, table

#: Bits of the key below each histogram's prefixes, coarsest first.  Down to 25 bits a bin
#: never cuts a text's copies; below that it divides them by id (13 bits) and salt (12).
SHIFTS = (51, 45, 38, 31, 25, 19, 12, 6, 0)
#: A splitter may miss its wanted weight by this part of a shard.
TOLERANCE = 0.01
#: A bin is divided while it has more rows than this and than 1/2048 of all, or than the most
#: that one task is to sort whole (with their texts, in the pipeline) at any size of the input.
LEAF_ROWS, MOST_LEAF_ROWS = 1000, 500_000


def sort_key(text: Column, doc_id: Column) -> Column:
    salt = hash_bits(12, F.monotonically_increasing_id())
    return (F.shiftleft(hash_bits(38, text), 25).bitwiseOR(F.shiftleft(hash_bits(13, doc_id), 12)).bitwiseOR(salt))


def prefix(shift: int) -> Column:
    return F.shiftright(F.col("_key"), shift)


def refined_histogram(keyed: DataFrame, n_shards: int, tolerance: float) -> tuple[list[int], list[tuple[int, list[int]]]]:
    """Splitters (the first key of shard 1, 2, ...) and, for each shift, the prefixes that
    were divided further.

    The driver receives one count per non-empty bin: at most 4096 first, then at most 128
    for each divided bin, whose number is bounded by the shards, by 2048 and, for more than a
    billion rows, by one bin in ``MOST_LEAF_ROWS`` of them.
    """
    rows, weight = keyed.agg(F.count(F.lit(1)), F.coalesce(F.sum("_size"), F.lit(0))).first()
    wanted = [weight * i / n_shards for i in range(1, n_shards)]
    slack, most_rows = tolerance * weight / n_shards, min(max(LEAF_ROWS, rows // 2048), MOST_LEAF_ROWS)
    bins: dict[int, tuple[int, int]] = {}
    divided: list[tuple[int, list[int]]] = []
    part = keyed
    for i, shift in enumerate(SHIFTS):
        for p, w, n in part.groupBy(prefix(shift).alias("p")).agg(F.sum("_size"), F.count(F.lit(1))).collect():
            bins[p << shift] = (w, n)
        starts, below = sorted(bins), [0]
        for s in starts:
            below.append(below[-1] + bins[s][0])
        coarse = {s >> shift for s in starts if bins[s][1] > most_rows}
        for w in wanted:
            at = bisect_right(below, w) - 1
            if at < len(starts) and min(w - below[at], below[at + 1] - w) > slack:
                coarse.add(starts[at] >> shift)
        # Bins of earlier rounds that were left whole stay whole.
        coarse = {p for p in coarse if i == 0 or (p << shift) >> SHIFTS[i - 1] in divided[-1][1]}
        if not coarse or shift == 0:
            break
        divided.append((shift, sorted(coarse)))
        for p in coarse:
            del bins[p << shift]
        part = part.where(prefix(shift).isin(sorted(coarse)))
    splitters = []
    for w in wanted:
        at = min(range(len(below)), key=lambda j: abs(below[j] - w))
        splitters.append(starts[at] if at < len(starts) else 1 << 63)
    return splitters, divided


def bin_start(divided: list[tuple[int, list[int]]]) -> Column:
    """The first key of the final bin that holds a row."""
    last = SHIFTS[len(divided)]
    out = F.shiftleft(prefix(last), last)
    for shift, coarse in reversed(divided):
        out = F.when(prefix(shift).isin(coarse), out).otherwise(F.shiftleft(prefix(shift), shift))
    return out


def shard_documents(docs: DataFrame, n_shards: int = 8, id_col: str = "doc_id", text_col: str = "text",
                    carry: list[str] | None = None, tolerance: float = TOLERANCE) -> DataFrame:
    """Every row with ``size``, ``text_crc32``, ``shard`` and ``slot``; ``carry`` names the
    columns that come along (default: the id only).

    A carried column whose name clashes with a result's is replaced by the result.
    """
    made = {"size", "text_crc32", "shard", "slot"}
    keep = [c for c in (carry if carry is not None else [id_col]) if c not in made]
    text = F.col(text_col)
    keyed = staged(docs.select(
        *keep, F.col(id_col).alias("_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("_size"),
        F.crc32(text.cast("binary")).alias("_crc"), sort_key(text, F.col(id_col)).alias("_key")), "shard")
    splitters, divided = refined_histogram(keyed.select("_key", "_size"), n_shards, tolerance)
    shard = reduce(lambda a, b: a + b, [(F.col("_key") >= s).cast("int") for s in splitters if s < 1 << 63], F.lit(0))
    placed = keyed.withColumn("shard", shard.cast("int")).withColumn("_bin", bin_start(divided))
    below = Window.partitionBy("shard").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = placed.groupBy("shard", "_bin").agg(F.count(F.lit(1)).alias("_n")).select(
        "shard", "_bin", F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_below"))
    within = Window.partitionBy("shard", "_bin").orderBy("_key", "_id", "_crc", "_size")
    return (placed.join(bins, ["shard", "_bin"])
            .withColumn("slot", (F.col("_below") + F.row_number().over(within) - 1).cast("long"))
            .select(*keep, F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"), "shard", "slot"))


def op1_histogram_sort_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 of near equal bytes."""
    out = shard_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op1_histogram_sort_shards": op1_histogram_sort_shards}
ORACLE: dict[str, str] = {}
