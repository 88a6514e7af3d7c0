"""Substring dedup by hashing lines and the sentences in them.

A text's units are its lines, cut after sentence marks, so that a passage is found at the
start, the end or the middle of a line.  A unit that stays long is a unit as a whole, and is
also cut finely at places that its words decide: each run of ``RUN`` neighbouring pieces is a
unit of its own, so that a passage without marks is found between other words but for the few
words before its first and after its last cut.  A unit is normalised (lower case, words only) and
digested to 96 bits (a number of 64 and one of 32, which no shuffle pads; among 10 thousand million
units two different ones share a digest with a chance of 1 in a thousand million); digests are grouped over the whole corpus.  Of each repeated unit the
earliest occurrence stays (by id, then row, then place; null ids last), the others go, with
their offsets in the original text.  Units of a long one overlap; what any of them covers goes.  Units of fewer than ``LEAST_WORDS`` words are too common
to mean anything by themselves and always stay.

Grouping is a plain aggregate with partial sums before the shuffle, so a line that a third
of all documents share costs each task one row.  Only digests that occur twice or more are
joined back.

Nulls and odd input: a null or empty text has no units; a null id takes part, last in rank;
of repeated rows the first keeps its units; an empty table gives no rows.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, staged, table
from tidemark.llm.decontam import match_words

LEAST_WORDS = 5
#: A unit of more words is cut further, after one word in so many; so many pieces make a run.
LONG_WORDS, CUT_ONE_IN, RUN = 20, 3, 4
TOKEN = re.compile(r"\S+")
#: A sentence ends after marks that white space follows; a line ends at its line feed.
#: The parts of a digest that are kept.
HALVES = "<qi"
CUT = re.compile(r"(?<=[.!?])[ \t\r\f\v]+|[ \t\r\f\v]*\n\s*")


def pieces(text: str, begin: int, end: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """A unit as it is, and the runs of pieces of a long one, cut after words whose hash, with
    that of the word before, marks them: the same words are cut alike wherever they stand."""
    words = match_words(text[begin:end])
    yield begin, end, words
    if len(words) <= LONG_WORDS:
        return
    cuts, before, start, held = [], b"", begin, []
    for m in TOKEN.finditer(text, begin, end):
        found = match_words(m[0])
        if found:
            held += found
            if xxhash.xxh3_64_intdigest((found[-2] if len(found) > 1 else before) + b" " + found[-1]) % CUT_ONE_IN == 0:
                cuts.append((start, m.end(), held))
                start, held = m.end(), []
            before = found[-1]
    if held:
        cuts.append((start, end, held))
    # Each piece begins a run, which goes on until it counts; all pieces are the unit itself.
    for i in range(len(cuts)):
        j, words = i, []
        while j < len(cuts) and (j < i + RUN or len(words) < LEAST_WORDS):
            words += cuts[j][2]
            j += 1
        if j >= i + RUN and (i, j) != (0, len(cuts)):
            yield cuts[i][0], cuts[j - 1][1], words


def units(text: str | None) -> Iterator[tuple[int, int, bytes, int]]:
    """(start, length in code points, digest, words) of every unit that counts."""
    if not text:
        return
    begin = 0
    for end, after in [*((m.start(), m.end()) for m in CUT.finditer(text)), (len(text), len(text))]:
        for first, last, words in pieces(text, begin, end):
            if len(words) >= LEAST_WORDS:
                yield first, last - first, xxhash.xxh3_128_digest(b" ".join(words)), len(words)
        begin = after


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int64()), ("high", pa.int64()), ("low", pa.int32())]))
    for batch in batches:
        found = [[{"start": s, "size": n << 32 | w, **dict(zip(("high", "low"), struct.unpack_from(HALVES, d)))} for s, n, d, w in units(t.as_py())]
                 for t in batch["text"]]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["row"], pa.array(found, kind)], names=["doc_id", "row", "units"])


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """Every occurrence of every repeated unit: ``doc_id``, ``row``, ``start``, ``chars``,
    ``words``, ``copies`` (occurrences in all), ``first_doc_id``, ``first_start``, ``kept``.

    ``row_col`` names a unique number of each row; without it rows are numbered by place.
    """
    bounded_batches(docs.sparkSession)
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), row.alias("row"), F.col(text_col).alias("text"))
    found = staged(slim.mapInArrow(
        _units, "doc_id long, row long, units array<struct<start: int, size: bigint, high: bigint, low: int>>"), "repeats-units")
    unit = found.select("doc_id", "row", F.explode("units").alias("u")).select("doc_id", "row", "u.*")
    # Null ids rank last: the struct's first field says so.
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row").alias("row"), F.col("start").alias("start"))
    groups = unit.groupBy("high", "low").agg(F.count(F.lit(1)).alias("copies"), F.min(rank).alias("first")).where("copies > 1")
    groups = staged(groups, "repeats-groups")
    both = unit.join(groups, ["high", "low"])
    return both.select(
        "doc_id", "row", "start", F.shiftright("size", 32).cast("int").alias("chars"), F.col("size").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("words"), "copies", F.col("first.id").alias("first_doc_id"), F.col("first.start").alias("first_start"),
        ((F.col("row") == F.col("first.row")) & (F.col("start") == F.col("first.start"))).alias("kept"))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, gone in zip(batch["_text"].to_pylist(), batch["_gone"].to_pylist()):
            if gone:
                parts, begin = [], 0
                for g in sorted(gone, key=lambda g: g["start"]):
                    parts.append(text[begin:max(begin, g["start"])])
                    begin = max(begin, g["start"] + g["chars"])
                text = "".join([*parts, text[begin:]])
            texts.append(text)
        yield pa.RecordBatch.from_arrays([batch["_row"], pa.array(texts, pa.string())], names=["_row", "_clean"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the units to remove; ``removed`` has their offsets in the original
    text (null: nothing went)."""
    # The caller's columns travel in one: no name can clash.
    base = staged(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text"),
                              F.monotonically_increasing_id().alias("_row")), "repeats-docs")
    gone = repeated_units(base, "doc_id", "_text", "_row").where(~F.col("kept")).groupBy(F.col("row").alias("_row")).agg(
        F.sort_array(F.collect_list(F.struct("start", "chars"))).alias("_gone"))
    gone = staged(gone, "repeats-gone")
    hit = base.join(gone, "_row").select("_row", "_text", "_gone")
    clean = hit.mapInArrow(_without, "_row long, _clean string")
    kept = [c for c in docs.columns if c not in (text_col, "removed")]
    return base.join(clean, "_row", "left").join(gone, "_row", "left").select(
        *[F.col("_doc")[c].alias(c) for c in kept], F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.col("_clean")).alias(text_col),
        F.col("_gone").alias("removed"))


def op9_line_hash_dedup(spark, sf_dir: str) -> DataFrame:
    """Every occurrence of every repeated line or sentence; all but the kept ones go."""
    return repeated_units(table(spark, sf_dir, "documents")).drop("row")


QUERIES = {"op9_line_hash_dedup": op9_line_hash_dedup}
ORACLE: dict[str, str] = {}
