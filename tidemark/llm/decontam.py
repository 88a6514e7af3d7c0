"""Benchmark decontamination by greedy string tiling.

Words are runs of letters, digits and non-ASCII characters in lower case; in scripts written
without blanks every character is a word.  Every run of ``LEAST_MATCH`` words of a benchmark item
is a seed.  A document and an item that share seeds are a pair, and each pair is tiled: the longest
common run of words that overlaps no earlier tile is marked, again and again, until no run of
``LEAST_MATCH`` words is left.  The longest run is found by Karp-Rabin hashes of runs of one
length, the length by halving.  An item is leaked if its tiles cover ``LEAST_COVERAGE`` of its
words, in whatever order they stand in the document.  An item of fewer words has no seed; it is
leaked if it is a whole line of the document.

Seeds are joined in Spark.  One pass over the documents finds the places of seeds: a bit filter of
fixed size (``FILTER_BITS``) goes to every task and lets few other runs pass.  The places are then
joined to the items' by seed; equal texts, told by their MD5, count once.  A leak needs a seed at
one in eight of an item's words at least, so as long as fewer places than that are left out, an
item's most common seeds (those of over ``COMMON_ITEMS`` items) need not be looked up: they join
only pairs that share another one.  A pair carries places, never products of places, and pairs
whose shared seeds cannot cover enough are dropped before they are tiled.  Texts are not moved.

Nulls and odd input: null and empty texts match nothing; null ids are reported as null; repeated
rows and items are reported each; empty tables give no rows; columns of any name come back.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, small_batches, staged, table, temporary
from tidemark.llm.words import MIX, WordHashes, grams
from tidemark.session import stage

LEAST_MATCH = 4
LEAST_COVERAGE = 0.5
#: Seeds with up to so many places go to every task as a block; more are joined by a shuffle.
BLOCK_SEEDS = 250_000
#: Seeds of more items are left out of the look-up where the others suffice.
COMMON_ITEMS = 16
#: 8 MB.
FILTER_BITS = 26

#: ASCII characters that are no letter or digit become a space.
_SPACED = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256))
#: Thai, Lao, Burmese, Khmer, kana and Han characters.
_UNSPACED = re.compile("[฀-໿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U0003ffff]")
_ODD = int(MIX[0])
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)


def match_words(text: str | None) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").translate(_SPACED).split() if text else []


def seed_words(text: str | None) -> list[bytes]:
    """The words of a text, one for every character of a script without blanks."""
    return match_words(text if not text or text.isascii() else _UNSPACED.sub(r" \g<0> ", text))


def line_seed(words: np.ndarray) -> np.ndarray:
    """The seed of a whole line of fewer than ``LEAST_MATCH`` words."""
    return grams(words, len(words)) ^ MIX[len(words)]


def text_seeds(texts: list[str | None], hashes: WordHashes, lines: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, place and seed of every run of ``LEAST_MATCH`` words, and of the shorter lines if asked."""
    words, short = [], []
    for k, text in enumerate(texts):
        if lines:
            parts = [hashes.of(seed_words(part)) for part in (text or "").split("\n")]
            at = 0
            for part in parts:
                if 0 < len(part) < LEAST_MATCH:
                    short.append((k, at, line_seed(part)[0]))
                at += len(part)
            words.append(np.concatenate(parts))
        else:
            words.append(hashes.of(seed_words(text)))
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    row = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    whole = np.concatenate([*words, np.empty(0, np.uint64)])
    seed = grams(whole, LEAST_MATCH) if len(whole) >= LEAST_MATCH else np.empty(0, np.uint64)
    inside = np.flatnonzero(place[:len(seed)] + LEAST_MATCH <= sizes[row[:len(seed)]])
    row, place, seed = row[inside], place[inside], seed[inside]
    if short:
        k, at, s = zip(*short)
        row, place, seed = np.r_[row, k], np.r_[place, at], np.r_[seed, np.array(s, dtype=np.uint64)]
    return row, place, seed


def by_seed(row: np.ndarray, place: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """One entry per text and seed: the text, the seed, its places in order."""
    order = np.lexsort((place, seed, row))
    row, place, seed = row[order], place[order], seed[order]
    starts = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (seed[1:] != seed[:-1])]) if len(row) else np.empty(0, np.int64)
    places = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(row)], pa.int32()), pa.array(place, pa.int32()))
    return row[starts], pa.array(seed[starts].view(np.int64)), places


class Runs:
    """The seeds of one side of a pair that are not marked, in order of place."""

    def __init__(self, place: np.ndarray, seed: np.ndarray):
        order = np.argsort(place, kind="stable")
        self.place, self.seed = place[order], seed[order]
        self.alive = np.ones(len(order), dtype=bool)
        self.summed()

    def summed(self) -> None:
        """Sums from which the hash of any run follows."""
        odd, inverse = (np.full(len(self.seed), x, dtype=np.uint64) for x in (_ODD, _ODD_INVERSE))
        self.back = np.multiply.accumulate(inverse)
        self.sums = np.zeros(len(self.seed) + 1, dtype=np.uint64)
        np.cumsum(self.seed * np.multiply.accumulate(odd), out=self.sums[1:])

    def longest(self) -> int:
        ends = np.flatnonzero(np.r_[np.diff(self.place) != 1, True])
        return int(np.diff(np.r_[-1, ends]).max())

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First index and hash of every run of ``n`` seeds."""
        at = np.arange(max(0, len(self.place) - n + 1))
        at = at[self.place[at + n - 1] - self.place[at] == n - 1]
        return at, (self.sums[at + n] - self.sums[at]) * self.back[at]

    def free(self, at: int, n: int) -> bool:
        # Marked stretches are longer than n seeds, so one that meets the run holds an end of it.
        return bool(self.alive[at] and self.alive[at + n - 1])

    def mark(self, at: int, n: int) -> None:
        """Take out every seed that meets the words of a run."""
        first = int(self.place[at])
        lo, hi = np.searchsorted(self.place, (first - LEAST_MATCH + 1, first + n + LEAST_MATCH - 1))
        self.alive[lo:hi] = False

    def drop(self, seeds: np.ndarray | None = None) -> None:
        keep = self.alive if seeds is None else np.isin(self.seed, seeds)
        self.place, self.seed = self.place[keep], self.seed[keep]
        self.alive = np.ones(len(self.place), dtype=bool)
        self.summed()


def tiled(doc: Runs, item: Runs) -> list[tuple[int, int, int]]:
    """Greedy tiling of one pair: (length, place in document, place in item).

    Longest first; of equally long ones the first in the item, then in the document.
    """
    out = []
    while True:
        doc.drop(item.seed)
        item.drop(doc.seed)
        if not len(doc.seed) or not len(item.seed):
            return out

        def common(n: int) -> bool:
            return bool(np.isin(item.of(n)[1], doc.of(n)[1]).any())
        # A common run of n seeds holds one of n - 1.
        least, most = 1, min(doc.longest(), item.longest())
        if common(most):
            least = most
        while most - least > 1:
            middle = (least + most) // 2
            least, most = (middle, most) if common(middle) else (least, middle)
        n = least
        places = defaultdict(list)
        at, hashed = doc.of(n)
        for p, h in zip(at.tolist(), hashed.tolist()):
            places[h].append(p)
        for held in places.values():
            held.reverse()
        any_equal = False
        for q, h in zip(*(x.tolist() for x in item.of(n))):
            held = places.get(h)
            while held and item.free(q, n):
                p = held[-1]
                if not doc.free(p, n):
                    held.pop()                                 # what is marked stays marked
                    continue
                if not np.array_equal(doc.seed[p:p + n], item.seed[q:q + n]):
                    raise ArithmeticError("two runs of one 64-bit hash")
                any_equal = True
                out.append((n + LEAST_MATCH - 1, int(doc.place[p]), int(item.place[q])))
                doc.mark(p, n)
                item.mark(q, n)
        assert any_equal
        doc.drop()
        item.drop()


def tiles(doc_at: np.ndarray, item_at: np.ndarray) -> list[tuple[int, int, int]]:
    """The same from the places of all equal seeds of a pair."""
    doc_place, doc_of = np.unique(doc_at, return_inverse=True)
    item_place, first = np.unique(item_at, return_index=True)
    name = np.full(len(doc_place), np.iinfo(np.int64).max)
    np.minimum.at(name, doc_of, item_at)
    item_name = name[doc_of[first]]
    return tiled(Runs(doc_place, (name + 1).astype(np.uint64) * MIX[1]), Runs(item_place, (item_name + 1).astype(np.uint64) * MIX[1]))


def item_seeds(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per item and seed: ``item`` (a number of the row), ``item_id``, ``size`` in words,
    ``seed``, its ``item_places``, and whether it is ``sought`` in documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts = batch["text"].to_pylist()
            size = np.array([len(seed_words(t)) for t in texts], dtype=np.int32)
            row, place, seed = text_seeds(texts, hashes, False)
            for k in np.flatnonzero((size > 0) & (size < LEAST_MATCH)):
                row, place, seed = np.r_[row, k], np.r_[place, 0], np.r_[seed, line_seed(hashes.of(seed_words(texts[k])))]
            row, seed, places = by_seed(row.astype(np.int64), place, seed)
            yield pa.RecordBatch.from_arrays([batch["item"].take(pa.array(row)), batch["item_id"].take(pa.array(row)), pa.array(size[row]), seed, places],
                                             names=["item", "item_id", "size", "seed", "item_places"])

    items = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text"))
    seeds = staged(items.mapInArrow(run, "item long, item_id long, size int, seed long, item_places array<int>"), "benchmark-seeds")
    common = seeds.groupBy("seed").agg(F.count(F.lit(1)).alias("items")).where(F.col("items") > COMMON_ITEMS)
    # Tiles of at least so many seeds' places cover enough; one less may be left out.
    need = F.ceil(F.col("size") * LEAST_COVERAGE / LEAST_MATCH)
    most_common = Window.partitionBy("item").orderBy(F.desc_nulls_last("items"), "seed")
    out = seeds.join(common, "seed", "left").withColumn("left_out", F.sum(F.size("item_places")).over(most_common))
    return staged(out.select("item", "item_id", "size", "seed", "item_places",
                             (F.col("items").isNull() | (F.col("left_out") >= need)).alias("sought")), "benchmark-sought")


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """A bit for the low bits of every seed; at most 2^20 rows reach the driver."""
    bit = F.col("seed").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    rows = seeds.select(F.shiftright(bit, 6).alias("at"), F.expr("shiftleft(1L, cast(seed & 63 AS int))").alias("bit")).groupBy("at").agg(
        F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    bits[rows["at"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return bits


def text_digest(text: str) -> Column:
    return F.unhex(F.md5(F.col(text)))


LEAKS = ("digest binary, item_id long, item_words int, tiled_words int, coverage double, longest_tile int, "
         "tiles array<struct<doc_word: int, item_word: int, words: int>>")


def _pairs_tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("digest", pa.binary()), ("item_id", pa.int64()), ("item_words", pa.int32()), ("tiled_words", pa.int32()),
                        ("coverage", pa.float64()), ("longest_tile", pa.int32()),
                        ("tiles", pa.list_(pa.struct([("doc_word", pa.int32()), ("item_word", pa.int32()), ("words", pa.int32())])))])
    for batch in batches:
        rows = []
        for k in range(len(batch)):
            size, shared = batch["size"][k].as_py(), batch["shared"][k].as_py()
            if size < LEAST_MATCH:
                found = [(size, shared[0]["doc_places"][0], 0)]
            else:
                doc, item = (Runs(np.array([p for s in shared for p in s[side]], dtype=np.int64),
                                  np.repeat(np.array([s["seed"] for s in shared], dtype=np.int64).view(np.uint64), [len(s[side]) for s in shared]))
                             for side in ("doc_places", "item_places"))
                found = tiled(doc, item)
            covered = sum(n for n, _, _ in found)
            if covered >= LEAST_COVERAGE * size:
                rows.append({"digest": batch["digest"][k].as_py(), "item_id": batch["item_id"][k].as_py(), "item_words": size, "tiled_words": covered,
                             "coverage": covered / size, "longest_tile": max(n for n, _, _ in found),
                             "tiles": [{"doc_word": p, "item_word": q, "words": n} for n, p, q in found]})
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """One row per distinct text (its MD5 as ``digest``) and item that it leaks."""
    spark = docs.sparkSession
    with temporary(spark), small_batches(spark):
        seeds = item_seeds(benchmark)
        lines = bool(seeds.where(F.col("size") < LEAST_MATCH).limit(1).count())
        sent = spark.sparkContext.broadcast(seed_filter(seeds))

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes, bits = WordHashes(), sent.value
            for batch in batches:
                row, place, seed = text_seeds(batch["text"].to_pylist(), hashes, lines)
                low = seed & np.uint64((1 << FILTER_BITS) - 1)
                maybe = np.flatnonzero((bits[low >> np.uint64(6)] >> (low & np.uint64(63))) & np.uint64(1))
                row, seed, places = by_seed(row[maybe], place[maybe], seed[maybe])
                yield pa.RecordBatch.from_arrays([batch["digest"].take(pa.array(row)), seed, places], names=["digest", "seed", "doc_places"])

        texts = docs.select(text_digest(text_col).alias("digest"), F.col(text_col).alias("text")).where(F.col("text") != "")
        found = texts.mapInArrow(find, "digest binary, seed long, doc_places array<int>")
        found = staged(found.groupBy("digest", "seed").agg(F.first("doc_places").alias("doc_places")), "document-seeds")
        sought, others = seeds.where("sought").drop("sought"), seeds.where("NOT sought").drop("sought")
        n_places = sought.agg(F.coalesce(F.sum(F.size("item_places")), F.lit(0))).first()[0]
        hits = staged(found.join(F.broadcast(sought) if n_places <= block_seeds else sought, "seed"), "shared-seeds")
        # Seeds that were left out, of pairs that share another one.
        more = others.join(hits.select("digest", "item").distinct(), "item").join(found, ["digest", "seed"])
        pairs = hits.unionByName(more).groupBy("digest", "item", "item_id", "size").agg(
            F.collect_list(F.struct("seed", "doc_places", "item_places")).alias("shared"), F.sum(F.size("item_places")).alias("places"))
        pairs = pairs.where(F.col("places") * LEAST_MATCH >= F.col("size") * LEAST_COVERAGE).drop("item", "places")
        return stage(pairs.mapInArrow(_pairs_tiled, LEAKS), spark, "leaks")[0]


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """One row per document and leaked item, with the tiles (word places in the document)."""
    found = leaks(docs, benchmark, text_col, block_seeds)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(text_col).alias("digest"))
    return slim.join(found, "digest").drop("digest")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", block_seeds: int = BLOCK_SEEDS) -> DataFrame:
    """The documents, all columns, without those that leak a benchmark item."""
    gone = broadcast_if_small(leaks(docs, benchmark, text_col, block_seeds).select(F.col("digest").alias("_digest")).distinct())
    packed = docs.select(F.struct("*").alias("_doc"), text_digest(text_col).alias("_digest"))
    return packed.join(gone, "_digest", "left_anti").select("_doc.*")


def op10_greedy_string_tiling(spark, sf_dir: str) -> DataFrame:
    """Every leak of a benchmark item in a document."""
    out = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "item_id", "item_words", "tiled_words", "coverage", "longest_tile")


QUERIES = {"op10_greedy_string_tiling": op10_greedy_string_tiling}
ORACLE: dict[str, str] = {}
