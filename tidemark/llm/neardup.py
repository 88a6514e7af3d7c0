"""Near-duplicate documents by an LSH forest over MinHash signatures.

A text's set holds its distinct 5-word shingles (64-bit hashes).  Equal texts form a class
and only classes are compared.  Each of ``TREES`` trees orders the classes by its own
signature of ``DEPTH`` MinHash values.  Candidates are

1. neighbours in a tree's order, whose signatures share at least ``LEAST_DEPTH`` values; of
   these each class tries the likeliest first, and then only those of other components, which
   joins up a dense region of any size by few tests;
2. within each region (a common prefix of ``LEAST_DEPTH`` values) that then still holds
   several components: pairs from different components, compared by blocks of members, so no
   task holds a region; the blocks of one component are never compared with each other.  In a
   crowded region the shingles that no other text there has bound a text's similarity to all
   others, which rules many strays out at once; the members' full sets go along, and only
   confirmed links leave a task, one for two components.

Candidates whose whole signatures agree too little (``LEAST_ESTIMATE``, over four standard
deviations below the threshold) are dropped; the rest are confirmed on the full shingle
sets.  Links within a component that is already joined up need no test.  A pair at the
threshold shares a region in some tree with probability 0.99998.

Nulls and odd input: a null, empty or blank text has an empty set and is linked with nothing
but stays a document of its own; a null id takes part, and a component of null ids alone has
a null id; repeated rows of an id get the same answer if their texts are equal; an empty
table gives no rows.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, broadcast_if_small, staged, table, temporary
from tidemark.llm.components import merged
from tidemark.llm.words import WordHashes, lower_words, mixed, shingles
from tidemark.session import stage

TREES, DEPTH, LEAST_DEPTH = 20, 7, 3
LEAST_ESTIMATE = 0.6
#: Members of a region that are paired at once; a region of more than CROWD gets bounds first.
BLOCK, CROWD = 32, 16
THRESHOLD = 75

_rng = np.random.default_rng(75)
_MULTIPLIERS = _rng.integers(0, 1 << 63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(found: np.ndarray) -> np.ndarray:
    """A 16-bit value of the least element under each of the permutations."""
    least = np.full(len(_MULTIPLIERS), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(found), 1024):
        np.minimum(least, np.multiply.outer(_MULTIPLIERS, found[i:i + 1024]).min(axis=1), out=least)
    return (mixed(least) >> np.uint64(48)).astype("<u2")


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        sizes, sigs = [], []
        for text in batch["text"]:
            found = shingles(hashes.of(lower_words(text.as_py())))
            sizes.append(len(found))
            sigs.append(signature(found).tobytes() if len(found) else None)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["digest"], pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())],
                                         names=["doc_id", "digest", "n", "sig"])


def _paths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each class and tree: the region (tree and first values) and the values below."""
    tree = np.arange(TREES, dtype=np.int64)
    for batch in batches:
        if len(batch):
            v = np.frombuffer(b"".join(batch["sig"]), dtype="<u2").reshape(len(batch), TREES, DEPTH).astype(np.int64)
            region = (tree << 48) | (v[..., 0] << 32) | (v[..., 1] << 16) | v[..., 2]
            deep = (v[..., 3] << 48) | (v[..., 4] << 32) | (v[..., 5] << 16) | v[..., 6]
            yield pd.DataFrame({"region": region.ravel(), "deep": deep.ravel(),
                                "cid": np.repeat(batch["cid"].to_numpy(), TREES)})


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pairs of consecutive rows of a region; also a partition's first and last row (b null)."""
    last = None
    for batch in batches:
        if not len(batch):
            continue
        if last is not None:
            batch = pd.concat([last, batch], ignore_index=True)
        region, cid = batch["region"].to_numpy(), batch["cid"].to_numpy()
        near = np.flatnonzero(region[1:] == region[:-1])
        yield pd.DataFrame({"region": region[near], "a": cid[near], "b": pd.array(cid[near + 1], dtype="Int64")})
        if last is None:
            yield pd.DataFrame({"region": region[:1], "a": cid[:1], "b": pd.array([None], dtype="Int64")})
        last = batch.iloc[-1:]
    if last is not None:
        yield pd.DataFrame({"region": last["region"].to_numpy(), "a": last["cid"].to_numpy(), "b": pd.array([None], dtype="Int64")})


def _estimate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            a = np.frombuffer(b"".join(batch["sig_a"]), dtype="<u2").reshape(len(batch), -1)
            b = np.frombuffer(b"".join(batch["sig_b"]), dtype="<u2").reshape(len(batch), -1)
            est = (a == b).mean(axis=1)
            keep = est >= LEAST_ESTIMATE
            yield pd.DataFrame({"a": batch["a"][keep], "b": batch["b"][keep], "est": est[keep]})


def _confirm(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hashes, lately = WordHashes(), OrderedDict()

    def found(cid: int, text: str) -> np.ndarray:
        if cid in lately:
            lately.move_to_end(cid)
        else:
            lately[cid] = shingles(hashes.of(lower_words(text)))
            if len(lately) > 200:
                lately.popitem(last=False)
        return lately[cid]

    for batch in batches:
        linked = []
        for a, b, x, y in zip(batch["a"], batch["b"], batch["text_a"], batch["text_b"]):
            p, q = found(a, x), found(b, y)
            common = len(np.intersect1d(p, q, assume_unique=True))
            linked.append(100 * common >= THRESHOLD * (len(p) + len(q) - common))
        yield batch.loc[np.array(linked, dtype=bool), ["a", "b"]]


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        found = [shingles(hashes.of(lower_words(t))).view(np.int64) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["cid"], pa.array(found, pa.list_(pa.int64()))], names=["cid", "shingles"])


def _columns(rows: pa.Array, *names: str) -> list[np.ndarray]:
    """A block's members as arrays, the signatures as windows of trees and depths."""
    sig = np.frombuffer(b"".join(rows.field("sig").to_pylist()), dtype="<u2").reshape(len(rows), TREES, DEPTH)
    return [*(rows.field(k).to_numpy(zero_copy_only=False) for k in names), sig]


def _linkable(common: np.ndarray, n: np.ndarray, n2: np.ndarray) -> np.ndarray:
    return 100 * common >= THRESHOLD * (n + n2 - common)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of two blocks from different components that are likely linked."""
    for batch in batches:
        found = [np.empty((2, 0), dtype=np.int64)]
        for left, right in zip(batch["left"], batch["right"]):
            cid, component, n, sig = _columns(left.values, "cid", "component", "n")
            cid2, component2, n2, sig2 = _columns(right.values, "cid", "component", "n")
            a, b = np.nonzero((component[:, None] != component2) & _linkable(np.minimum.outer(n, n2), n[:, None], n2))
            likely = (sig[a] == sig2[b]).mean(axis=(1, 2)) >= LEAST_ESTIMATE
            found.append(np.stack([np.minimum(cid[a[likely]], cid2[b[likely]]), np.maximum(cid[a[likely]], cid2[b[likely]])]))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links between the components of two blocks, confirmed on the full sets: one link for two
    components is enough.  A pair is tested in the first tree whose region it shares."""
    for batch in batches:
        links: list[tuple[int, int]] = []
        for region, left, right in zip(batch["region"].to_pylist(), batch["left"], batch["right"]):
            names = ("cid", "component", "n", "shared", "shingles")
            cid, component, n, shared, sets, sig = _columns(left.values, *names)
            cid2, component2, n2, shared2, sets2, sig2 = _columns(right.values, *names)
            a, b = np.nonzero((component[:, None] != component2) & _linkable(np.minimum.outer(shared, shared2), n[:, None], n2))
            tree, joined = region >> 48, set()
            for i in range(0, len(a), 8192):
                p, q = a[i:i + 8192], b[i:i + 8192]
                same = sig[p] == sig2[q]
                before = same[:, :tree, :LEAST_DEPTH].all(axis=2).any(axis=1)
                test = (same.mean(axis=(1, 2)) >= LEAST_ESTIMATE) & ~before
                for j, k in zip(p[test].tolist(), q[test].tolist()):
                    ends = (component[j], component2[k])
                    if ends not in joined:
                        common = len(np.intersect1d(sets[j], sets2[k], assume_unique=True))
                        if _linkable(common, n[j], n2[k]):
                            joined.add(ends)
                            links.append((int(cid[j]), int(cid2[k])))
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], names=["a", "b"])


class Forest:
    """The classes of one corpus with their signatures, and the searches over them."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"):
        bounded_batches(docs.sparkSession)
        self.docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                                F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))).alias("digest"))
        self.rows = staged(self.docs.select("doc_id", "digest", "text").mapInArrow(
            _sketch, "doc_id long, digest binary, n long, sig binary"), "neardup-rows")
        classes = self.rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n"), F.first("sig").alias("sig"))
        self.classes = staged(classes.withColumn("cid", F.monotonically_increasing_id()), "neardup-classes")
        self.paths = staged(self.classes.where("n > 0").select("cid", "sig").mapInPandas(
            _paths, "region long, deep long, cid long"), "neardup-paths")
        self.spark = docs.sparkSession

    def estimated(self, pairs: DataFrame) -> DataFrame:
        """The distinct pairs whose signatures agree enough to be tested."""
        sig = self.classes.select("cid", "sig", "n")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        pairs = pairs.join(sig.select(F.col("cid").alias("a"), F.col("sig").alias("sig_a"), F.col("n").alias("n_a")), "a")
        pairs = pairs.join(sig.select(F.col("cid").alias("b"), F.col("sig").alias("sig_b"), F.col("n").alias("n_b")), "b")
        # The sizes of two linked sets differ by a quarter at most.
        near = pairs.where(100 * F.least("n_a", "n_b") >= THRESHOLD * F.greatest("n_a", "n_b"))
        return near.select("a", "b", "sig_a", "sig_b").mapInPandas(_estimate, "a long, b long, est double")

    def neighbours(self) -> DataFrame:
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        ordered = self.paths.repartitionByRange(parts, "region", "deep", "cid").sortWithinPartitions("region", "deep", "cid")
        found = staged(ordered.mapInPandas(_neighbours, "region long, a long, b long"), "neardup-neighbours")
        # The last row of a partition and the first of the next: two rows for each partition.
        ends = found.where("b is null")
        seam = Window.partitionBy("region").orderBy("a")
        across = ends.withColumn("b", F.lead("a").over(seam)).where("b is not null")
        return found.where("b is not null").union(across).select("a", "b").where("a <> b")

    def texts(self, cids: DataFrame) -> DataFrame:
        """(cid, text), one row for each of the distinct ``cids``."""
        need = broadcast_if_small(staged(cids.join(self.classes, "cid").select("cid", "doc_id", "digest"), "neardup-needed"))
        same = F.col("d.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("d.digest") == F.col("n.digest"))
        found = staged(self.docs.alias("d").join(need.alias("n"), same).select("cid", "text"), "neardup-texts")
        # Only repeated rows of one id and text give more rows than classes.
        return found.dropDuplicates(["cid"]) if found.count() > need.count() else found

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose full shingle sets are similar enough."""
        texts = self.texts(pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct())
        both = pairs.join(texts.select(F.col("cid").alias("a"), F.col("text").alias("text_a")), "a")
        both = both.join(texts.select(F.col("cid").alias("b"), F.col("text").alias("text_b")), "b")
        return staged(both.select("a", "b", "text_a", "text_b").mapInPandas(_confirm, "a long, b long"), "neardup-links")

    def across(self, joined: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Pairs of a region from different components (``joined``: node, component): likely
        pairs of small regions, and links of crowded ones."""
        member = staged(self.paths.select("region", "cid").join(
            joined.select(F.col("node").alias("cid"), "component"), "cid", "left").select(
            "region", "cid", F.coalesce("component", "cid").alias("component")), "neardup-members")
        several = member.groupBy("region").agg(F.count(F.lit(1)).alias("size"), F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
        member = staged(member.join(several.select("region", "size"), "region"), "neardup-several")
        facts = self.classes.select("cid", "n", "sig")
        few = self._meetings(member.where(F.col("size") <= CROWD).join(facts, "cid"), ["cid", "component", "n", "sig"])
        pairs = staged(few.mapInArrow(_meet, "a long, b long"), "neardup-across").distinct()

        # In a crowded region the shingles that no other text there has bound a text's links.
        many = member.where(F.col("size") > CROWD)
        sets = staged(self.texts(many.select("cid").distinct()).mapInArrow(_sets, "cid long, shingles array<long>"), "neardup-sets")
        own = sets.select("cid", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(
            F.count(F.lit(1)).alias("m"), F.max("cid").alias("cid")).where("m = 1").groupBy("cid").agg(F.count(F.lit(1)).alias("own"))
        facts = facts.join(sets, "cid").join(own, "cid", "left").withColumn("shared", F.col("n") - F.coalesce("own", F.lit(0)))
        crowd = many.join(facts.where(100 * F.col("shared") >= THRESHOLD * F.col("n")), "cid")
        settled = self._meetings(crowd, ["cid", "component", "n", "shared", "sig", "shingles"])
        bounded_batches(self.spark, 8)
        links = staged(settled.mapInArrow(_settle, "a long, b long"), "neardup-settled")
        bounded_batches(self.spark)
        return pairs, links

    def _meetings(self, member: DataFrame, carried: list[str]) -> DataFrame:
        """Pairs of blocks of a region's members.  A large component's members stand in blocks
        of their own, which are never paired with each other; the others are mixed by hash."""
        sizes = member.groupBy("region", "component").agg(F.count(F.lit(1)).alias("m"))
        totals = sizes.groupBy("region").agg(F.sum(F.when(F.col("m") <= BLOCK, F.col("m")).otherwise(0)).alias("rest"))
        large = F.col("m") > BLOCK
        block = F.struct(F.when(large, F.col("component")).alias("of"),
                         F.pmod(F.xxhash64("cid"), F.greatest(F.lit(1), F.ceil(F.when(large, F.col("m")).otherwise(F.col("rest")) / BLOCK)).cast("long")).alias("part"))
        blocks = staged(member.join(sizes, ["region", "component"]).join(totals, "region").groupBy("region", block.alias("block")).agg(
            F.collect_list(F.struct(*carried)).alias("rows")), "neardup-blocks")
        x, y = blocks.alias("x"), blocks.alias("y")
        meet = x.join(y, (F.col("x.region") == F.col("y.region")) & (F.col("x.block") <= F.col("y.block"))
                      & ~F.coalesce(F.col("x.block.of") == F.col("y.block.of"), F.lit(False)))
        return meet.select(F.col("x.region").alias("region"), F.col("x.rows").alias("left"), F.col("y.rows").alias("right"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``digest`` (of its text), ``n_shingles``,
    ``component_id`` (least id of its component), ``stays`` (it is its component's survivor: the
    least by id, null ids last, then by digest; repeated rows of the survivor all are) and
    ``kept`` (its id is its component's)."""
    forest = Forest(docs, id_col, text_col)
    near = staged(forest.estimated(forest.neighbours()), "neardup-near")
    joined, tested = None, None
    # Each class tries its two likeliest neighbours, which joins up a dense region, and then
    # all of other components.
    for most in (2, None):
        open_pairs = near if joined is None else (
            near.join(tested, ["a", "b"], "left_anti")
            .join(joined.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
            .join(joined.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
            .where(~F.coalesce(F.col("ca") == F.col("cb"), F.lit(False))).select("a", "b", "est"))
        now = open_pairs.select("a", "b")
        if most:
            ends = [open_pairs.select(F.col(p).alias("node"), F.col(q).alias("other"), "est") for p, q in ("ab", "ba")]
            rank = F.row_number().over(Window.partitionBy("node").orderBy(F.col("est").desc(), "other"))
            best = ends[0].union(ends[1]).withColumn("r", rank).where(F.col("r") <= most)
            now = best.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()
        now = staged(now, "neardup-now")
        if not now.isEmpty():
            joined = merged(joined, forest.links(now))
        tested = now if tested is None else tested.union(now)
    if joined is None:
        joined = near.select(F.col("a").alias("node"), F.col("b").alias("component")).limit(0)
    pairs, settled = forest.across(joined)
    rest = staged(pairs.join(tested, ["a", "b"], "left_anti"), "neardup-rest")
    found = settled if rest.isEmpty() else settled.union(forest.links(rest))
    if not found.isEmpty():
        joined = merged(joined, found)

    named = forest.classes.select("cid", "digest", "doc_id").join(
        joined.select(F.col("node").alias("cid"), "component"), "cid", "left").select(
        "digest", "doc_id", F.coalesce("component", "cid").alias("component"))
    named = staged(named, "neardup-named")
    # Null ids rank last: the struct's first field says so.
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("digest").alias("digest"))
    least = named.groupBy("component").agg(F.min(rank).alias("first"))
    ids = named.join(least, "component").select("digest", F.col("first.id").alias("component_id"), (F.col("digest") == F.col("first.digest")).alias("chosen"))
    # A text without words is linked with nothing, its copies included.
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    stays = (F.col("n") == 0) | (F.col("chosen") & F.col("doc_id").eqNullSafe(F.col("component_id")))
    return forest.rows.select("doc_id", "digest", "n").join(ids, "digest").select(
        "doc_id", "digest", F.col("n").alias("n_shingles"), own.alias("component_id"), stays.alias("stays"),
        F.coalesce(F.col("doc_id") == own, F.lit(False)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, with all its columns: the survivor, of whose repeated rows a
    single one stays.  Texts without words all stay."""
    spark = docs.sparkSession
    with temporary(spark):
        kept = near_duplicates(docs, id_col, text_col).where("stays")
        # Only this table outlives the search.
        ids = stage(kept.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("_rows"), F.max("n_shingles").alias("_n")), spark, "neardup-kept")[0]
    digest = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    # The caller's columns travel in one: no name can clash.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(id_col).alias("_own"), digest.alias("_digest"))
    found = packed.join(
        ids.select(F.col("doc_id").alias("_id"), F.col("digest").alias("_kept"), "_rows", "_n"),
        F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_digest") == F.col("_kept")))
    single = found.where("_rows = 1 or _n = 0").select("_doc.*")
    # Repeated rows of one id and text: a single one stays.
    repeated = found.where("_rows > 1 and _n > 0").dropDuplicates(["_id", "_digest"]).select("_doc.*")
    return single.union(repeated)


def op3_minhash_lsh_forest(spark, sf_dir: str) -> DataFrame:
    """All documents with their near-duplicate component."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


QUERIES = {"op3_minhash_lsh_forest": op3_minhash_lsh_forest}
ORACLE: dict[str, str] = {}
