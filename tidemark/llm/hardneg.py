"""Hard negatives by an STR-packed R-tree.

Components become integers floor(256 x); a score is the integer inner product of a row and an
anchor.  A box that bounds the components of some rows bounds their scores with an anchor from
both sides, coordinate by coordinate: each product lies between its values at the two ends.

Index.  A bounded sample of the rows gives the upper level by sort-tile-recursion: the label
first, then the components in order of their spread, each cutting the tiles it gets into slabs
of equal numbers.  Every row is assigned to its tile, and a tile is dealt into blocks of at most
about ``BLOCK_ROWS`` rows (a tile of equal rows makes many).  The tiles' boxes, labels included,
are exact over all rows.  Inside a block the rows are packed by sort-tile-recursion into leaves
and the leaves into nodes.

Search.  An anchor goes to the blocks of every tile whose box may hold rows of the wanted label
with a score that still counts.  In a block a best-first queue opens the node with the highest
possible score first and prunes those outside the score windows or strictly below the k-th best
found.  A first round asks one block of the most promising tile, whose k-th score then prunes
whole tiles.  Positives are searched first (same label, no window); their scores make the windows
in which the negatives are searched, all windows of an anchor at once.

A block's rows are read before the anchors that ask it, which then stream through in batches:
no task holds more than one block and one batch, however many anchors ask it, and no row is
copied for them.

Nulls and odd input: rows with a null id, label or vector, or with a null or non-finite component,
take no part; shorter vectors count as padded with zeros; repeated ids are rows of their own, as
anchors too; ties go to the smaller id; scores beyond 64 bits count as the nearest number of 64 bits; an empty table, or
one without anchors, gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged, table

#: Rows whose distribution sets the tiles, rows a tile should have, and most tiles.
SAMPLE_ROWS, TILE_ROWS, MOST_TILES = 16_384, 4096, 256
#: Rows of a block, of a leaf, and leaves of a node.
BLOCK_ROWS, LEAF_ROWS, NODE_LEAVES = 8192, 128, 8
#: Components that the leaves of a block are sorted by.
LEAF_AXES = 3
EXACT = 1 << 53
#: Larger components count as this: every score with them is beyond 64 bits, or 0.
LARGEST = 2.0 ** 300
LONG = np.iinfo(np.int64)

ROW = "uid long, vec_id long, label long, anchor boolean, vec binary"


def _quantised(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for v in batch["embedding"]:
                x = v.as_py()
                x = np.array(x, dtype=np.float64) if None not in x else np.array([np.nan])
                q = np.zeros(dims)
                # float64 holds floor(256 x) exactly: a shift of the exponent, then whole numbers.
                q[:len(x)] = np.floor(256 * np.clip(x, -LARGEST, LARGEST))
                out.append(q.tobytes() if np.isfinite(x).all() else None)
            whole = pa.RecordBatch.from_arrays([batch[c] for c in ("uid", "vec_id", "label", "anchor")] + [pa.array(out, pa.binary())],
                                               names=["uid", "vec_id", "label", "anchor", "vec"])
            yield whole.filter(whole["vec"].is_valid())
    return run


def matrix(vecs, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(vecs), dtype="<f8").reshape(-1, dims)


def products(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Exact inner products: in floating point where that is exact, else in Python's integers;
    beyond 64 bits the nearest number of 64 bits."""
    if len(rows) and np.abs(rows).max() * max(1.0, np.abs(anchor).sum()) < EXACT:
        return (rows @ anchor).astype(np.int64)
    whole = [int(a) for a in anchor]
    return np.array([max(LONG.min, min(LONG.max, sum(int(r) * a for r, a in zip(row, whole)))) for row in rows], dtype=np.int64)


def slabs(order: np.ndarray, values: np.ndarray, axes: list[int], tiles: int) -> list[np.ndarray]:
    """Sort-tile-recursion over rows ``order``: sorted by the first axis and cut into as many
    slabs of equal numbers as the axes left allow for ``tiles`` tiles, each cut by the next."""
    if tiles <= 1 or not axes or len(order) <= 1:
        return [order]
    n = min(tiles, max(2, int(np.ceil(tiles ** (1 / len(axes))))))
    order = order[np.argsort(values[order, axes[0]], kind="stable")]
    return [part for slab in np.array_split(order, n) for part in slabs(slab, values, axes[1:], -(-tiles // n)) if len(part)]


def split_tree(values: np.ndarray, axes: list[int], tiles: int):
    """The upper level as nested cuts (axis, bounds, children), or None for a tile: rows equal to
    a bound go above it, so that a label is never cut."""
    if tiles <= 1 or not axes or len(values) <= 1:
        return None
    axis, rest = axes[0], axes[1:]
    n = min(tiles, max(2, int(np.ceil(tiles ** (1 / len(axes))))) if axis else tiles)
    ranks = np.sort(values[:, axis])[[len(values) * i // n for i in range(1, n)]]
    bounds = np.unique(ranks)
    bounds = bounds[bounds > values[:, axis].min()]
    if not len(bounds):
        return split_tree(values, rest, tiles)
    part = np.searchsorted(bounds, values[:, axis], side="right")
    return axis, bounds, [split_tree(values[part == i], rest, -(-tiles // (len(bounds) + 1))) for i in range(len(bounds) + 1)]


def n_tiles(tree) -> int:
    return 1 if tree is None else sum(map(n_tiles, tree[2]))


def tile_of(tree, values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values), dtype=np.int32)
    if tree is None:
        return out
    axis, bounds, children = tree
    part, first = np.searchsorted(bounds, values[:, axis], side="right"), 0
    for i, child in enumerate(children):
        here = np.flatnonzero(part == i)
        out[here] = first + tile_of(child, values[here])
        first += n_tiles(child)
    return out


def _tiles(tree, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                values = np.column_stack([batch["label"].to_numpy(), matrix(batch["vec"].to_pylist(), dims)])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tile_of(tree, values))], names=[*batch.schema.names, "tile"])
    return run


def _boxes(dims: int):
    """One box per tile and task: least and greatest label and components, and the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        boxes: dict[int, list] = {}
        for batch in batches:
            tiles = batch["tile"].to_numpy()
            values = np.column_stack([batch["label"].to_numpy(), matrix(batch["vec"].to_pylist(), dims)])
            for t in np.unique(tiles):
                own = values[tiles == t]
                low, high, n = boxes.get(t, (own[0], own[0], 0))
                boxes[t] = (np.minimum(low, own.min(axis=0)), np.maximum(high, own.max(axis=0)), n + len(own))
        if boxes:
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(t) for t in boxes], pa.int32()), pa.array([b[0].tobytes() for b in boxes.values()], pa.binary()),
                 pa.array([b[1].tobytes() for b in boxes.values()], pa.binary()), pa.array([b[2] for b in boxes.values()], pa.int64())],
                names=["tile", "low", "high", "n"])
    return run


def _merge_boxes(dims: int):
    def run(t: pa.Table) -> pa.Table:
        low, high = (matrix(t[c].to_pylist(), dims + 1) for c in ("low", "high"))
        return pa.table({"tile": t["tile"][:1], "low": pa.array([low.min(axis=0).tobytes()], pa.binary()),
                         "high": pa.array([high.max(axis=0).tobytes()], pa.binary()), "n": pa.array([sum(t["n"].to_pylist())], pa.int64())})
    return run


def score_bounds(low: np.ndarray, high: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest scores that rows inside each box can have with each anchor (anchors
    by boxes), widened beyond any rounding."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    margin = 1 + 1e-9 * (np.abs(anchors) @ np.maximum(np.abs(low), np.abs(high)).T)
    return up @ low.T + down @ high.T - margin, up @ high.T + down @ low.T + margin


def may_hold(low_label, high_label, label, same: bool):
    """Whether a box with such labels can hold rows of the wanted kind (boxes hold labels as
    floating point, where very large ones may coincide)."""
    if same:
        return (low_label <= label) & (label <= high_label)
    return (low_label != label) | (high_label != label) | (abs(label) >= EXACT)


class Tree:
    """A block's rows packed into leaves and nodes."""

    def __init__(self, rows: pa.Table, dims: int):
        x = matrix(rows["vec"].to_pylist(), dims)
        axes = [int(a) for a in np.argsort(-x.std(axis=0), kind="stable")[:LEAF_AXES]]
        packed = slabs(np.arange(len(x)), x, axes, -(-len(x) // LEAF_ROWS))
        order = np.concatenate(packed)
        self.x, self.uid = x[order], rows["uid"].to_numpy()[order]
        self.vec_id, self.label = rows["vec_id"].to_numpy()[order], rows["label"].to_numpy()[order]
        self.leaf = np.concatenate([[0], np.cumsum([len(p) for p in packed])])
        values = np.column_stack([self.label, self.x])
        low, high = (f.reduceat(values, self.leaf[:-1], axis=0) for f in (np.minimum, np.maximum))
        first = np.arange(0, len(packed), NODE_LEAVES)
        self.low = np.concatenate([low, *(np.minimum.reduceat(low, first, axis=0),)])
        self.high = np.concatenate([high, *(np.maximum.reduceat(high, first, axis=0),)])
        self.leaves = len(packed)

    def search(self, low: np.ndarray, high: np.ndarray, anchor: np.ndarray, uid: int, label: int, same: bool, k: int, windows: list) -> list[list]:
        """Per window (least, greatest score) the k best rows as (score, vec_id, uid)."""
        found: list[list] = [[] for _ in windows]
        floor = [w[0] for w in windows]
        ceiling = [w[1] if w[1] < LONG.max else np.inf for w in windows]

        def wanted(node: int) -> bool:
            return any(low[node] <= c and high[node] >= f for f, c in zip(floor, ceiling))
        usable = may_hold(self.low[:, 0], self.high[:, 0], label, same)
        queue = [(-high[n], n) for n in range(self.leaves, len(self.low)) if usable[n] and wanted(n)]
        heapq.heapify(queue)
        while queue:
            _, node = heapq.heappop(queue)
            if not wanted(node):
                continue
            if node >= self.leaves:
                first = (node - self.leaves) * NODE_LEAVES
                for n in range(first, min(first + NODE_LEAVES, self.leaves)):
                    if usable[n] and wanted(n):
                        heapq.heappush(queue, (-high[n], n))
                continue
            at = slice(self.leaf[node], self.leaf[node + 1])
            score = products(self.x[at], anchor)
            take = ((self.label[at] == label) if same else (self.label[at] != label)) & (self.uid[at] != uid)
            for i, (f, c) in enumerate(zip(floor, ceiling)):
                for j in np.flatnonzero(take & (score >= f) & (score <= c)):
                    row = (int(score[j]), -int(self.vec_id[at.start + j]), -int(self.uid[at.start + j]))
                    (heapq.heappush if len(found[i]) < k else heapq.heappushpop)(found[i], row)
                if len(found[i]) == k:
                    floor[i] = max(f, found[i][0][0])
        return [[(s, -v, -u) for s, v, u in rows] for rows in found]


ASK = "auid long, alabel long, avec binary, floors array<long>, ceilings array<long>"
FOUND = "auid long, place int, uid long, vec_id long, score long"


def _search(dims: int, same: bool, k: int):
    """Blocks one after the other, each block's rows before its anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows, tree = None, [], None
        for batch in batches:
            keys = list(zip(batch["tile"].to_pylist(), batch["block"].to_pylist(), batch["ask"].to_pylist()))
            cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                part, (tile, block, ask) = batch.slice(i, j - i), keys[i]
                if key != (tile, block):
                    key, rows, tree = (tile, block), [], None
                if not ask:
                    rows.append(part.select(["uid", "vec_id", "label", "vec"]))
                    continue
                if tree is None:
                    if not rows:
                        continue
                    tree, rows = Tree(pa.Table.from_batches(rows), dims), []
                anchors = matrix(part["avec"].to_pylist(), dims)
                low, high = score_bounds(tree.low[:, 1:], tree.high[:, 1:], anchors)
                out = []
                for a, (uid, label, floors, ceilings) in enumerate(zip(*(part[c].to_pylist() for c in ("auid", "alabel", "floors", "ceilings")))):
                    got = tree.search(low[a], high[a], anchors[a], uid, label, same, k, list(zip(floors, ceilings)))
                    out += [(uid, place, u, v, s) for place, best in enumerate(got) for s, v, u in best]
                if out:
                    cols = list(zip(*out))
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:])],
                                                     names=["auid", "place", "uid", "vec_id", "score"])
    return run


def _routes(boxes: tuple, same: bool, only_best: bool):
    """The tiles an anchor must ask, or only the one that promises the highest score."""
    tiles, low, high = boxes
    dims = low.shape[1] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            least, most = score_bounds(low[:, 1:], high[:, 1:], matrix(batch["avec"].to_pylist(), dims))
            out = []
            for a, (label, floors, ceilings) in enumerate(zip(*(batch[c].to_pylist() for c in ("alabel", "floors", "ceilings")))):
                use = np.zeros(len(tiles), dtype=bool)
                for f, c in zip(floors, ceilings):
                    use |= (least[a] <= (c if c < LONG.max else np.inf)) & (most[a] >= f)
                use &= may_hold(low[:, 0], high[:, 0], label, same)
                some = np.flatnonzero(use)
                out.append([int(tiles[t]) for t in (some[np.argsort(-most[a][some], kind="stable")[:1]] if only_best else some)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=[*batch.schema.names, "tiles"])
    return run


class Forest:
    """All rows in tiles and blocks, with the tiles' boxes."""

    def __init__(self, rows: DataFrame, dims: int):
        self.dims, total = dims, rows.count()
        order = F.xxhash64("uid", F.lit("tiles"))
        sample = rows.orderBy(order, "uid").limit(SAMPLE_ROWS).select("label", "vec").toArrow()
        values = np.column_stack([sample["label"].to_numpy().astype(np.float64), matrix(sample["vec"].to_pylist(), dims)])
        axes = [0, *(1 + int(a) for a in np.argsort(-values[:, 1:].std(axis=0), kind="stable"))]
        tree = split_tree(values, axes, min(MOST_TILES, -(-total // TILE_ROWS)))
        tiled = staged(rows.mapInArrow(_tiles(tree, dims), ROW + ", tile int"), "hardneg-tiles")
        # One row per tile reaches the driver.
        schema = "tile int, low binary, high binary, n long"
        boxes = tiled.mapInArrow(_boxes(dims), schema).groupBy("tile").applyInArrow(_merge_boxes(dims), schema).orderBy("tile").toArrow()
        self.boxes = (boxes["tile"].to_numpy(), *(matrix(boxes[c].to_pylist(), dims + 1) for c in ("low", "high")))
        blocks = np.zeros(max(1, n_tiles(tree)), dtype=int)
        blocks[self.boxes[0]] = [-(-n // BLOCK_ROWS) for n in boxes["n"].to_pylist()]
        self.parts = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("tile") + 1)
        self.rows = tiled.withColumn("block", F.pmod(F.xxhash64("uid", F.lit("block")), self.parts).cast("int"))

    def ask(self, asks: DataFrame, same: bool, k: int, only_best: bool) -> DataFrame:
        """The k best rows of each block that an ask reaches, per window."""
        routed = asks.mapInArrow(_routes(self.boxes, same, only_best), ASK + ", tiles array<int>").withColumn("tile", F.explode("tiles"))
        blocks = F.sequence(F.lit(0), self.parts - 1)
        one = F.pmod(F.xxhash64("auid", F.lit("first")), self.parts).cast("int")
        routed = routed.withColumn("block", one if only_best else F.explode(blocks))
        need = F.broadcast(routed.select("tile").distinct())                    # at most MOST_TILES rows
        data = self.rows.join(need, "tile", "left_semi").select("tile", "block", F.lit(0).alias("ask"), "uid", "vec_id", "label", "vec")
        both = data.unionByName(routed.select("tile", "block", F.lit(1).alias("ask"), "auid", "alabel", "avec", "floors", "ceilings"), allowMissingColumns=True)
        return both.repartition("tile", "block").sortWithinPartitions("tile", "block", "ask").mapInArrow(_search(self.dims, same, k), FOUND)

    def best(self, asks: DataFrame, same: bool, k: int) -> DataFrame:
        """The k best rows per ask and window over all blocks, with their ``rank``."""
        first = self.ask(asks, same, k, True).groupBy("auid", "place").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
        known = first.groupBy("auid").agg(F.map_from_entries(F.collect_list(F.struct("place", "kth"))).alias("kths"))    # as many as windows
        raised = F.transform("floors", lambda f, i: F.greatest(f, F.coalesce(F.element_at("kths", i), f)))
        asks = staged(asks.join(known, "auid", "left").select("auid", "alabel", "avec", F.when(F.col("kths").isNull(), F.col("floors")).otherwise(
            raised).alias("floors"), "ceilings"), "hardneg-asks")
        order = Window.partitionBy("auid", "place").orderBy(F.col("score").desc(), "vec_id", "uid")
        return self.ask(asks, same, k, False).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, n_positives: int = 5, n_negatives: int = 10,
                   low_percent: int = 30, high_percent: int = 90, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``,
    ``negative_score``: per anchor, its best rows of its own label, and for each of these the
    best rows of other labels whose score is within the two percentages of the positive's."""
    spark = vectors.sparkSession
    slim = vectors.where(F.col(id_col).isNotNull() & label.isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
        F.col(vector_col).alias("embedding")).withColumn("uid", F.monotonically_increasing_id())
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    dims = slim.agg(F.max(F.size("embedding"))).first()[0]
    if dims is None:
        return empty
    dims = max(1, dims)
    rows = staged(slim.select("uid", "vec_id", "label", "anchor", "embedding").mapInArrow(_quantised(dims), ROW), "hardneg-rows")
    if rows.where("anchor").isEmpty():
        return empty
    forest = Forest(rows, dims)
    anchors = rows.where("anchor").select(F.col("uid").alias("auid"), F.col("vec_id").alias("anchor_id"), F.col("label").alias("alabel"), F.col("vec").alias("avec"))

    def all_scores(value):
        return F.array(F.lit(int(value)).cast("long"))
    asks = anchors.select("auid", "alabel", "avec", all_scores(LONG.min).alias("floors"), all_scores(LONG.max).alias("ceilings"))
    positives = staged(forest.best(staged(asks, "hardneg-asks"), True, n_positives).select(
        "auid", (F.col("rank") - 1).cast("int").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "hardneg-positives")
    # low * positive <= 100 * negative <= high * positive, in whole numbers.
    score = F.col("positive_score").cast("decimal(38,0)")
    windows = positives.withColumn("f", F.ceil(score * low_percent / 100).cast("long")).withColumn("c", F.floor(score * high_percent / 100).cast("long"))
    windows = windows.groupBy("auid").agg(F.sort_array(F.collect_list(F.struct("place", "f", "c"))).alias("w")).select(
        "auid", F.col("w.f").alias("floors"), F.col("w.c").alias("ceilings"))
    asks = staged(anchors.join(windows, "auid").select("auid", "alabel", "avec", "floors", "ceilings"), "hardneg-asks")
    negatives = forest.best(asks, False, n_negatives)
    return (negatives.join(positives, ["auid", "place"]).join(anchors.select("auid", "anchor_id"), "auid").select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def op11_rtree_hard_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every 100th vector; the labels of every 7th are moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


QUERIES = {"op11_rtree_hard_negatives": op11_rtree_hard_negatives}
ORACLE = {"op11_rtree_hard_negatives": """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, d.vec_id, a.label = d.label AS same, CAST(list_inner_product(a.e, d.e) AS BIGINT) AS score
    FROM v a JOIN v d ON a.vec_id % 100 = 0 AND a.vec_id <> d.vec_id
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
    SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
    FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""}
