"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source gets a token target: its weight's share of the budget, at most ``max_epochs``
times its size, the excess shared again by weight.  Whole epochs come first (every document
once or twice); the fractional rest is a weighted sample without replacement: each document
draws an exponential key -ln(u) / quality, u from a hash of its id, text and a seed, and a source
takes documents by ascending key until its rest is spent.

A source may hold a third of all rows, so no task ranks a source: a histogram over key
prefixes gives, by exact sums, the bin where the rest runs out; it is refined until that bin
is small.  Bins below it are taken whole, and only its rows are ordered.

Nulls and odd input: a null text has size 0; a null source is a source of its own, last in
order; rows with a null id draw by their text; a null quality counts as 1; repeated rows are documents of their own; a source of
size 0 has target 0; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import broadcast_if_small, hash_bits, n_words, staged, table

SEED = 20240
#: Sampling weight by the quality label; unlabelled documents weigh 1.
QUALITY_WEIGHTS = {1: 2.0, 0: 0.5}
SOURCE_WEIGHTS = (3, 1, 2)
#: Bits of the key below each histogram's prefixes; the lowest 12 bits are the row's salt.
SHIFTS = (51, 39, 27, 12, 0)
#: The bin that a source's rest ends in is refined while it has more rows than this.
BOUNDARY_ROWS = 2000


def exponential_key(identity: Column, quality: Column, salt: Column, seed: int) -> Column:
    """63 bits that order rows as -ln(u) / quality does, copies of a row by a 12-bit salt."""
    u = (hash_bits(52, identity, F.lit(seed)).cast("double") + 0.5) / float(1 << 52)
    # 1 - exp(-key) = 1 - u ** (1 / quality) rises with the key and lies between 0 and 1.
    fraction = F.lit(1.0) - F.pow(u, F.lit(1.0) / quality)
    scaled = F.least(F.floor(fraction * float(1 << 51)), F.lit((1 << 51) - 1))
    return F.shiftleft(scaled, 12).bitwiseOR(salt)


def source_targets(sizes: DataFrame, budget: float, weights: tuple[int, ...], max_epochs: int) -> DataFrame:
    """One row per source (columns ``source``, ``source_size``) with ``target``.

    Sources reach their cap in order of cap over weight; the level (target per weight) is the
    one at the first source that stays below its cap.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    # A few rows: one for each source.
    named = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    order = Window.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last())
    before, all_rows = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0.0)
    return (named.withColumn("_cap", F.col("source_size") * float(max_epochs))
            .withColumn("_budget", F.sum("source_size").over(all_rows) * float(budget))
            .withColumn("_level", (F.col("_budget") - F.coalesce(F.sum("_cap").over(before), zero))
                        / (F.sum("_w").over(all_rows) - F.coalesce(F.sum("_w").over(before), zero)))
            .withColumn("_first", F.min(F.when(F.col("_cap") > F.col("_level") * F.col("_w"), F.struct(F.row_number().over(order).alias("r"), F.col("_level").alias("level")))).over(all_rows))
            .withColumn("_level", F.col("_first.level"))
            .withColumn("target", F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("_w"), F.col("_cap"))))
            .select("source", "source_size", "target"))


def mix_sources(docs: DataFrame, quality: DataFrame | None = None, budget: float = 1.5,
                weights: tuple[int, ...] = SOURCE_WEIGHTS, max_epochs: int = 2, seed: int = SEED,
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                carry: list[str] | None = None) -> DataFrame:
    """Every row with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``.

    ``quality`` has one sampling weight per id (``doc_id``, ``quality_weight``); without it all
    weigh 1.  ``carry`` names the columns that come along (default: the id only).
    """
    made = {"size", "source_size", "target", "copies", "taken"}
    keep = [c for c in (carry if carry is not None else [id_col]) if c not in made]
    rows = docs.select(*keep, F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), n_words(F.col(text_col)).alias("_size"),
                       F.xxhash64(F.col(id_col), F.col(text_col)).alias("_identity"), hash_bits(12, F.monotonically_increasing_id()).alias("_salt"))
    if quality is not None:
        weights_of = staged(quality.select(F.col("doc_id").alias("_id"), F.col("quality_weight").alias("_q")), "mix-quality")
        rows = rows.join(broadcast_if_small(weights_of), "_id", "left")
    else:
        rows = rows.withColumn("_q", F.lit(None).cast("double"))
    rows = staged(rows.withColumn("_key", exponential_key(F.col("_identity"), F.coalesce("_q", F.lit(1.0)), F.col("_salt"), seed))
                  .drop("_q", "_salt", "_identity"), "mix")

    sizes = rows.groupBy(F.col("_source").alias("source")).agg(F.sum("_size").alias("source_size"))
    # A row for each source; from here on sources go by number, as null does not join.
    targets = source_targets(sizes, budget, weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    targets = staged(targets.withColumn("_epochs", epochs)
                     .withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
                     .withColumnRenamed("source", "_source"), "mix-targets")
    return _sampled(rows, targets, keep)


def _sampled(rows: DataFrame, targets: DataFrame, keep: list[str]) -> DataFrame:
    # The bin where each source's rest runs out, narrowed round by round: (_source, _at, _left):
    # the bin's first key and what is left of the rest when the bin begins.
    ends = targets.where("_rest > 0").select("_source", F.lit(0).cast("long").alias("_at"), F.col("_rest").alias("_left"))
    above = 63
    for shift in SHIFTS:
        inside = rows.alias("r").join(
            ends.alias("e"), F.col("r._source").eqNullSafe(F.col("e._source")) & (F.shiftright("_key", above) == F.shiftright("_at", above))
        ).select("r._source", F.shiftright("_key", shift).alias("_bin"), "_size", "_left")
        bins = inside.groupBy("_source", "_bin").agg(F.sum("_size").alias("_w"), F.count(F.lit(1)).alias("_n"), F.min("_left").alias("_left"))
        run = Window.partitionBy("_source").orderBy("_bin")
        sums = bins.withColumn("_upto", F.sum("_w").over(run)).where(F.col("_upto") >= F.col("_left"))
        ends = staged(sums.groupBy("_source").agg(F.min(F.struct("_bin", "_upto", "_w", "_n", "_left")).alias("b")).select(
            "_source", F.shiftleft("b._bin", shift).alias("_at"), (F.col("b._left") - F.col("b._upto") + F.col("b._w")).alias("_left"),
            F.col("b._n").alias("_n")), "mix-ends")
        above = shift
        if (ends.agg(F.max("_n")).first()[0] or 0) <= BOUNDARY_ROWS:
            break
    # In the last bin, by key: a document is taken if that brings the source nearer its target.
    in_last = rows.alias("r").join(
        ends.alias("e"), F.col("r._source").eqNullSafe(F.col("e._source")) & (F.shiftright("_key", above) == F.shiftright("_at", above))
    ).select("r._source", "r._key", "r._id", "r._size", "e._left")
    run = Window.partitionBy("_source").orderBy("_key", "_id", "_size").rowsBetween(Window.unboundedPreceding, 0)
    cut = (in_last.withColumn("_upto", F.sum("_size").over(run))
           .withColumn("_edge", F.struct("_key", "_id", "_size"))
           .where(F.col("_upto") - F.col("_size") / 2 <= F.col("_left"))
           .groupBy("_source").agg(F.max("_edge").alias("_edge")))
    plan = staged(targets.alias("t")
                  .join(ends.alias("e"), F.col("t._source").eqNullSafe(F.col("e._source")), "left")
                  .join(cut.alias("c"), F.col("t._source").eqNullSafe(F.col("c._source")), "left")
                  .select("t._source", "source_size", "target", "_epochs", "_rest", "_at", "_edge"), "mix-plan")
    r = rows.alias("r").join(plan.alias("p"), F.col("r._source").eqNullSafe(F.col("p._source")))
    drawn = F.when(F.col("_rest") <= 0, False).when(F.col("_at").isNull(), True).when(
        F.shiftright("_key", above) != F.shiftright("_at", above), F.col("_key") < F.col("_at")).otherwise(
        F.coalesce(F.struct("r._key", "r._id", "r._size") <= F.col("_edge"), F.lit(False)))
    copies = (F.col("_epochs") + drawn.cast("int")).cast("int")
    return (r.withColumn("copies", copies)
            .select(*[F.col(f"r.{c}") for c in keep], F.col("r._size").alias("size"), "source_size", "target", "copies",
                    (F.col("copies") * F.col("r._size")).cast("long").alias("taken")))


def quality_weights(labels: DataFrame) -> DataFrame:
    """One sampling weight per labelled id; of several labels the highest counts."""
    w = F.element_at(F.create_map(*[F.lit(x) for kv in QUALITY_WEIGHTS.items() for x in kv]), F.col("quality").cast("int"))
    return (labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
            .select("doc_id", F.coalesce(F.when(F.col("quality").isin(*QUALITY_WEIGHTS), w), F.lit(1.0)).alias("quality_weight")))


def op2_mix_sources(spark, sf_dir: str) -> DataFrame:
    """All documents, mixed to 150 % of their words."""
    out = mix_sources(table(spark, sf_dir, "documents"), quality_weights(table(spark, sf_dir, "labels")))
    return out.select("doc_id", "size", "source_size", "target", "taken", "copies")


QUERIES = {"op2_mix_sources": op2_mix_sources}
ORACLE: dict[str, str] = {}
