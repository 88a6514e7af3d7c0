"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (``a``, ``b`` long); the component is
    its smallest node.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until nothing changes,
    each step written to the shared checkpoint folder.  Self loops and repeated edges are fine.
    """
    now = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        # Large star: each node links its larger neighbours to the least node around it.
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        now = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Small star: each node links its smaller neighbours and itself to the least of them.
        least = now.groupBy("a").agg(F.min("b").alias("m"))
        now = staged(now.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
                     .union(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    # All edges are stars now: every node has one edge, to the least node.
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())


def merged(joined: DataFrame | None, links: DataFrame) -> DataFrame:
    """``joined`` (node, component) after ``links`` (a, b) more: only the graph of the
    components that the links touch is searched."""
    if joined is None:
        return staged(connected_components(links), "components")
    of = joined.select("node", "component")
    ends = links.join(of.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(
        of.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left").select(
        "a", "b", F.coalesce("ca", "a").alias("ca"), F.coalesce("cb", "b").alias("cb"))
    ends = staged(ends, "component-links")
    over = staged(connected_components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b"))), "component-map")
    # Nodes without a component so far stand for themselves.
    new = ends.where("a = ca").select(F.col("a").alias("node")).union(ends.where("b = cb").select("b")).distinct()
    new = new.join(of, "node", "left_anti").select("node", F.col("node").alias("component"))
    out = of.union(new).join(over.select(F.col("node").alias("component"), F.col("component").alias("top")), "component", "left")
    return staged(out.select("node", F.coalesce("top", "component").alias("component")), "components")
