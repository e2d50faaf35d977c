"""Connected components by alternating large-star and small-star steps (Kiveris et al. 2014).

Nothing is collected: every step is a grouped minimum (combined before the shuffle) and
a join on the node, and its edges are written to the shared folder, so a hub with very
many neighbours is only ever aggregated or split by the skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import Workspace, merged


def _is_star(edges: DataFrame) -> bool:
    """Every node has one parent, and no parent has a parent."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("child"), F.lit(0).alias("root")).unionAll(edges.select(F.col("v"), F.lit(0), F.lit(1)))
    odd = ends.groupBy("n").agg(F.sum("child").alias("child"), F.max("root").alias("root")).where((F.col("child") > 1) | ((F.col("child") > 0) & (F.col("root") > 0)))
    return odd.isEmpty()


def components(links: DataFrame, ws: Workspace) -> DataFrame:
    """(node, root) for every node of the undirected links (u, v) that isn't itself the root.

    root is the smallest node of the component. Nodes without links aren't returned.
    Loops and repeated links are allowed; links with a null end are ignored.
    """
    edges = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    edges = ws.save(edges.distinct(), "edges")
    while not _is_star(edges):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(merged(low), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = ws.save(large, "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(merged(low), "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = ws.save(moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), "small")
        ws.drop(edges, large)
        edges = small
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
