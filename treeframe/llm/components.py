"""Connected components of links between integer nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeframe.llm.rows import saved


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is a node of it.

    Each round gives every node the smallest node next to it, replaces the ends
    of all links by those and drops what became a loop, until no link is left:
    chains shorten by half or better, and a star is done in one round. Links
    are aggregated with partial minima, so a hub costs one row for each task.
    The links of a round and the nodes' new names are written, which cuts the
    lineage.
    """
    edges = saved(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .filter("a <> b").distinct(),
        "links", links.count(),
    )
    named, n = None, edges.count()
    nodes = 2 * n
    while n:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = saved(
            both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("up")),
            "link-parents", 2 * n,
        )
        at_a = parent.select(F.col("node").alias("a"), F.col("up").alias("up_a"))
        at_b = parent.select(F.col("node").alias("b"), F.col("up").alias("up_b"))
        edges = saved(
            edges.join(at_a, "a").join(at_b, "b").filter("up_a <> up_b")
            .select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b"))
            .distinct(),
            "links", n,
        )
        n = edges.count()
        if named is None:
            named = parent.select("node", F.col("up").alias("component"))
        else:
            step = parent.select(F.col("node").alias("component"), "up")
            named = saved(
                named.join(step, "component", "left")
                .select("node", F.coalesce("up", "component").alias("component")),
                "link-names", nodes,
            )
    if named is None:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component"))
    return named
