"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftgate.llm.store import checkpointed


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _star(links: DataFrame, kept) -> DataFrame:
    """Link the kept neighbours of each node u to the smallest of u and its neighbours.

    The smallest neighbour is a pre-aggregated minimum joined back, so that a
    node with very many neighbours is never one group; the join may split it.
    """
    low = links.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).withColumnRenamed("u", "w")
    return links.join(low, links["u"] == low["w"]).select("u", "v", "m").where(kept)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): component is the smallest node reachable over ``edges`` (columns a, b of one integer type).

    Nodes without an edge to another node do not appear; an empty table gives
    no rows.  Each round is cut in the shared checkpoint folder.
    """
    now = checkpointed(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _stars(now):
        large = _star(_both(now), F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # small star: neighbours not above u, and u itself, go to the smallest
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low.withColumnRenamed("u", "w"), F.col("u") == F.col("w")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        small = small.union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()
        now = checkpointed(small)
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots.select("b", F.col("b")))


def _stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one root, and no root on another node."""
    roles = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    both = roles.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return both.where((F.col("up") > 1) | ((F.col("up") == 1) & (F.col("down") == 1))).isEmpty()


def merged(label: DataFrame | None, edges: DataFrame) -> DataFrame:
    """The components after more edges: only the components that they join are worked on."""
    if label is None:
        return checkpointed(components(edges))
    of = lambda c: label.select(F.col("node").alias(c), F.col("component").alias(f"{c}_in"))
    short = edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
    more = checkpointed(components(short.select(F.coalesce("a_in", "a").alias("a"), F.coalesce("b_in", "b").alias("b"))))
    to = more.select(F.col("node").alias("component"), F.col("component").alias("now"))
    old = label.join(to, "component", "left").select("node", F.coalesce("now", "component").alias("component"))
    return checkpointed(old.union(more.join(label, "node", "left_anti")))
