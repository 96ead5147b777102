"""Connected components by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slotwise.llm.staging import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the smallest of these."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(smallest, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (a, b); a component is named by its smallest node.

    Neither end may be null; loops and repeated edges do no harm. A round is two
    aggregates and two joins; the joins of a node with very many links are
    split by the adaptive planner, as nothing after them needs a node's links
    together. Rounds end when a round changes nothing. Every round is staged.
    Nodes whose only edge is a loop are included.
    """
    nodes = edges.select(F.col("a").alias("node")).where("a = b").distinct()
    links = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = staged(links)
    mark = _mark(links)
    while mark[0]:
        links = staged(_small_star(_large_star(links)))
        before, mark = mark, _mark(links)
        if mark == before:
            break
    tied = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = tied.select("component").distinct()
    centres = centres.select(F.col("component").alias("node"), "component")
    found = tied.unionByName(centres)
    loops = nodes.join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    return found.unionByName(loops)


def _mark(links: DataFrame) -> tuple:
    """The number of links and a sum that any changed link changes."""
    row = links.agg(
        F.count("*"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        F.sum(F.hash("v", "u").cast("long")),
    ).first()
    return tuple(row)
