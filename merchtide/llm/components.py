"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchtide.sources.storage import stage


def connected(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; the root is its component's smallest node.

    Alternates two rewrites until nothing changes: each node hands its larger neighbours to
    the smallest node it knows, then its smaller ones. The number of edges never grows and
    the rounds are logarithmic in the longest chain. Every round is a written table, so a
    lost executor costs one round. Only two numbers per round reach the driver. Null ends
    and loops are left out; an empty table gives an empty result.
    """
    links = (
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    links = stage(links, "links")
    before = _mark(links)
    while True:
        links = stage(_to_smaller(_to_larger(links)), "links")
        after = _mark(links)
        if after == before:
            break
        before = after
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(links.select("b", "b")).distinct()


def _mark(links: DataFrame) -> tuple:
    mark = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(mark)


def _to_larger(links: DataFrame) -> DataFrame:
    """Each node connects its larger neighbours to the smallest node around it."""
    around = links.select("a", "b").union(links.select("b", "a"))
    smallest = around.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return (
        around.where("b > a").join(smallest, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _to_smaller(links: DataFrame) -> DataFrame:
    """Each node connects itself and its smaller neighbours to the smallest of them."""
    smallest = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(smallest, "a").where("b <> m").select("b", "m")
    return smallest.select("a", F.col("m").alias("b")).union(moved).distinct()
