"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, component): each node of ``links`` (a, b), with the smallest node that it reaches.

    Alternating stars: every node's larger neighbours are tied to its smallest neighbour, then its smaller
    ones, until nothing changes; the rounds grow with the logarithm of the longest path. The smallest
    neighbour is a combined aggregate and is joined back, so a node with very many links is never gathered.
    Each round is a table in the shared folder. Links from a node to itself and with null are left out.
    """
    edges = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.filter("a <> b")
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
        edges = materialize(small.select("e.a", F.col("e.m").alias("b")).filter("a <> b").distinct(), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    # Now every node but the smallest of a component has one link, to that one.
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.shiftright(F.xxhash64("a", "b"), 20)), F.sum(F.shiftright(F.xxhash64("b", "a"), 20))).first()
    return tuple(row)
