"""Connected components of an undirected graph, by alternating large and small stars.

Each round replaces every edge by one that points to a smaller node, so the edges never grow in number, and stops
when each component is a star around its smallest node. The minimum of a node's neighbours is an aggregate and comes
back by a join, so a node with very many edges is never gathered in one task: the aggregate combines before the
shuffle and adaptive execution may split the join. Every round is stored, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_stored, stored


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` of integer nodes to ``(node, root)`` for each node but the roots.

    ``root`` is the smallest node of the component. Loops, repeated edges and either direction are allowed; a null
    end makes no edge. No edges give no rows.
    """
    now = stored(_canonical(edges.select("a", "b")), "edges")
    mark = _mark(now)
    while mark[0]:
        after = stored(_small_star(_large_star(now)), "edges")
        mark, before = _mark(after), mark
        drop_stored(now)
        now = after
        if mark == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _canonical(edges: DataFrame) -> DataFrame:
    return edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each node's larger neighbours to the smallest of it and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(_dealt_anew("a"), F.least("a", "m").alias("m"))
    return _canonical(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m")).select(_dealt_anew("a"), "m")
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _canonical(moved.union(least.select("a", F.col("m").alias("b"))))


def _dealt_anew(node: str) -> Column:
    """The node as an expression of its own: the join then has an exchange on either side, which may be split where a
    node has very many edges, and not only the aggregate's."""
    return F.col(node).bitwiseXOR(F.lit(0)).alias(node)


def _mark(edges: DataFrame) -> tuple:
    """The count and two checksums, which change when any edge does."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", F.lit(1)))).first())
