"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skeindex.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node of ``links(a, b)``: root is the smallest node it can reach.

    Each step links a node's neighbours to the smallest of them; the table never grows beyond twice the links, and is
    written to the shared folder after every round. Links of a node to itself and repeated links are allowed; links
    with a null end are left out.
    """
    edges = links.where("a is not null and b is not null and a <> b")
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        sign = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if sign["n"] == 0 or sign == before:
            break
        before = sign
        edges = staged(_small_star(_large_star(edges)), "links")
    root = edges.groupBy("a").agg(F.min("b").alias("root"))
    return root.withColumnRenamed("a", "node").unionByName(root.select(F.col("root").alias("node"), "root").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return moved.where("a <> b").distinct()
