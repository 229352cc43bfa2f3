"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import salted_lookup, work_table

#: Tasks over which the links of one node are dealt.
SALTS = 16


def _smallest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the node's smallest neighbour."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    low = _smallest(both).withColumn("m", F.least("u", "m"))
    met = salted_lookup(both, low, "u", SALTS, F.xxhash64("v")).where("v > u")
    return met.select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them (a > b in every edge)."""
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    low = _smallest(pairs)
    met = salted_lookup(pairs, low, "u", SALTS, F.xxhash64("v"))
    own = low.select(F.col("u").alias("a"), F.col("m").alias("b"))
    rest = met.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return own.unionByName(rest).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node that links reach.

    Each round writes its edges to the shared folder; the rounds end when an edge set maps to
    itself, after a number of them that grows with the logarithm of the longest chain. A link of a
    node to itself or to null says nothing and is left out; without links there are no rows.
    """
    edges = work_table(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    mark = None
    while True:
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
        edges = work_table(_small_star(_large_star(edges)))
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
