"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orelode.llm.common import discard, staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of the edges ``a, b``; the smallest node names each.

    Alternating stars: every node hands its larger neighbours to its smallest one, then its
    smaller ones, until each component is a star around its smallest node. The number of
    rounds grows with the logarithm of the nodes. Each round takes minima by node, which are
    reduced before the shuffle, and joins them back, where a node with many neighbours may be
    split; nothing is gathered by node. Rounds, and the result, are written to the shared folder.
    """
    links = (
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    links = staged(links, "links")
    before = digest(links)
    while before[0]:
        after = staged(small_star(large_star(links)), "links")
        found = digest(after)
        discard(links)
        links = after
        if found == before:
            break
        before = found
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    found = links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
    found = staged(found, "components")
    discard(links)
    return found


def digest(links: DataFrame) -> tuple:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return tuple(links.agg(F.count("*"), total).first())


def large_star(links: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest of the node and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return (
        both.filter(F.col("v") > F.col("u"))
        .join(least, F.col("u") == F.col("w"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )


def small_star(links: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of these."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    handed = (
        links.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w"))
        .filter(F.col("v") != F.col("m"))
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
    )
    return handed.unionByName(least.withColumnRenamed("m", "v")).distinct()
