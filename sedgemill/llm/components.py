"""Connected components of a link table, by rounds of joins that never gather a component in one place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sedgemill.session import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def star_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v) that is not its class's smallest node.

    Alternates two steps until nothing changes: link each node's larger neighbours to its
    smallest neighbour, then link its smaller neighbours and itself to the smallest. The
    number of rounds grows with the logarithm of the longest chain, and every round is
    written, so a lost executor costs one round. Self-links are ignored.
    """
    edges = links.where(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = written(edges, "star")
    before = _state(edges)
    for _ in range(most_rounds):
        if not before[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(
            F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "star")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components not settled after {most_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
