"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tierline.llm.common import stored


def _stars(pairs: DataFrame, upward: bool) -> DataFrame:
    """Links of every node's neighbours to the least of them and the node itself.

    ``pairs`` holds (a, b); with ``upward`` only the neighbours above ``a`` are
    relinked. The pairs are the left side of the join, so a node with very many
    neighbours can be split.
    """
    least = pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).select(F.col("a").alias("n"), "m")
    joined = pairs.join(least, F.col("a") == F.col("n"))
    if upward:
        return joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return (joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b), the least node naming its component.

    Large-star and small-star steps alternate until nothing changes, about
    log(n) rounds. Each round is a written table of at most one row per link.
    Links with a null end, and of a node to itself, count for nothing.
    """
    links = (links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
             .distinct())
    links, seen = stored(links, "links"), None
    while True:
        state = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _stars(both, upward=True).distinct()
        links = stored(_stars(large, upward=False).distinct(), "links")
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
