"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.shared import staged


def _least(pairs: DataFrame, at: str) -> DataFrame:
    return pairs.groupBy(at).agg(F.min("other").alias("least"))


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node reachable from each node of the links (columns a and b).

    Alternating large-star and small-star steps; each round's links are written to the shared folder. Rounds grow with
    the logarithm of the longest path. The least neighbour is a grouped minimum, so a node with very many links is
    combined before the shuffle, and joins that carry it back may be split by adaptive execution.
    """
    edges = staged(
        links.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other")).filter("node <> other").distinct(),
        "links",
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
        least = _least(both, "node").select("node", F.least("node", "least").alias("least"))
        large = (
            both.filter("other > node").join(least, "node")
            .select(F.col("other").alias("node"), F.col("least").alias("other")).distinct()
        )
        least = _least(large, "node")
        small = (
            large.join(least, "node").filter("other <> least")
            .select(F.col("other").alias("node"), F.col("least").alias("other"))
            .unionByName(least.select("node", F.col("least").alias("other")))
            .distinct()
        )
        edges = staged(small, "links")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select("node", F.col("other").alias("component")).unionByName(
        edges.select(F.col("other").alias("node"), F.col("other").alias("component")).distinct()
    )
