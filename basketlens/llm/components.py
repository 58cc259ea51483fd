"""Connected components by alternating large-star and small-star steps.

Every step is an aggregation with map-side combine (smallest neighbour per node)
and a join back to the links, so a node with millions of links is never gathered in
one task: the aggregation pre-combines it, and as its result is written before the join
Spark can split the join's hot partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketlens.staging import discard, stage_path


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (u, v); component is the smallest node.

    Links with a null end or from a node to itself join nothing and are left out, so
    a node that has only such links does not appear. Repeated links count once. An
    empty table gives an empty result. The number of rounds grows with the logarithm
    of the longest chain, each round is written to the shared folder.
    """
    spark = links.sparkSession
    u, v = F.col("u"), F.col("v")
    start = links.where("u <> v").select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    edges, path = stage_path(start, "links")
    state = None
    while True:
        totals = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(totals) == state or totals[0] == 0:
            break
        state = tuple(totals)
        both = edges.select("u", "v").union(edges.select(v.alias("u"), u.alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        lowest, lowest_path = stage_path(lowest, "lowest")
        large = both.where("v > u").join(lowest, "u").select(v.alias("u"), F.col("m").alias("v")).distinct()
        large, large_path = stage_path(large, "links")
        least, least_path = stage_path(large.groupBy("u").agg(F.min("v").alias("m")), "lowest")
        small = (
            large.join(least, "u")
            .where("v <> m")
            .select(v.alias("u"), F.col("m").alias("v"))
            .union(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        following, following_path = stage_path(small, "links")
        discard(spark, path, large_path, lowest_path, least_path)
        edges, path = following, following_path
    roots = edges.select(v.alias("node"), v.alias("component")).distinct()
    return edges.select(u.alias("node"), v.alias("component")).union(roots)
