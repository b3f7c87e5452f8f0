"""Connected components by alternating large and small stars, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import drop_table, join_split, release, write_table


def _stars(edges: DataFrame, small: bool, name: str) -> DataFrame:
    """Each node's neighbours go to the smallest of them and itself: the larger ones, or for a small star the smaller. A
    node that holds a large part of all edges, as the centre of a large component does, is no one task's work."""
    both = edges if small else edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("rows")).select("u", F.least("u", "m").alias("m"), "rows")
    least = write_table(least, name + "-least")
    joined = join_split(both, least, "u")
    if small:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    else:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    out = write_table(out.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), name)
    drop_table(least)
    return out


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` for every node of ``links`` (u, v): the smallest node reachable. Each round is written
    to the shared folder; the number of rounds grows with the logarithm of the longest chain."""
    edges = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = write_table(edges, name)
    mark = None
    while True:
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if now == mark or not now["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now
        large = _stars(edges, False, name)
        drop_table(edges)
        edges = _stars(large, True, name)
        drop_table(large)
        release(edges.sparkSession)
