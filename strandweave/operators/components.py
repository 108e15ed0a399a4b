"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandweave.session import Cut


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Rows ``(node, component)``: the least node reachable from every node that has an edge.

    Nodes without an edge are not listed; self-loops and null ends are ignored. Each round links every node's larger
    neighbours to its least neighbour and then flattens the resulting stars, so long chains end in a logarithmic number
    of rounds; it goes on until nothing changes. A hub is never gathered: minima are pre-aggregated and joined back to the edges, and a skewed join side
    can be split at run time. Every round is written to the shared folder, the round before is deleted.
    """
    start = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
    now = Cut(start.where("u <> v").distinct(), "components")
    seen = _fingerprint(now.df)
    while seen[0]:
        both = now.df.unionByName(now.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _least_neighbour(both).select("u", F.least("m", "u").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large_cut = Cut(large, "components")
        low = _least_neighbour(large_cut.df)
        small = large_cut.df.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = Cut(small.unionByName(low.withColumnRenamed("m", "v")).distinct(), "components")
        large_cut.drop()
        now.drop()
        now, before = after, seen
        seen = _fingerprint(now.df)
        if seen == before:
            break
    roots = now.df.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.df.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
