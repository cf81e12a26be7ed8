"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation on edges (u, v). Each node needs its least neighbour only: an aggregate with map-side
    combine, joined back to the edges, so no neighbourhood is ever gathered in one place."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = both.join(least, F.col("u") == F.col("w"))
    if large:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", node: str = "node", label: str = "component") -> DataFrame:
    """(node, component) of all nodes that links name; component is the least node reachable.

    Links may repeat, run either way and join a node to itself; rows with a null end count for nothing. An empty
    table gives an empty one. Rounds end when the edges repeat, which is after O(log^2 n) of them.
    """
    links = links.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    sums = (F.count("*"), F.bit_xor(F.xxhash64("u", "v")))
    seen = edges.agg(*sums).first()
    for _ in range(MAX_ROUNDS):
        if not seen[0]:
            break
        edges = stored(_star(_star(edges, True), False), "edges")
        now = edges.agg(*sums).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components didn't settle")
    roots = edges.select(F.col("v").alias(node)).distinct()
    return edges.select(F.col("u").alias(node), F.col("v").alias(label)).unionByName(roots.withColumn(label, F.col(node)))
