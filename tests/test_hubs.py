"""Joins at hubs against plain joins, and how they deal out the rows of a star."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphloom.operators import hubs as H
from graphloom.operators import match as M
from graphloom.operators import paths as G
from graphloom.sources.graph import Graph


@pytest.mark.parametrize("sides", [(True, True), (True, False), (False, True), (False, False)])
def test_hub_join_is_the_join(spark, sides):
    rnd = random.Random(2)
    pick = lambda: rnd.choice([0] * 12 + [None, *range(1, 9)])
    a, b = ([(pick(), k // 2) for k in range(n)] for n in (200, 150))  # repeated rows too
    left, right = spark.createDataFrame(a, "x long, p int"), spark.createDataFrame(b, "y long, q int")
    got = H.hub_join(left, right, "x", "y", *(H.known_hubs(df, c, 20) if on else None for df, c, on in ((left, "x", sides[0]), (right, "y", sides[1]))))
    assert Counter(map(tuple, got.collect())) == Counter((x, p, y, q) for x, p in a for y, q in b if x is not None and x == y)


def test_keys_of_two_types_are_refused(spark):
    left, right = spark.createDataFrame([(0, 1)] * 5, "x long, p int"), spark.createDataFrame([(0, 1)] * 5, "y int, q int")
    with pytest.raises(ValueError):
        H.hub_join(left, right, "x", "y", H.known_hubs(left, "x", 2))
    assert H.hub_join(left, right, "x", "y").count() == 25
    assert H.known_hubs(left, "x", 5) is None
    assert H.known_hubs(left.limit(0), "x", 5) is None


def test_walks_and_chains_through_hubs(spark):
    rnd = random.Random(8)
    edges = [(rnd.choice([0, 0, rnd.randrange(9)]), rnd.choice([0, 0, rnd.randrange(9)])) for _ in range(60)] + [(None, 0), (0, None)]
    df = spark.createDataFrame(edges, "src long, dst long")
    rows = lambda d: sorted(map(tuple, d.collect()), key=repr)
    plain = G.var_paths(df.withColumn("r", F.monotonically_increasing_id()), 1, 3, rel_id="r").groupBy("src", "dst", "hops").agg(F.count("*").alias("walks"))
    assert rows(G.walk_counts(df, 3, hub_rows=2)) == rows(plain) == rows(G.walk_counts(df, 3))
    g = Graph(spark).add_nodes("N", spark.createDataFrame([(k, f"n{k}", {"a": k}) for k in range(9)], "id long, name string, more map<string, int>"), "id")
    g.add_rels("R", df.where("src is not null and dst is not null"), "N", "N")
    names = [f"n{k}_name" for k in range(4)]
    assert rows(M.chain(g, "N", ["R"] * 3, hub_rows=3).select(names)) == rows(M.chain(g, "N", ["R"] * 3).select(names))


def test_a_star_is_dealt_evenly(spark):
    """A million relationships that leave one node, and a few that enter it: no task has three times the median's rows."""
    n, tasks = 1_000_000, 8
    star = spark.range(1, n + 1).select(F.lit(0).cast("long").alias("s"), F.col("id").alias("d"))
    into = spark.createDataFrame([(-k, 0) for k in range(1, 4)], "src long, dst long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    try:
        met = H.hub_join(into, star, "dst", "s", H.known_hubs(into, "dst"), H.known_hubs(star, "s"))
        rows = sorted(r["n"] for r in met.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect())
    finally:
        for k in ("adaptive.enabled", "autoBroadcastJoinThreshold"):
            spark.conf.unset(f"spark.sql.{k}")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(rows) == 3 * n and len(rows) == tasks and rows[-1] <= 3 * rows[tasks // 2]
