"""Paths: bounded variable-length patterns, walk counts, reachability and depth."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators.hubs import HUB_ROWS, hub_join, known_hubs
from graphloom.sources.checkpoints import cut


def arriving(edges: DataFrame, ends: DataFrame, max_hops: int) -> list[DataFrame]:
    """For each number of hops from 0 to max_hops, the nodes (_node) from which that many lead to one of ends."""
    e = edges.select(F.col("src").alias("_s"), F.col("dst").alias("_d")).distinct()
    out = [cut(ends.select(F.col(ends.columns[0]).alias("_node")).distinct())]
    for _ in range(max_hops):
        out.append(cut(e.join(out[-1], F.col("_d") == F.col("_node"), "left_semi").select(F.col("_s").alias("_node")).distinct()))
    return out


def steps(edges: DataFrame, min_hops: int, max_hops: int, mode: str = "walk", rel_id: str | None = None, starts: DataFrame | None = None, ends: DataFrame | None = None) -> list[DataFrame]:
    """Paths (src, dst, nodes, rels) of 1, 2, ... max_hops relationships, each step from the one before. With ends, a
    step keeps only paths from whose last node enough further hops lead to an end, or that are there."""
    e = edges.select(F.col("src").alias("_s"), F.col("dst").alias("_d"), (F.col(rel_id) if rel_id else F.struct(*edges.columns)).alias("_r"))
    first = e if starts is None else e.join(starts.select(F.col(starts.columns[0]).alias("_start")), F.col("_s") == F.col("_start"), "left_semi")
    if mode == "acyclic":
        first = first.where("_s <> _d")
    by_hops = arriving(edges, ends, max_hops - 1) if ends is not None else None

    def on_the_way(paths: DataFrame, hops: int) -> DataFrame:
        if by_hops is None:
            return paths
        left = by_hops[max(0, min_hops - hops) : max_hops - hops + 1]
        good = left[0]
        for x in left[1:]:
            good = good.unionByName(x)
        return paths.join(good, F.col("dst") == F.col("_node"), "left_semi")

    out = [on_the_way(first.select(F.col("_s").alias("src"), F.col("_d").alias("dst"), F.array("_s", "_d").alias("nodes"), F.array("_r").alias("rels")), 1)]
    for hops in range(2, max_hops + 1):
        step = out[-1].join(e, F.col("dst") == F.col("_s"))
        if mode == "trail":
            step = step.where(~F.array_contains("rels", F.col("_r")))
        elif mode == "acyclic":
            step = step.where(~F.array_contains("nodes", F.col("_d")))
        out.append(on_the_way(step.select("src", F.col("_d").alias("dst"), F.concat("nodes", F.array("_d")).alias("nodes"), F.concat("rels", F.array("_r")).alias("rels")), hops))
    return out


def var_paths(edges: DataFrame, min_hops: int, max_hops: int, mode: str = "walk", rel_id: str | None = None, starts: DataFrame | None = None, ends: DataFrame | None = None) -> DataFrame:
    """(src, dst, hops, nodes, rels) of all paths of min_hops to max_hops relationships of edges(src, dst, …).

    nodes has hops + 1 keys and rels hops ids, in order; without rel_id, a relationship's id is the struct of its
    columns. mode "walk" allows repeats, "trail" no relationship twice, "acyclic" no node twice. starts and ends are
    one-column tables of the keys allowed at either end: starts filter before the first join; ends are followed back
    first, and each step keeps what can still arrive, so a hub costs what leads through it.
    """
    if not 1 <= min_hops <= max_hops:
        raise ValueError("1 <= min_hops <= max_hops is required")
    if mode not in ("walk", "trail", "acyclic"):
        raise ValueError(f"unknown mode {mode}")
    found = None
    for hops, paths in enumerate(steps(edges, min_hops, max_hops, mode, rel_id, starts, ends), 1):
        if hops >= min_hops:
            own = paths.select("src", "dst", F.lit(hops).alias("hops"), "nodes", "rels")
            found = own if found is None else found.unionByName(own)
    if ends is not None:
        found = found.join(ends.select(F.col(ends.columns[0]).alias("_end")), F.col("dst") == F.col("_end"), "left_semi")
    return found


def with_properties(paths: DataFrame, nodes: DataFrame, key: str, *properties: str) -> DataFrame:
    """paths with node_values, an array of structs of the nodes' key and properties in path order."""
    keyed = paths.withColumn("_path", F.xxhash64("nodes", "rels"))
    each = keyed.select("nodes", "rels", "_path").distinct().select("_path", "nodes", "rels", F.posexplode("nodes").alias("_place", "_node"))
    values = nodes.select(F.col(key).alias("_key"), F.struct(key, *properties).alias("_value"))
    got = each.join(values, F.col("_node") == F.col("_key")).groupBy(F.col("_path").alias("_p"), F.col("nodes").alias("_nodes"), F.col("rels").alias("_rels"))
    got = got.agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", "_value"))), lambda x: x["_value"]).alias("node_values"))
    return keyed.join(got, (F.col("_path") == F.col("_p")) & (F.col("nodes") == F.col("_nodes")) & (F.col("rels") == F.col("_rels"))).drop("_path", "_p", "_nodes", "_rels")


def path_values(paths: DataFrame, nodes: DataFrame, key: str, *properties: str) -> DataFrame:
    """paths with path, struct(nodes, rels): nodes with their properties, and relationships as var_paths has them, which
    without a rel_id is with all their columns."""
    out = with_properties(paths, nodes, key, *properties)
    return out.withColumn("path", F.struct(F.col("node_values").alias("nodes"), "rels")).drop("node_values")


def walk_counts(edges: DataFrame, max_hops: int, starts: DataFrame | None = None, hub_rows: int = HUB_ROWS) -> DataFrame:
    """(src, dst, hops, walks): how many walks join two nodes, without the walks. Rows are bounded by node pairs.

    Parallel relationships become one row with a count before any join. Nodes that more than hub_rows of these rows leave
    or enter are hubs, whose rows are dealt over tasks.
    """
    e = cut(edges.groupBy(F.col("src").alias("_s"), F.col("dst").alias("_d")).agg(F.count("*").alias("_times")))
    first = e if starts is None else e.join(starts.select(F.col(starts.columns[0]).alias("_start")), F.col("_s") == F.col("_start"), "left_semi")
    frontier = first.select(F.col("_s").alias("src"), F.col("_d").alias("dst"), F.col("_times").alias("walks"))
    left_by = known_hubs(e, "_s", hub_rows) if max_hops > 1 else None
    out = frontier.withColumn("hops", F.lit(1))
    for hops in range(2, max_hops + 1):
        step = hub_join(frontier, e, "dst", "_s", known_hubs(frontier, "dst", hub_rows), left_by)
        frontier = step.groupBy("src", F.col("_d").alias("_to")).agg(F.sum(F.col("walks") * F.col("_times")).alias("walks")).withColumnRenamed("_to", "dst")
        if hops < max_hops:
            frontier = cut(frontier)
        out = out.unionByName(frontier.withColumn("hops", F.lit(hops)))
    return out.select("src", "dst", "hops", "walks")


def reachable(edges: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """(src, dst, hops): every pair joined by a path, with the least number of hops. Ends on cyclic graphs too, after as
    many rounds as the longest of these shortest paths has hops."""
    e = edges.select(F.col("src").alias("es"), F.col("dst").alias("ed")).distinct()
    frontier = e if starts is None else e.join(starts.select(F.col(starts.columns[0]).alias("_start")), F.col("es") == F.col("_start"), "left_semi")
    frontier = cut(frontier.select(F.col("es").alias("src"), F.col("ed").alias("dst"), F.lit(1).alias("hops")))
    seen = frontier
    for hops in count(2):
        visited = seen.select(F.col("src").alias("vs"), F.col("dst").alias("vd"))
        step = frontier.join(e, F.col("dst") == F.col("es")).select("src", F.col("ed").alias("dst")).distinct()
        frontier = cut(step.join(visited, (F.col("src") == F.col("vs")) & (F.col("dst") == F.col("vd")), "left_anti").withColumn("hops", F.lit(hops)))
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)
        if hops % 8 == 0:
            seen = cut(seen)


#: Steps of a spread that one job takes.
SPREAD_STEPS = 4


def _spread(values: DataFrame, edges: DataFrame) -> DataFrame:
    """values(node, value) after each node has the least value of all nodes that reach it along edges(a, b).

    Each node also leads to itself, so a step reads the one before once, and the plan of a job grows with its steps, not
    with a power of two. Values stay dealt by node and edges by a; only what comes to a node is shuffled. The hash of a
    join is built of values, of which a node has one, so a hub makes none large."""
    all_edges = edges.where("a <> b").select("a", "b").unionByName(values.select(F.col("node").alias("a"), F.col("node").alias("b")))
    values = values.select("node", "value")
    while True:
        step = values.withColumn("was", F.col("value"))
        for _ in range(SPREAD_STEPS):
            came = all_edges.join(step.hint("shuffle_hash"), F.col("a") == F.col("node")).where("value is not null or a = b")
            step = came.groupBy(F.col("b").alias("_b")).agg(F.min("value").alias("value"), F.min(F.expr("if(a = b, was, null)")).alias("was")).withColumnRenamed("_b", "node")
        step = cut(step)
        values = step.select("node", "value")
        if step.where("not value <=> was").isEmpty():
            return values


def strong_components(edges: DataFrame) -> DataFrame:
    """(node, component, size) of all nodes that edges(src, dst) name; component is the least node that the node reaches
    and that reaches it, itself included. Rows with a null end count for nothing.

    Each round drops nodes that nothing enters or leaves, which are alone; then every node takes the least node that reaches
    it, and those that lead back to that node are its component. Edges between nodes that took different ones go, as no
    cycle crosses them. Aggregates and joins of narrow rows only; rounds grow with the longest way, not with the rows.
    """
    named = edges.where("src is not null and dst is not null").select(F.col("src").alias("a"), F.col("dst").alias("b")).distinct()
    nodes = cut(named.select(F.col("a").alias("node")).unionByName(named.select(F.col("b").alias("node"))).distinct())
    left, found = cut(named.where("a <> b")), None
    while True:
        while True:  # nodes that are entered and left
            inner = left.select(F.col("a").alias("_n")).intersect(left.select(F.col("b").alias("_n")))
            kept = cut(left.join(inner, F.col("a") == F.col("_n"), "left_semi").join(inner, F.col("b") == F.col("_n"), "left_semi"))
            same = kept.count() == left.count()
            left = kept
            if same:
                break
        if left.isEmpty():
            break
        own = left.select(F.col("a").alias("node")).distinct()
        least = _spread(own.withColumn("value", F.col("node")), left)
        x, y = (least.select(F.col("node").alias(f"_{c}"), F.col("value").alias(f"_{c}v")) for c in "ab")
        left = cut(left.join(x, F.col("a") == F.col("_a")).join(y, F.col("b") == F.col("_b")).where("_av = _bv").select("a", "b", "_av"))
        # back from the least node: only it starts with a value
        back = _spread(least.select("node", F.when(F.col("node") == F.col("value"), F.col("value")).alias("value")), left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        own = cut(back.where("value is not null").select("node", F.col("value").alias("component")))
        found = own if found is None else found.unionByName(own)
        gone = own.select(F.col("node").alias("_n"))
        left = cut(left.select("a", "b").join(gone, F.col("a") == F.col("_n"), "left_anti").join(gone, F.col("b") == F.col("_n"), "left_anti"))
    if found is None:
        return nodes.select("node", F.col("node").alias("component"), F.lit(1).cast("long").alias("size"))
    out = nodes.join(found.withColumnRenamed("node", "_n"), F.col("node") == F.col("_n"), "left").select("node", F.coalesce("component", "node").alias("component"))
    sizes = out.groupBy(F.col("component").alias("_c")).agg(F.count("*").alias("size"))
    return cut(out.join(sizes, F.col("component") == F.col("_c")).drop("_c"))


def condensed_closure(edges: DataFrame, components: DataFrame) -> DataFrame:
    """(a, b): components of which the first one's nodes reach the second one's; one that holds a cycle reaches itself.
    As many rows as component pairs, however many node pairs they stand for."""
    x, y = (components.select(F.col("node").alias(f"_{c}"), F.col("component").alias(f"_{c}c")) for c in "ab")
    named = edges.join(x, F.col("src") == F.col("_a")).join(y, F.col("dst") == F.col("_b"))
    own = named.where("_ac = _bc").select(F.col("_ac").alias("a"), F.col("_bc").alias("b")).distinct()
    across = reachable(named.where("_ac <> _bc").select(F.col("_ac").alias("src"), F.col("_bc").alias("dst")).distinct())
    return own.unionByName(across.select(F.col("src").alias("a"), F.col("dst").alias("b")))


def reach_counts(edges: DataFrame) -> DataFrame:
    """(node, component, n): how many nodes each node reaches by one relationship or more, cycles included, without their
    pairs: component sizes are added up over the condensed closure."""
    of = strong_components(edges)
    sizes = of.select(F.col("component").alias("_c"), "size").distinct()
    reached = condensed_closure(edges, of).join(sizes, F.col("b") == F.col("_c")).groupBy(F.col("a").alias("_a")).agg(F.sum("size").alias("n"))
    return of.join(reached, F.col("component") == F.col("_a"), "left").select("node", "component", F.coalesce("n", F.lit(0)).alias("n"))


def cyclic_reachable(edges: DataFrame) -> DataFrame:
    """(src, dst): the pairs of reachable, without hops, expanded from the condensed closure at the end only."""
    of = cut(strong_components(edges))
    x, y = (of.select(F.col("component").alias(f"_{c}"), F.col("node").alias(c)) for c in ("src", "dst"))
    return condensed_closure(edges, of).join(x, F.col("a") == F.col("_src")).join(y, F.col("b") == F.col("_dst")).select("src", "dst")


def depths(nodes: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    """(node, depth): hops to the root of a containment forest, 0 for nodes without an outgoing relationship.

    Each node holds how far it has come and where; a round doubles that, so a forest of depth d takes log2(d) joins
    of one row a node. A node in two containers, or a cycle, is an error.
    """
    up = edges.select(F.col("src").alias("node"), F.col("dst").alias("at")).distinct()
    now = cut(up.withColumn("depth", F.lit(1)))
    rows = now.count()
    if rows != now.select("node").distinct().count():
        raise ValueError("a node is in two containers")
    for round_ in count():
        ahead = now.select(F.col("node").alias("_n"), F.col("at").alias("_at"), F.col("depth").alias("_more"))
        joined = now.join(ahead, F.col("at") == F.col("_n"), "left")
        if not joined.where("_n is not null").count():
            break
        if 2**round_ > 2 * rows:
            raise ValueError("containment has a cycle")
        now = cut(joined.select("node", F.coalesce("_at", "at").alias("at"), (F.col("depth") + F.coalesce("_more", F.lit(0))).alias("depth")))
    far = now.select(F.col("node").alias("src"), F.col("depth").alias("_depth"))
    keys = nodes.select(F.col(key).alias("node"))
    return keys.join(far, F.col("node") == F.col("src"), "left").select("node", F.coalesce("_depth", F.lit(0)).alias("depth"))
