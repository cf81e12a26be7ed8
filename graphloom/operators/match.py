"""Pattern matching as joins: scans, hops and chains. Bag semantics: parallel relationships match each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.hubs import hub_join, known_hubs
from graphloom.sources.graph import Graph, internal_ids


def scan(graph: Graph, label: str, **properties) -> DataFrame:
    """Nodes of a label whose properties equal the given values."""
    out = graph.node(label)
    for k, v in properties.items():
        out = out.where(F.col(k) == F.lit(v))
    return out


def all_nodes(graph: Graph) -> DataFrame:
    """Nodes of all labels with a column label; properties that a label lacks are null."""
    out = None
    for n in graph.nodes.values():
        own = n.df.withColumn("label", F.lit(n.label))
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return out


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*(F.col(c).alias(f"{prefix}_{c}") for c in df.columns))


def hop(graph: Graph, rel: str, src: DataFrame | None = None, dst: DataFrame | None = None, names: tuple[str, str, str] = ("a", "r", "b")) -> DataFrame:
    """(a)-[r]->(b) along a relationship type: every column of the three, prefixed by its variable.

    src and dst are the nodes allowed at either end, already filtered, so a pinned end is filtered before the join.
    """
    r = graph.rels[rel]
    ends = []
    for df, label, name in ((src, r.src_label, names[0]), (dst, r.dst_label, names[2])):
        ends.append((_prefixed(graph.node(label) if df is None else df, name), f"{name}_{graph.nodes[label].pk}"))
    (a, a_key), (b, b_key) = ends
    edges = _prefixed(r.df, names[1])
    return edges.join(a, F.col(f"{names[1]}_src") == F.col(a_key)).join(b, F.col(f"{names[1]}_dst") == F.col(b_key))


def chain(graph: Graph, start: str, rels: list[str], hub_rows: int | None = None) -> DataFrame:
    """Nodes of start followed along relationship types: columns n0_… to nk_… of the nodes passed.

    With hub_rows, nodes that more relationships of a type leave or enter are hubs: what passes them is dealt over tasks,
    by counts of each type's ends. The keys of a label and the ends that name them are then of one type.
    """
    out = _prefixed(graph.node(start), "n0")
    at = f"n0_{graph.nodes[start].pk}"
    entered = None
    for k, rel in enumerate(rels, 1):
        r = graph.rels[rel]
        edges = r.df.select(F.col("src").alias(f"_src{k}"), F.col("dst").alias(f"_dst{k}"))
        nodes, key = _prefixed(graph.node(r.dst_label), f"n{k}"), f"n{k}_{graph.nodes[r.dst_label].pk}"
        left = known_hubs(edges, f"_src{k}", hub_rows) if hub_rows else None
        out = hub_join(out, edges, at, f"_src{k}", entered, left)
        entered = known_hubs(edges, f"_dst{k}", hub_rows) if hub_rows else None
        out = hub_join(out, nodes, f"_dst{k}", key, entered).drop(f"_src{k}", f"_dst{k}")
        at = key
    return out


def pinned_pair(graph: Graph, label: str, first: dict, second: dict) -> DataFrame:
    """(a {…}), (b {…}): both nodes pinned by key, so the product has one row."""
    pk = graph.nodes[label].pk
    if pk not in first or pk not in second:
        raise ValueError(f"both nodes must be pinned by {pk}")
    return _prefixed(scan(graph, label, **first), "a").crossJoin(_prefixed(scan(graph, label, **second), "b"))


def derive_edges(nodes: DataFrame, key: str, reference: str) -> DataFrame:
    """(src, dst) for each node whose reference names another node's key; one join for the whole table."""
    targets = nodes.select(F.col(key).alias("dst"))
    return nodes.select(F.col(key).alias("src"), F.col(reference).alias("_to")).join(targets, F.col("_to") == F.col("dst")).select("src", "dst")


def incoming_counts(graph: Graph, rel: str) -> DataFrame:
    """(node, n): relationships that end at each node of the type's target label, 0 included."""
    r = graph.rels[rel]
    counts = r.df.groupBy(F.col("dst").alias("_dst")).agg(F.count("*").alias("_n"))
    nodes = graph.node(r.dst_label).select(F.col(graph.nodes[r.dst_label].pk).alias("node"))
    return nodes.join(counts, F.col("node") == F.col("_dst"), "left").select("node", F.coalesce("_n", F.lit(0)).alias("n"))


def _id() -> Column:
    return F.struct("table_id", "offset")


def node_values(graph: Graph, label: str, *properties: str) -> DataFrame:
    """(key, node) of each node: node is struct(id, label, properties), id being its internal one (table_id, offset)."""
    n = graph.nodes[label]
    numbered = internal_ids(n.df.select(*dict.fromkeys([n.pk, *properties])), n.pk, graph.table_id(label))
    return numbered.select(F.col(n.pk).alias("key"), F.struct(_id().alias("id"), F.lit(label).alias("label"), F.struct(*properties).alias("properties")).alias("node"))


def rel_values(graph: Graph, rel: str, order: list[str], *properties: str) -> DataFrame:
    """(src, dst, rel) of each relationship: rel is struct(id, src, dst, label, properties), its own internal id and
    those of its ends. order names the columns by which relationships are numbered; they must tell them apart."""
    r = graph.rels[rel]
    numbered = internal_ids(r.df.select(*dict.fromkeys(["src", "dst", *order, *properties])), order, graph.table_id(rel))
    ends = [node_values(graph, label).select(F.col("key").alias(f"_{end}"), F.col("node.id").alias(f"_{end}_id")) for end, label in (("src", r.src_label), ("dst", r.dst_label))]
    joined = numbered.join(ends[0], F.col("src") == F.col("_src")).join(ends[1], F.col("dst") == F.col("_dst"))
    own = F.struct(*(properties or [F.lit(None).alias("none")]))
    return joined.select("src", "dst", F.struct(_id().alias("id"), F.col("_src_id").alias("src"), F.col("_dst_id").alias("dst"), F.lit(rel).alias("label"), own.alias("properties")).alias("rel"))


def with_unique_names(df: DataFrame) -> DataFrame:
    """Columns that repeat a name get a number behind it; the leftmost keeps it."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        seen[c] = seen.get(c, 0) + 1
        names.append(c if seen[c] == 1 else f"{c}_{seen[c]}")
    return df.toDF(*names)
