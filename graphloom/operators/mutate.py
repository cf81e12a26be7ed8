"""Changes of a graph as new DataFrames: inserts, updates, deletes, last writes, and all-or-nothing publication."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.sources.graph import Graph, KeyViolation


def insert_nodes(table: DataFrame, staged: DataFrame, pk: str) -> DataFrame:
    """table with the staged rows; a staged key that is null, repeated or taken is an error before any result."""
    keys = staged.groupBy(F.col(pk).alias("_k")).count()
    taken = keys.join(table.select(F.col(pk).alias("_t")), F.col("_k") == F.col("_t"), "left_semi").select("_k")
    if not taken.unionByName(keys.where("_k is null or count > 1").select("_k")).isEmpty():
        raise KeyViolation(f"staged keys of {pk} are null, repeated or taken")
    return table.unionByName(staged, allowMissingColumns=True)


def insert_edges(rels: DataFrame, staged: DataFrame, src_nodes: DataFrame, src_pk: str, dst_nodes: DataFrame, dst_pk: str) -> DataFrame:
    """rels with those staged edges whose end nodes both exist, as a pattern of two pinned nodes would create them."""
    src, dst = src_nodes.select(F.col(src_pk).alias("_s")), dst_nodes.select(F.col(dst_pk).alias("_d"))
    good = staged.join(src, F.col("src") == F.col("_s"), "left_semi").join(dst, F.col("dst") == F.col("_d"), "left_semi")
    return rels.unionByName(good, allowMissingColumns=True)


def update_scalar(table: DataFrame, pk: str, column: str, updates: DataFrame) -> DataFrame:
    """table with column set from updates(pk, column) where they have the key, to null if they say so."""
    new = updates.select(F.col(pk).alias("_k"), F.col(column).alias("_v"), F.lit(True).alias("_hit"))
    joined = table.join(new, F.col(pk) == F.col("_k"), "left")
    return joined.select(*(F.when(F.col("_hit"), F.col("_v")).otherwise(F.col(c)).alias(c) if c == column else F.col(c) for c in table.columns))


def update_map_key(table: DataFrame, pk: str, column: str, key: str, updates: DataFrame) -> DataFrame:
    """table with one entry of a map column set from updates(pk, value); a key that the map lacks is added last."""
    new = updates.select(F.col(pk).alias("_k"), F.col("value").alias("_v"), F.lit(True).alias("_hit"))
    joined = table.join(new, F.col(pk) == F.col("_k"), "left")
    m = F.col(column)
    changed = F.transform_values(m, lambda k, v: F.when(k == key, F.col("_v")).otherwise(v))
    added = F.map_concat(m, F.create_map(F.lit(key), F.col("_v")))
    value = F.when(F.col("_hit"), F.when(F.map_contains_key(m, key), changed).otherwise(added)).otherwise(m)
    return joined.select(*(value.alias(c) if c == column else F.col(c) for c in table.columns))


def delete_nodes(table: DataFrame, pk: str, doomed: DataFrame) -> DataFrame:
    keys = doomed.select(F.col(doomed.columns[0]).alias("_k"))
    return table.join(keys, F.col(pk) == F.col("_k"), "left_anti")


def drop_incident(rels: DataFrame, doomed: DataFrame, end: str) -> DataFrame:
    """Relationships without those whose node at an end ("src" or "dst") goes."""
    return rels.join(doomed.select(F.col(doomed.columns[0]).alias("_k")), F.col(end) == F.col("_k"), "left_anti")


def latest(log: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """The last write for each key: one aggregate with map-side combine, however long a key's log is."""
    best = F.max_by(F.struct(value, *order), F.struct(*order))
    return log.groupBy(*keys).agg(best.alias("_last")).select(*keys, *(F.col("_last").getField(c).alias(c) for c in (value, *order)))


@dataclass
class Changes:
    """Staged rows by table: nodes to insert, edges to insert, node keys to delete."""

    nodes: dict[str, DataFrame] = field(default_factory=dict)
    rels: dict[str, DataFrame] = field(default_factory=dict)
    deletes: dict[str, DataFrame] = field(default_factory=dict)


def violated(old: Graph, new: Graph, changes: Changes) -> list[str]:
    """Tables in which the staged rows break a key or an end, given that the old graph has none broken: staged keys that
    are null, repeated or taken by a row that stays, and staged edges without an end in the new graph. Edges of deleted
    nodes go with them, so no table but those that changes name, and the ends of staged edges, is read."""
    bad = []
    for label, staged in changes.nodes.items():
        pk = old.nodes[label].pk
        keys = staged.groupBy(F.col(pk).alias("_k")).count()
        stays = delete_nodes(old.node(label), pk, changes.deletes[label]) if label in changes.deletes else old.node(label)
        taken = keys.join(stays.select(F.col(pk).alias("_t")), F.col("_k") == F.col("_t"), "left_semi")
        if not keys.where("_k is null or count > 1").select("_k").unionByName(taken.select("_k")).isEmpty():
            bad.append(label)
    for label, staged in changes.rels.items():
        r = new.rels[label]
        ends = [staged.select(F.col(end).alias("_k")).join(new.node(at).select(F.col(new.nodes[at].pk).alias("_t")), F.col("_k") == F.col("_t"), "left_anti") for end, at in (("src", r.src_label), ("dst", r.dst_label))]
        if not all(x.isEmpty() for x in ends):
            bad.append(label)
    return bad


def apply_changes(graph: Graph, changes: Changes, whole: bool = False) -> Graph:
    """A new graph with all changes, or an error and the old graph as it was. What the changes touch is checked; with
    whole, the keys and ends of all tables, for a graph that wasn't checked before."""
    unknown = [*changes.nodes, *changes.rels, *changes.deletes]
    if missing := [k for k in unknown if k not in graph.nodes and k not in graph.rels]:
        raise KeyViolation(f"no table {', '.join(missing)}")
    new = Graph(graph.spark)
    for n in graph.nodes.values():
        df = n.df
        if n.label in changes.deletes:
            df = delete_nodes(df, n.pk, changes.deletes[n.label])
        if n.label in changes.nodes:
            df = df.unionByName(changes.nodes[n.label], allowMissingColumns=True)
        new.add_nodes(n.label, df, n.pk)
    for r in graph.rels.values():
        df = r.df
        for end, label in (("src", r.src_label), ("dst", r.dst_label)):
            if label in changes.deletes:
                df = drop_incident(df, changes.deletes[label], end)
        if r.label in changes.rels:
            df = df.unionByName(changes.rels[r.label], allowMissingColumns=True)
        new.add_rels(r.label, df, r.src_label, r.dst_label)
    if whole:
        new.check()
    elif bad := violated(graph, new, changes):
        raise KeyViolation(f"keys or ends are violated in {', '.join(bad)}")
    return new
