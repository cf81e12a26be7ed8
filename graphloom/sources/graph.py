"""Node and relationship tables with declared keys, and the graph that holds them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .checkpoints import cut


@dataclass(frozen=True)
class NodeTable:
    """A label: one DataFrame whose column `pk` is the primary key."""

    label: str
    df: DataFrame
    pk: str


@dataclass(frozen=True)
class RelTable:
    """A relationship type: one DataFrame with the end nodes' keys in `src` and `dst`, and properties."""

    label: str
    df: DataFrame
    src_label: str
    dst_label: str


class KeyViolation(ValueError):
    """A primary key is null or not unique, or an end node is missing."""


@dataclass
class Graph:
    spark: SparkSession
    nodes: dict[str, NodeTable] = field(default_factory=dict)
    rels: dict[str, RelTable] = field(default_factory=dict)

    def add_nodes(self, label: str, df: DataFrame, pk: str) -> Graph:
        if label in self.nodes or label in self.rels:
            raise ValueError(f"{label} is declared already")
        self.nodes[label] = NodeTable(label, df, pk)
        return self

    def add_rels(self, label: str, df: DataFrame, src_label: str, dst_label: str) -> Graph:
        if label in self.nodes or label in self.rels:
            raise ValueError(f"{label} is declared already")
        for end in (src_label, dst_label):
            if end not in self.nodes:
                raise ValueError(f"no node table {end}")
        self.rels[label] = RelTable(label, df, src_label, dst_label)
        return self

    def node(self, label: str) -> DataFrame:
        return self.nodes[label].df

    def rel(self, label: str) -> DataFrame:
        return self.rels[label].df

    def tables(self) -> DataFrame:
        """(name, kind, src_label, dst_label, pk) of every table."""
        rows = [(n.label, "NODE", None, None, n.pk) for n in self.nodes.values()] + [(r.label, "REL", r.src_label, r.dst_label, None) for r in self.rels.values()]
        return self.spark.createDataFrame(rows, "name string, kind string, src_label string, dst_label string, pk string")

    def row_counts(self) -> DataFrame:
        """(name, rows) of every table."""
        out = None
        for t in [*self.nodes.values(), *self.rels.values()]:
            own = t.df.agg(F.count("*").alias("rows")).select(F.lit(t.label).alias("name"), "rows")
            out = own if out is None else out.unionByName(own)
        return out

    def table_id(self, label: str) -> int:
        """The table's number in internal ids: node tables in the order of their declaration, then relationships."""
        return [*self.nodes, *self.rels].index(label)

    def key_violations(self) -> DataFrame:
        """(table_name, violations): rows of each label whose key is null or taken by another row."""
        out = None
        for n in self.nodes.values():
            bad = n.df.groupBy(F.col(n.pk).alias("k")).count().where("k is null or count > 1")
            own = bad.agg(F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("count")).otherwise(F.col("count") - 1)), F.lit(0)).cast("long").alias("violations")).select(F.lit(n.label).alias("table_name"), "violations")
            out = own if out is None else out.unionByName(own)
        return out

    def dangling_ends(self) -> DataFrame:
        """(rel, missing_src, missing_dst): relationships whose end node doesn't exist."""
        out = None
        for r in self.rels.values():
            missing = []
            for end, label in (("src", r.src_label), ("dst", r.dst_label)):
                keys = self.nodes[label].df.select(F.col(self.nodes[label].pk).alias("_pk"))
                missing.append(r.df.select(end).join(keys, F.col(end) == F.col("_pk"), "left_anti").agg(F.count("*").alias(f"missing_{end}")))
            own = missing[0].crossJoin(missing[1]).select(F.lit(r.label).alias("rel"), "missing_src", "missing_dst")  # one row each
            out = own if out is None else out.unionByName(own)
        return out

    def check(self) -> None:
        bad = [r["table_name"] for r in self.key_violations().where("violations > 0").collect()] if self.nodes else []
        bad += [r["rel"] for r in self.dangling_ends().where("missing_src > 0 or missing_dst > 0").collect()] if self.rels else []
        if bad:
            raise KeyViolation(f"keys or ends are violated in {', '.join(bad)}")


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = False) -> DataFrame:
    """A CSV bulk load with a declared schema; a row that doesn't fit it is an error."""
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """One row for each entry of `results` in a nested JSON document, its fields as columns."""
    return spark.read.option("multiLine", True).json(path).select(F.explode("results").alias("r")).select("r.*")


def write_results(df: DataFrame, path: str) -> None:
    """Writes measurements, in folders by model and size, as each model ends. A model that runs again replaces what it
    measured before at the same sizes; other folders stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model", "size").parquet(path)


def row_stream(df: DataFrame):
    """Rows one by one, a partition at a time on the driver."""
    return df.toLocalIterator()


def setting(spark: SparkSession, name: str) -> str | None:
    """The session's value of a setting; null if it has none."""
    return spark.conf.get(name, None)


def internal_ids(df: DataFrame, key: str | list[str], table_id: int) -> DataFrame:
    """df with columns table_id and offset, offsets dense in the order of the key columns, of any type.

    Rows are dealt by ranges of the key and kept; a row's offset is its place in its range after the rows of the
    ranges before. No task sees all rows; the ranges' counts are as few as partitions. Keys must be unique, not null.
    """
    keys = [key] if isinstance(key, str) else key
    ranged = cut(df.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy(F.col("_range").alias("_r")).agg(F.count("*").alias("_n"))
    ahead = counts.withColumn("_ahead", F.coalesce(F.sum("_n").over(Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_r", "_ahead")
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*keys)) - 1
    joined = ranged.withColumn("_place", place).join(F.broadcast(ahead), F.col("_range") == F.col("_r"))
    return joined.select(*df.columns, F.lit(table_id).alias("table_id"), (F.col("_ahead") + F.col("_place")).alias("offset"))


#: Declared schemas of the driver's tables: opening them reads no footer.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def driver_graph(spark: SparkSession, sf_dir: str) -> Graph:
    """The graph over the driver's tables: foreign keys as relationships, a tree of parts, two contacts a customer."""
    t = {k: spark.read.schema(v).parquet(f"{sf_dir}/{k}.parquet") for k, v in SCHEMAS.items()}
    g = Graph(spark)
    for label, name, pk in (("Region", "region", "r_regionkey"), ("Nation", "nation", "n_nationkey"), ("Customer", "customer", "c_custkey"), ("Supplier", "supplier", "s_suppkey"), ("Part", "part", "p_partkey"), ("Orders", "orders", "o_orderkey")):
        g.add_nodes(label, t[name], pk)
    g.add_nodes("User", t["events"].select("user_id").distinct(), "user_id")

    def edge(name: str, src: str, dst: str, *props: str) -> DataFrame:
        return t[name].select(F.col(src).alias("src"), F.col(dst).alias("dst"), *props)

    g.add_rels("InRegion", edge("nation", "n_nationkey", "n_regionkey"), "Nation", "Region")
    g.add_rels("InNation", edge("customer", "c_custkey", "c_nationkey"), "Customer", "Nation")
    g.add_rels("SuppIn", edge("supplier", "s_suppkey", "s_nationkey"), "Supplier", "Nation")
    g.add_rels("Placed", edge("orders", "o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus"), "Customer", "Orders")
    g.add_rels("Contains", edge("lineitem", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate"), "Orders", "Part")
    g.add_rels("Located", t["part"].where("p_partkey > 0").select(F.col("p_partkey").alias("src"), F.expr("p_partkey div 10").alias("dst")), "Part", "Part")
    total = F.broadcast(t["customer"].agg(F.count("*").alias("n")))  # one row
    knows = t["customer"].select(F.col("c_custkey").alias("src"), F.explode(F.array(F.lit(1), F.lit(2))).alias("j")).crossJoin(total)
    g.add_rels("Knows", knows.select("src", ((F.col("src") * 7 * F.col("j") + 3) % F.col("n")).alias("dst"), F.col("j").alias("since")), "Customer", "Customer")
    return g
