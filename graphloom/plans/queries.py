"""Registered queries over the driver's tables, each with its SQL twin where SQL can state it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import constructors as C
from graphloom.functions import typed as V
from graphloom.operators import equality as E
from graphloom.operators import match as M
from graphloom.operators import mutate as U
from graphloom.operators import params as B
from graphloom.operators import paths as G
from graphloom.operators import report as R
from graphloom.operators import search as N
from graphloom.operators import text_index as I
from graphloom.operators import vector_index as VI
from graphloom.sources.checkpoints import shared_dir
from graphloom.sources.graph import SCHEMAS, Graph, driver_graph, internal_ids, read_csv, read_results, write_results
from graphloom.streaming.upserts import AttributeTable, run_upserts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def on_graph(sql: str | None = None):
    """A query whose function takes the graph over the driver's tables."""

    def add(f):
        run = lambda spark, sf_dir: f(driver_graph(spark, sf_dir))
        run.__name__ = f.__name__
        return query(sql)(run)

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- sources -------------------------------------------------------------------------------------------------------

_KEYS = {"Region": ("region", "r_regionkey"), "Nation": ("nation", "n_nationkey"), "Customer": ("customer", "c_custkey"), "Supplier": ("supplier", "s_suppkey"), "Part": ("part", "p_partkey"), "Orders": ("orders", "o_orderkey"), "User": ("(select distinct user_id from events)", "user_id")}
_KNOWS = "(select c_custkey as src, (c_custkey * 7 * j + 3) % (select count(*) from customer) as dst, j as since from customer, (values (1), (2)) t(j))"
_LOCATED = "(select p_partkey as src, p_partkey // 10 as dst from part where p_partkey > 0)"
_RELS = {"InRegion": ("(select n_nationkey as src, n_regionkey as dst from nation)", "Nation", "Region"), "InNation": ("(select c_custkey as src, c_nationkey as dst from customer)", "Customer", "Nation"), "SuppIn": ("(select s_suppkey as src, s_nationkey as dst from supplier)", "Supplier", "Nation"), "Placed": ("(select o_custkey as src, o_orderkey as dst from orders)", "Customer", "Orders"), "Contains": ("(select l_orderkey as src, l_partkey as dst from lineitem)", "Orders", "Part"), "Located": (_LOCATED, "Part", "Part"), "Knows": (_KNOWS, "Customer", "Customer")}


@on_graph(" union all ".join(f"select '{k}' as table_name, (count(*) - count(distinct {c}))::bigint as violations from {t}" for k, (t, c) in _KEYS.items()))
def pk_check(g: Graph) -> DataFrame:
    return g.key_violations()


@on_graph(" union all ".join(f"select '{k}' as rel, (select count(*) from {t} where src not in (select {_KEYS[a][1]} from {_KEYS[a][0]})) as missing_src, (select count(*) from {t} where dst not in (select {_KEYS[b][1]} from {_KEYS[b][0]})) as missing_dst" for k, (t, a, b) in _RELS.items()))
def endpoint_check(g: Graph) -> DataFrame:
    return g.dangling_ends()


@on_graph(" union all ".join([f"select '{k}' as name, 'NODE' as kind, null::varchar as src_label, null::varchar as dst_label, '{c}' as pk, (select count(*) from {t}) as rows" for k, (t, c) in _KEYS.items()] + [f"select '{k}', 'REL', '{a}', '{b}', null, (select count(*) from {t})" for k, (t, a, b) in _RELS.items()]))
def show_tables(g: Graph) -> DataFrame:
    return g.tables().join(g.row_counts(), "name")


@query("select p_partkey, p_name from part union all select p_partkey + 1000000000, upper(p_name) from part")
def insert_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return U.insert_nodes(part, part.select((F.col("p_partkey") + 1_000_000_000).alias("p_partkey"), F.upper("p_name").alias("p_name")), "p_partkey")


@on_graph(f"select src, dst, since from {_KNOWS} union all select k.dst, k.src, 1990 from {_KNOWS} k join customer a on k.dst = a.c_custkey join customer b on k.src = b.c_custkey")
def insert_edges(g: Graph) -> DataFrame:
    staged = g.rel("Knows").select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(1990).alias("since"))
    return U.insert_edges(g.rel("Knows"), staged, g.node("Customer"), "c_custkey", g.node("Customer"), "c_custkey")


@query("select a.p_partkey as src, b.p_partkey as dst from part a join part b on b.p_partkey = a.p_partkey // 10 where a.p_partkey > 0")
def derive_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").where("p_partkey > 0").select("p_partkey", F.expr("p_partkey div 10").alias("loc"))
    every = table(spark, sf_dir, "part").select("p_partkey")
    return M.derive_edges(every.join(part.withColumnRenamed("p_partkey", "k"), F.col("p_partkey") == F.col("k"), "left").select("p_partkey", "loc"), "p_partkey", "loc")


@query("select c_custkey, coalesce(n.total, c_acctbal) as c_acctbal from customer left join (select o_custkey, max(o_totalprice) as total from orders group by o_custkey) n on c_custkey = o_custkey")
def update_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return U.update_scalar(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_custkey", "c_acctbal", news)


def _attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One map of attributes for each customer."""
    return table(spark, sf_dir, "customer").select("c_custkey", C.map_of(F.array(F.lit("NAME"), F.lit("SEGMENT"), F.lit("NATION")), F.array("c_name", "c_mktsegment", F.col("c_nationkey").cast("string"))).alias("attrs"))


_ATTRS = "(select c_custkey, 'NAME' as name, c_name as value from customer union all select c_custkey, 'SEGMENT', c_mktsegment from customer union all select c_custkey, 'NATION', c_nationkey::varchar from customer)"


@query("select c_custkey, 'NAME=' || c_name || ';NATION=' || c_nationkey || ';SEGMENT=' || case when c_acctbal < 0 then 'DEBT' else c_mktsegment end as attrs from customer")
def update_map_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = table(spark, sf_dir, "customer").where("c_acctbal < 0").select("c_custkey", F.lit("DEBT").alias("value"))
    changed = U.update_map_key(_attributes(spark, sf_dir), "c_custkey", "attrs", "SEGMENT", news)
    return changed.select("c_custkey", F.array_join(F.transform(F.array_sort(F.map_entries("attrs")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("attrs"))


@query("select c_custkey, c_name from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 350000)")
def delete_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = table(spark, sf_dir, "orders").where("o_totalprice > 350000").select("o_custkey").distinct()
    return U.delete_nodes(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey", gone)


@on_graph("select 'nodes' as what, (select count(*) from customer where c_acctbal >= 0)::bigint as before, (select count(*) from customer)::bigint as after union all select 'dangling', (select count(*) from orders where o_custkey in (select c_custkey from customer where c_acctbal < 0)), 0")
def all_or_nothing(g: Graph) -> DataFrame:
    """Customers in debt are missing, so their orders dangle; one change that adds them all makes the graph whole."""
    whole = g.node("Customer")
    part = Graph(g.spark).add_nodes("Customer", whole.where("c_acctbal >= 0"), "c_custkey").add_nodes("Orders", g.node("Orders"), "o_orderkey")
    part.add_rels("Placed", g.rel("Placed"), "Customer", "Orders")
    # the staged customers are checked, or there is no new graph
    new = U.apply_changes(part, U.Changes(nodes={"Customer": whole.where("c_acctbal < 0")}))
    counts = [x.node("Customer").agg(F.count("*").alias(c)) for x, c in ((part, "before"), (new, "after"))]
    ends = [x.dangling_ends().select(F.col("missing_src").alias(c)) for x, c in ((part, "before"), (new, "after"))]
    return counts[0].crossJoin(counts[1]).select(F.lit("nodes").alias("what"), "before", "after").unionByName(ends[0].crossJoin(ends[1]).select(F.lit("dangling").alias("what"), "before", "after"))  # one row each


@query("select c_custkey, c_name, c_nationkey, c_acctbal from customer")
def csv_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table written as CSV and loaded from it by a declared schema."""
    at = f"{shared_dir(spark)}/csv-{uuid.uuid4().hex}"
    table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal").write.option("header", True).csv(at)
    return read_csv(spark, at, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double", header=True)


# --- scans, predicates, projections --------------------------------------------------------------------------------


@on_graph("select n_nationkey, n_name from nation")
def label_scan(g: Graph) -> DataFrame:
    return M.scan(g, "Nation").select("n_nationkey", "n_name")


@on_graph(" union all ".join(f"select '{k}' as label, count(*) as n from {t}" for k, (t, _) in _KEYS.items()))
def all_nodes(g: Graph) -> DataFrame:
    return M.all_nodes(g).groupBy("label").agg(F.count("*").alias("n"))


@on_graph("select p_partkey, p_name, p_size from part where p_size = 10")
def inline_match(g: Graph) -> DataFrame:
    return M.scan(g, "Part", p_size=10).select("p_partkey", "p_name", "p_size")


@on_graph("select p_partkey, p_name from part where p_partkey = 7")
def point_lookup(g: Graph) -> DataFrame:
    return M.scan(g, "Part", p_partkey=7).select("p_partkey", "p_name")


@on_graph("select o_orderkey, o_orderstatus, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice > 100000")
def conj_filter(g: Graph) -> DataFrame:
    return g.node("Orders").where((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000)).select("o_orderkey", "o_orderstatus", "o_totalprice")


@on_graph("select l_orderkey as src, l_linenumber, l_partkey as dst, l_quantity from lineitem where l_orderkey = 42 and l_linenumber = 1")
def composite_lookup(g: Graph) -> DataFrame:
    return g.rel("Contains").where((F.col("src") == 42) & (F.col("l_linenumber") == 1)).select("src", "l_linenumber", "dst", "l_quantity")


@query("select p_partkey, p_name, p_retailprice from part where p_size >= 10 and p_retailprice < 1500")
def param_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.Statement(spark, "select p_partkey, p_name, p_retailprice from graphloom_part where p_size >= :least and p_retailprice < :below").bind(least=20).bind(below=1500.0, unused=1).bind(least=10).run(graphloom_part=table(spark, sf_dir, "part"))


@query("select b.name as bound_name, b.size as bound_size, p_partkey, p_name from (select distinct p_brand as name, p_size as size from part) b join part p on p.p_size = b.size and p.p_brand = b.name")
def bindings_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    bindings = part.select(F.col("p_brand").alias("name"), F.col("p_size").alias("size")).distinct()
    return B.join_bindings(part, "p_size", bindings, "size").where("p_brand = bound_name").select("bound_name", "bound_size", "p_partkey", "p_name")


@on_graph("select p_partkey, p_name, p_brand from part")
def project(g: Graph) -> DataFrame:
    return M.scan(g, "Part").select("p_partkey", "p_name", "p_brand")


@on_graph("select n_nationkey as ident, n_name as label from nation")
def alias(g: Graph) -> DataFrame:
    return M.scan(g, "Nation").select(F.col("n_nationkey").alias("ident"), F.col("n_name").alias("label"))


@on_graph("select c_custkey, c_custkey + 100 as shifted, c_acctbal * 2 as doubled from customer")
def arith(g: Graph) -> DataFrame:
    return M.scan(g, "Customer").select("c_custkey", (F.col("c_custkey") + 100).alias("shifted"), (F.col("c_acctbal") * 2).alias("doubled"))


@on_graph("select 1 as one from part")
def const_row(g: Graph) -> DataFrame:
    return M.scan(g, "Part").select(F.lit(1).alias("one"))


@on_graph("select p_partkey, p_name from part order by p_partkey")
def order_by(g: Graph) -> DataFrame:
    return M.scan(g, "Part").select("p_partkey", "p_name").orderBy("p_partkey")


@on_graph("select p_partkey, p_name from part order by p_partkey limit 1")
def first_row(g: Graph) -> DataFrame:
    return M.scan(g, "Part").select("p_partkey", "p_name").orderBy("p_partkey").limit(1)


@on_graph("""select n_nationkey as id, 1 as table_id, row_number() over (order by n_nationkey) - 1 as "offset", 'Nation' as label, n_name, n_regionkey from nation""")
def return_node(g: Graph) -> DataFrame:
    n = M.node_values(g, "Nation", "n_nationkey", "n_name", "n_regionkey")
    return n.select(F.col("node.properties.n_nationkey").alias("id"), "node.id.table_id", "node.id.offset", "node.label", "node.properties.n_name", "node.properties.n_regionkey")


@on_graph("""with c as (select c_custkey, row_number() over (order by c_custkey) - 1 as src_offset from customer), o as (select o_orderkey as k, row_number() over (order by o_orderkey) - 1 as dst_offset from orders)
select o_custkey as src, o_orderkey as dst, 10 as table_id, row_number() over (order by o_orderkey) - 1 as "offset", 2 as src_table, src_offset, 5 as dst_table, dst_offset, 'Placed' as label, o_totalprice, o_orderstatus from orders join c on o_custkey = c_custkey join o on o_orderkey = k""")
def return_rel(g: Graph) -> DataFrame:
    r = M.rel_values(g, "Placed", ["dst"], "o_totalprice", "o_orderstatus")
    ends = [F.col(f"rel.{end}.{a}").alias(f"{end}_{b}") for end in ("src", "dst") for a, b in (("table_id", "table"), ("offset", "offset"))]
    return r.select("src", "dst", "rel.id.table_id", "rel.id.offset", *ends, "rel.label", "rel.properties.o_totalprice", "rel.properties.o_orderstatus")


@query(f"""select c_custkey || '/' || name as akey, 0 as table_id, row_number() over (order by c_custkey || '/' || name) - 1 as "offset", value from {_ATTRS}""")
def internal_id_of_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Internal ids of a label whose primary key is a string."""
    rows = C.map_to_rows(_attributes(spark, sf_dir), "c_custkey", "attrs").select(F.concat_ws("/", "c_custkey", "name").alias("akey"), "value")
    return internal_ids(rows, "akey", 0)


@on_graph('select o_orderkey, 5 as table_id, row_number() over (order by o_orderkey) - 1 as "offset" from orders')
def internal_id(g: Graph) -> DataFrame:
    return internal_ids(g.node("Orders").select("o_orderkey"), "o_orderkey", 5)


# --- pattern joins -------------------------------------------------------------------------------------------------


@on_graph("select r_name, count(*) as customers from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by r_name")
def chain_region(g: Graph) -> DataFrame:
    return M.chain(g, "Customer", ["InNation", "InRegion"]).groupBy(F.col("n2_r_name").alias("r_name")).agg(F.count("*").alias("customers"))


@on_graph("select c_custkey, n_name, r_name from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def chain_at_hubs(g: Graph) -> DataFrame:
    """Each customer's nation and region; nations and regions are hubs, which few nodes share among all customers."""
    found = M.chain(g, "Customer", ["InNation", "InRegion"], hub_rows=500)
    return found.select(F.col("n0_c_custkey").alias("c_custkey"), F.col("n1_n_name").alias("n_name"), F.col("n2_r_name").alias("r_name"))


@on_graph(f"select a.c_name as a_name, k.since, b.c_name as b_name from {_KNOWS} k join customer a on k.src = a.c_custkey join customer b on k.dst = b.c_custkey")
def one_hop(g: Graph) -> DataFrame:
    return M.hop(g, "Knows").select(F.col("a_c_name").alias("a_name"), F.col("r_since").alias("since"), F.col("b_c_name").alias("b_name"))


@on_graph(f"select k.src, k.dst, k.since from {_KNOWS} k where k.src = 1 and k.dst = (select (7 + 3) % count(*) from customer)")
def one_hop_pinned(g: Graph) -> DataFrame:
    there = g.rel("Knows").where("src = 1 and since = 1").select(F.col("dst").alias("_d"))
    b = g.node("Customer").join(there, F.col("c_custkey") == F.col("_d"), "left_semi")
    return M.hop(g, "Knows", M.scan(g, "Customer", c_custkey=1), b).select(F.col("r_src").alias("src"), F.col("r_dst").alias("dst"), F.col("r_since").alias("since"))


@on_graph("select p_partkey as src, p_name from part where p_partkey > 0 and p_partkey // 10 = 3")
def incoming(g: Graph) -> DataFrame:
    return M.hop(g, "Located", dst=M.scan(g, "Part", p_partkey=3)).select(F.col("a_p_partkey").alias("src"), F.col("a_p_name").alias("p_name"))


@on_graph("select a.p_name as a_name, b.p_name as b_name from part a, part b where a.p_partkey = 1 and b.p_partkey = 2")
def cross_pinned(g: Graph) -> DataFrame:
    return M.pinned_pair(g, "Part", {"p_partkey": 1}, {"p_partkey": 2}).select(F.col("a_p_name").alias("a_name"), F.col("b_p_name").alias("b_name"))


@query(f"select c.c_custkey, a.name, a.value from customer c join {_ATTRS} a on c.c_custkey = a.c_custkey")
def attr_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.map_to_rows(_attributes(spark, sf_dir), "c_custkey", "attrs")
    attr = rows.select(F.concat_ws("/", "c_custkey", "name").alias("akey"), "name", "value")
    g = Graph(spark).add_nodes("Obj", table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").add_nodes("Attr", attr, "akey")
    g.add_rels("Has", rows.select(F.col("c_custkey").alias("src"), F.concat_ws("/", "c_custkey", "name").alias("dst")), "Obj", "Attr")
    return M.hop(g, "Has").select(F.col("a_c_custkey").alias("c_custkey"), F.col("b_name").alias("name"), F.col("b_value").alias("value"))


@on_graph(f"select p.p_partkey as node, count(l.src) as n from part p left join {_LOCATED} l on l.dst = p.p_partkey group by p.p_partkey")
def incoming_count(g: Graph) -> DataFrame:
    return M.incoming_counts(g, "Located")


@on_graph(f"select count(*) filter (where n is distinct from m) as mismatches, count(*) as parts from (select p.p_partkey as k, (select count(*) from {_LOCATED} l where l.dst = p.p_partkey) as n, (select count(*) from part c where c.p_partkey > 0 and c.p_partkey // 10 = p.p_partkey) as m from part p)")
def edge_vs_column(g: Graph) -> DataFrame:
    """Counts by relationships and by the column that they come from, side by side."""
    edges = M.incoming_counts(g, "Located")
    column = g.node("Part").where("p_partkey > 0").groupBy(F.expr("p_partkey div 10").alias("loc")).agg(F.count("*").alias("m"))
    both = edges.join(column, F.col("node") == F.col("loc"), "full_outer")
    return both.agg(F.sum((F.coalesce("n", F.lit(0)) != F.coalesce("m", F.lit(0))).cast("long")).alias("mismatches"), F.count("node").alias("parts"))


# --- paths ---------------------------------------------------------------------------------------------------------

_WALKS = f"""with recursive k as materialized (select * from {_KNOWS}), p as (
  select src, dst, 1 as hops, [src, dst] as nodes, [since] as rels from k
  union all select p.src, k.dst, p.hops + 1, list_append(p.nodes, k.dst), list_append(p.rels, k.since) from p join k on p.dst = k.src where p.hops < 3
)"""


@on_graph(f"{_WALKS} select src, dst, hops, array_to_string(nodes, '>') as path, array_to_string(rels, ',') as since from p where hops >= 2 and src in (select c_custkey from customer where c_nationkey = 3) and dst in (select c_custkey from customer where c_nationkey = 7)")
def var_path_pinned(g: Graph) -> DataFrame:
    """Paths of two and three relationships from the customers of one nation to those of another."""
    at = lambda nation: M.scan(g, "Customer", c_nationkey=nation).select("c_custkey")
    p = G.var_paths(g.rel("Knows"), 2, 3, rel_id="since", starts=at(3), ends=at(7))
    return p.select("src", "dst", "hops", F.array_join("nodes", ">").alias("path"), F.array_join("rels", ",").alias("since"))


@on_graph(f"{_WALKS} select src, dst, hops, array_to_string(nodes, '>') as path, len(rels) as n_rels from p")
def var_path(g: Graph) -> DataFrame:
    return G.var_paths(g.rel("Knows"), 1, 3, rel_id="since").select("src", "dst", "hops", F.array_join("nodes", ">").alias("path"), F.size("rels").cast("long").alias("n_rels"))


@on_graph(f"{_WALKS} select src, dst, array_to_string(nodes, '>') as path from p where hops <= 3 and len(list_distinct(nodes)) = len(nodes)")
def var_path_acyclic(g: Graph) -> DataFrame:
    return G.var_paths(g.rel("Knows"), 1, 3, "acyclic", "since").select("src", "dst", F.array_join("nodes", ">").alias("path"))


@on_graph("select src, dst, count(*) as n from (select n_nationkey as src, n_regionkey as dst from nation) group by src, dst")
def var_path_onehop(g: Graph) -> DataFrame:
    """A variable pattern of which one hop matches gives paths of two nodes and one relationship."""
    p = G.var_paths(g.rel("InRegion").select((F.col("src") + 1000).alias("src"), "dst"), 1, 3)
    return p.where((F.size("nodes") == 2) & (F.size("rels") == 1)).groupBy((F.col("src") - 1000).alias("src"), "dst").agg(F.count("*").alias("n"))


@on_graph(f"{_WALKS} select src, dst, array_to_string(nodes, '>') as path, (select string_agg(c_name, ',' order by i) from (select unnest(nodes) as n, generate_subscripts(nodes, 1) as i) x join customer on c_custkey = x.n) as names from p where hops = 2")
def path_props(g: Graph) -> DataFrame:
    p = G.with_properties(G.var_paths(g.rel("Knows"), 2, 2, rel_id="since"), g.node("Customer"), "c_custkey", "c_name")
    return p.select("src", "dst", F.array_join("nodes", ">").alias("path"), F.array_join(F.transform("node_values", lambda v: v["c_name"]), ",").alias("names"))


@on_graph(f"{_WALKS} select src, dst, (select string_agg(c_name, ',' order by i) from (select unnest(nodes) as n, generate_subscripts(nodes, 1) as i) x join customer on c_custkey = x.n) as names, array_to_string(rels, ',') as since from p where hops = 2")
def path_value(g: Graph) -> DataFrame:
    """A path as one value: nodes and relationships, both with their properties."""
    p = G.path_values(G.var_paths(g.rel("Knows"), 2, 2), g.node("Customer"), "c_custkey", "c_name")
    return p.select("src", "dst", F.array_join(F.transform("path.nodes", lambda v: v["c_name"]), ",").alias("names"), F.array_join(F.transform("path.rels", lambda r: r["since"].cast("string")), ",").alias("since"))


@on_graph(f"{_WALKS} select src, dst, '<' || array_to_string(list_concat(list_transform(nodes, lambda x: '(:Customer {{c_custkey: ' || x || '}})'), list_transform(rels, lambda x: '[:Knows {{since: ' || x || '}}]')), ', ') || '>' as path from p")
def render_path(g: Graph) -> DataFrame:
    p = G.var_paths(g.rel("Knows"), 1, 3, rel_id="since")
    nodes = F.transform("nodes", lambda x: F.concat(F.lit("(:Customer {c_custkey: "), x, F.lit("})")))
    rels = F.transform("rels", lambda x: F.concat(F.lit("[:Knows {since: "), x, F.lit("}]")))
    return p.select("src", "dst", E.rendered_path(nodes, rels).alias("path"))


@on_graph(f"{_WALKS} select count(*) as paths, (select count(*) from (select distinct nodes, rels from p)) as distinct_paths from p")
def path_distinct(g: Graph) -> DataFrame:
    p = G.var_paths(g.rel("Knows"), 1, 3, rel_id="since").select("nodes", "rels")
    counted = p.groupBy("nodes", "rels").agg(F.count("*").alias("n"))
    return counted.agg(F.sum("n").alias("paths"), F.count("*").alias("distinct_paths"))


@on_graph(f"{_WALKS} select src, dst, hops, count(*) as walks from p group by src, dst, hops")
def walk_counts(g: Graph) -> DataFrame:
    return G.walk_counts(g.rel("Knows"), 3)


_CLOSURE = f"with recursive l as materialized (select * from {_LOCATED}), r as (select src, dst from l union select r.src, l.dst from r join l on r.dst = l.src)"


@on_graph(f"{_CLOSURE} select src, dst from r")
def reachability(g: Graph) -> DataFrame:
    return G.reachable(g.rel("Located")).select("src", "dst")


@on_graph(f"""with recursive l as materialized (select distinct src, dst from {_KNOWS}), r as (select src, dst from l union select r.src, l.dst from r join l on r.dst = l.src),
n as (select src as node from l union select dst from l), mutual as (select x.src as node, min(x.dst) as m from r x join r y on x.src = y.dst and x.dst = y.src group by x.src)
select n.node, least(n.node, coalesce(m, n.node)) as component, count(r.dst) as n from n left join r on r.src = n.node left join mutual on mutual.node = n.node group by n.node, m""")
def cyclic_reach(g: Graph) -> DataFrame:
    """How many customers each customer reaches over contacts, which go round in circles."""
    return G.reach_counts(g.rel("Knows")).select("node", "component", "n")


@on_graph(f"{_CLOSURE} select p_partkey as node, count(r.dst)::int as depth from part left join r on r.src = p_partkey group by p_partkey")
def tree_depth(g: Graph) -> DataFrame:
    return G.depths(g.node("Part"), "p_partkey", g.rel("Located"))


# --- aggregates and report -----------------------------------------------------------------------------------------


@on_graph("select count(c_custkey) as n from customer")
def count_nodes(g: Graph) -> DataFrame:
    return g.node("Customer").agg(F.count("c_custkey").alias("n"))


@on_graph("select count(*) as n from customer where c_acctbal > 1e12")
def count_empty(g: Graph) -> DataFrame:
    """No customer is so rich: one row, 0."""
    return g.node("Customer").where("c_acctbal > 1e12").agg(F.count("*").alias("n"))


_SAMPLE = "select event_type, count(*)::bigint as n, {0}, max(value) as max, round(avg(value), 6) as mean from events group by event_type"


@query(_SAMPLE.format(", ".join(f"list_sort(list(value))[least(count(*), floor(count(*) * {p}::double)::bigint + 1)] as {k}" for k, p in R.SHARES.items())))
def latency_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = R.latency_summary(table(spark, sf_dir, "events"), ["event_type"], "value")
    return out.withColumn("mean", F.round("mean", 6))


_RUNS = "(select event_type as model, case user_id % 4 when 0 then 1 when 1 then 10 when 2 then 100 else 1000 end as size, value, user_id from events)"


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.element_at(F.array(F.lit(1), F.lit(10), F.lit(100), F.lit(1000)), (F.col("user_id") % 4 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(F.col("event_type").alias("model"), size.alias("size"), "value", "user_id")


_RATES = f"(select model, size, count(*)::bigint as n, count(distinct user_id)::bigint as writers, case when max(user_id) > 0 then round(count(*)::double / max(user_id), 1) else 0 end as rate from {_RUNS} group by model, size)"


def _rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes of each model and batch size; the greatest user number stands for the seconds that they took."""
    grouped = _runs(spark, sf_dir).groupBy("model", "size").agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("writers"), F.max("user_id").alias("seconds"))
    return grouped.select("model", "size", "n", "writers", R.rate(F.col("n"), F.col("seconds")).alias("rate"))


@query(f"select model, size, n, writers, rate from {_RATES}")
def rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rates(spark, sf_dir)


@query(f"select model, size, n, writers, rate from {_RATES}")
def results_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements of each model, of which those of two models are written twice, the first time with other figures."""
    at, rates = f"{shared_dir(spark)}/results-{uuid.uuid4().hex}", _rates(spark, sf_dir)
    early = rates.where(F.col("model").isin("click", "view"))
    write_results(early.withColumn("rate", F.lit(-1.0)), at)
    write_results(rates, at)
    write_results(early, at)
    return spark.read.schema("model string, size int, n bigint, writers bigint, rate double").parquet(at).select("model", "size", "n", "writers", "rate")


@query(f"select model, size, rate from {_RATES}")
def nested_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON document a model with all its results in it, read back as one row a result."""
    at = f"{shared_dir(spark)}/nested-{uuid.uuid4().hex}"
    documents = _rates(spark, sf_dir).groupBy("model").agg(F.collect_list(F.struct("model", "size", "rate")).alias("results"))
    documents.withColumnRenamed("model", "document").write.partitionBy("document").json(at)
    return read_results(spark, at).select("model", F.col("size").cast("int").alias("size"), "rate")


_SIZES = (1, 10, 100, 1000)
_PIVOT = "(select model, " + ", ".join(f"coalesce(max(rate) filter (where size = {k}), 0) as rate_{k}" for k in _SIZES) + f" from {_RATES} group by model)"


@query(f"select * from {_PIVOT}")
def report_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.pivoted(_rates(spark, sf_dir), ["model"], "size", list(_SIZES), "rate", "rate")


@query(f"select model, round(case when rate_1 = 0 then 0 else rate_1000 / rate_1 end, 6) as speedup from {_PIVOT}")
def speedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_pivot(spark, sf_dir).select("model", F.round(R.ratio(F.col("rate_1000"), F.col("rate_1")), 6).alias("speedup"))


@query(f"select model, case when rate_1000 > 1.5::double * rate_1 then 'yes' else 'no' end as scales from {_PIVOT}")
def scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_pivot(spark, sf_dir).select("model", R.scales(F.col("rate_1000"), F.col("rate_1")).alias("scales"))


@query("select event_type, case when n = 0 then 'not measured' when p99 <= 90 then 'PASS' else 'FAIL' end as verdict from (select event_type, count(value) as n, list_sort(list(value))[least(count(*), floor(count(*) * 0.99::double)::bigint + 1)] as p99 from events group by event_type)")
def verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = R.latency_summary(table(spark, sf_dir, "events"), ["event_type"], "value")
    return out.select("event_type", R.verdict(F.col("p99"), F.lit(90.0), F.lit(True), F.col("n")).alias("verdict"))


@query("select distinct p_size from part")
def distinct_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.distinct_sorted(table(spark, sf_dir, "part"), "p_size")


# --- structural equality -------------------------------------------------------------------------------------------


@query("select distinct c_nationkey as nation, c_mktsegment as segment from customer")
def structural_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.struct(F.col("c_mktsegment").alias("segment"), F.array("c_nationkey").alias("nations"))
    d = E.distinct(table(spark, sf_dir, "customer").select(value.alias("v")))
    return d.select(F.get("v.nations", F.lit(0)).alias("nation"), "v.segment")


@query("select c_custkey, c_nationkey = (c_custkey % 25) as same from customer")
def struct_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs whose fields come in another order."""
    df = table(spark, sf_dir, "customer").select("c_custkey", F.struct(F.col("c_nationkey").alias("n"), F.col("c_mktsegment").alias("m")).alias("a"), F.struct(F.col("c_mktsegment").alias("m"), (F.col("c_custkey") % 25).cast("int").alias("n")).alias("b"))
    return df.select("c_custkey", E.equal(df, "a", "b").alias("same"))


@query("select c_custkey, true as same_order, c_mktsegment = c_name as other_order from customer")
def map_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps with equal entries in equal order, and in another order."""
    k, v = F.array(F.lit("x"), F.lit("y")), F.array("c_name", "c_mktsegment")
    back = C.map_of(F.array(F.lit("y"), F.lit("x")), F.array("c_mktsegment", "c_name"))
    df = table(spark, sf_dir, "customer").select("c_custkey", C.map_of(k, v).alias("a"), C.map_of(k, v).alias("b"), back.alias("c"))
    return df.select("c_custkey", E.equal(df, "a", "b").alias("same_order"), E.equal(df, "a", "c").alias("other_order"))


@query("select o_orderkey, (case when o_orderstatus = 'F' then o_totalprice end) is not distinct from (case when o_orderpriority like '1%' then o_totalprice end) as same from orders")
def null_safe_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("a"), F.when(F.col("o_orderpriority").startswith("1"), F.col("o_totalprice")).alias("b"))
    return df.select("o_orderkey", E.equal(df, "a", "b").alias("same"))


@query("select n, count(*) as groups from (select count(*) as n from customer group by c_nationkey, c_mktsegment) group by n")
def structural_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select(F.struct("c_nationkey", "c_mktsegment").alias("v"))
    sizes = df.select(E.structural_hash(df).alias("h")).groupBy("h").agg(F.count("*").alias("n"))
    return sizes.groupBy("n").agg(F.count("*").alias("groups"))


@on_graph("select n_nationkey, '(:Nation {n_nationkey: ' || n_nationkey || ', n_name: ' || n_name || '})' as text from nation")
def render_node(g: Graph) -> DataFrame:
    df = g.node("Nation").select("n_nationkey", F.struct("n_nationkey", "n_name").alias("p"))
    return df.select("n_nationkey", E.rendered_node("Nation", F.col("p"), df.schema["p"].dataType).alias("text"))


# --- constructors --------------------------------------------------------------------------------------------------


@query("select o_orderkey, o_orderdate::date as day, year(o_orderdate::date)::int as year from orders")
def fn_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = C.date(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", day.alias("day"), F.year(day).alias("year"))


@query("select o_orderkey, epoch_us(o_orderdate) as us, year(o_orderdate)::int as year, epoch_us(o_orderdate + interval 3 days + interval 2 hours) as later from orders")
def fn_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts, more = C.timestamp(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS")), C.interval(F.lit("3 days 2 hours"))
    later = F.unix_micros(ts) + more["days"] * F.lit(86_400_000_000) + more["micros"]
    return table(spark, sf_dir, "orders").select("o_orderkey", F.unix_micros(ts).alias("us"), F.year(ts).alias("year"), later.alias("later"))


@query("select l_orderkey, l_linenumber, (l_quantity::int % 14)::int as months, (l_quantity::int * 2)::int as days, (l_linenumber::bigint * 3600000000)::bigint as micros, (l_linenumber * 86400 * 3 + 7)::bigint as seconds, (l_linenumber * 3)::int as whole_days, 7000000::bigint as rest from lineitem")
def fn_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Intervals from texts, and from seconds."""
    text = F.concat(F.col("l_quantity").cast("int") % 14, F.lit(" months "), F.col("l_quantity").cast("int") * 2, F.lit(" days "), "l_linenumber", F.lit(" hours"))
    seconds = (F.col("l_linenumber") * 86400 * 3 + 7).cast("bigint")
    back = V.interval_of(seconds)
    # a column of its own, so that its three parts are read off one search
    found = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", C.interval(text).alias("i"), seconds.alias("seconds"), back.alias("back"))
    return found.select("l_orderkey", "l_linenumber", F.col("i.months").alias("months"), F.col("i.days").alias("days"), F.col("i.micros").alias("micros"), "seconds", F.col("back.days").alias("whole_days"), F.col("back.micros").alias("rest"))


@query("select o_orderkey, ((o_orderkey - 1000)::hugeint * 18446744073709551616::hugeint + 7)::varchar as wide from orders")
def int128_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", V.int128(F.col("o_orderkey") - 1000, F.lit(7)).alias("wide"))


@query("select a.n_nationkey as a, b.n_nationkey as b from nation a join nation b on encode(a.n_name) = encode(b.n_name)")
def blob_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blobs are equal by content."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.encode("n_name", "UTF-8").alias("bytes"))
    return n.select(F.col("n_nationkey").alias("a"), F.col("bytes").alias("x")).join(n.select(F.col("n_nationkey").alias("b"), F.col("bytes").alias("y")), F.col("x") == F.col("y")).select("a", "b")


@query("select p_partkey as name, p_name as name_2 from part")
def duplicate_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of one alias: the leftmost is found by it."""
    return M.with_unique_names(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("name"), F.col("p_name").alias("name")))


@query("select p_brand as model, p_size as size, unnest([p_type, p_name]) as note from part")
def explode_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.notes(table(spark, sf_dir, "part").select(F.col("p_brand").alias("model"), F.col("p_size").alias("size"), F.array("p_type", "p_name").alias("notes")))


@query("select n_nationkey, upper(hex(encode(n_name))) as bytes, octet_length(encode(n_name))::int as n from nation")
def fn_blob(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit("\\x"), F.array_join(F.regexp_extract_all(F.hex("n_name"), F.lit("(..)")), "\\x"))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.hex(C.blob(text)).alias("bytes"), F.length(C.blob(text)).alias("n"))


@query("select p_partkey, 3 as n, p_name as first, p_type as third, null::varchar as beyond from part")
def fn_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = F.array("p_name", "p_brand", "p_type")
    return table(spark, sf_dir, "part").select("p_partkey", F.size(items).alias("n"), C.element(items, 0).alias("first"), C.element(items, 2).alias("third"), C.element(items, 3).alias("beyond"))


@query("select c_custkey, 3 as n, 'NAME' as first_key, c_mktsegment as segment, null::varchar as absent from customer")
def fn_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _attributes(spark, sf_dir)
    return df.select("c_custkey", F.size("attrs").alias("n"), C.entry(F.col("attrs"), 0)["key"].alias("first_key"), F.col("attrs")["SEGMENT"].alias("segment"), F.try_element_at("attrs", F.lit("NONE")).alias("absent"))


@query(r"select p_partkey, replace(replace(p_name || chr(92) || chr(39), chr(92), chr(92) || chr(92)), chr(39), chr(92) || chr(39)) as text from part")
def fn_escape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", C.escaped(F.concat("p_name", F.lit("\\'"))).alias("text"))


@query(f"select c_custkey, name, value from {_ATTRS}")
def map_to_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.map_to_rows(_attributes(spark, sf_dir), "c_custkey", "attrs")


@query("select c_custkey, 'NAME=' || c_name || ';NATION=' || c_nationkey || ';SEGMENT=' || c_mktsegment as attrs from customer")
def rows_to_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.map_to_rows(_attributes(spark, sf_dir), "c_custkey", "attrs")
    m = C.rows_to_map(rows, "c_custkey", "name", "value", "attrs")
    return m.select("c_custkey", F.array_join(F.transform(F.map_entries("attrs"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";").alias("attrs"))


@query(f"select c_custkey as owner, (dense_rank() over (order by name) - 1)::int as name_id, value from {_ATTRS}")
def key_reencode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = C.map_to_rows(_attributes(spark, sf_dir), "c_custkey", "attrs").select(F.concat_ws("/", "c_custkey", "name").alias("akey"), "value")
    return C.reencoded(rows, "akey")[0].select("owner", "name_id", "value")


# --- typed loading -------------------------------------------------------------------------------------------------


@query("select o_orderkey, (case when o_orderstatus = 'F' then o_totalprice end) is null as is_null, null::bigint as bound from orders")
def null_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).isNull().alias("is_null"), V.null_of("bigint").alias("bound"))


@query("select o_orderkey, " + ", ".join(f"(case when x between {a} and {b} then x end)::varchar as {k}" for k, (a, b, _) in V.INTEGERS.items()) + " from (select o_orderkey, (o_orderkey::hugeint - 100) * 3000000000 * (o_orderkey % 3) as x from orders)")
def int_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digits tried at every integer width."""
    x = ((F.col("o_orderkey") - 100).cast("decimal(20,0)") * F.lit(3_000_000_000).cast("decimal(12,0)") * (F.col("o_orderkey") % 3).cast("decimal(2,0)")).cast("string")
    return table(spark, sf_dir, "orders").select("o_orderkey", *(V.integer(x, k).cast("string").alias(k) for k in V.INTEGERS))


@query("select l_orderkey, l_linenumber, l_partkey, (l_extendedprice::decimal(20,2) * 10000000000000000::decimal(18,0))::varchar as exact from lineitem")
def decimal_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(20,2)").cast("string")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (V.decimal(price, 20, 2) * F.lit("10000000000000000").cast("decimal(18,0)")).cast("decimal(38,2)").cast("string").alias("exact"))


_PRICE = "(select l_orderkey, l_linenumber, l_extendedprice::decimal(20,2)::varchar as t from lineitem)"


@query(f"select l_orderkey, l_linenumber, greatest(length(ltrim(split_part(t, '.', 1), '0')) + length(split_part(t, '.', 2)), 1)::int as precision, length(split_part(t, '.', 2))::int as scale from {_PRICE}")
def decimal_ps(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = V.decimal_size(F.col("l_extendedprice").cast("decimal(20,2)").cast("string"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", size["precision"].alias("precision"), size["scale"].alias("scale"))


@query("select l_orderkey, l_linenumber, l_quantity::bigint::decimal(18,4)::varchar as wide from lineitem")
def decimal_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", V.decimal(F.col("l_quantity").cast("bigint").cast("string"), 18, 4).cast("string").alias("wide"))


@query(f"select l_orderkey, l_linenumber, (t || '5')::decimal(18,2)::varchar as up, ('-' || t || '5')::decimal(18,2)::varchar as down from {_PRICE}")
def decimal_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half away from zero, on either side of it."""
    t = F.concat(F.col("l_extendedprice").cast("decimal(20,2)").cast("string"), F.lit("5"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", V.decimal(t, 18, 2).cast("string").alias("up"), V.decimal(F.concat(F.lit("-"), t), 18, 2).cast("string").alias("down"))


@query(f"select l_orderkey, l_linenumber, try_cast(t as decimal(6,2))::varchar as fits from {_PRICE}")
def decimal_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("l_extendedprice").cast("decimal(20,2)").cast("string")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", V.decimal(t, 6, 2).cast("string").alias("fits"))


@query("select l_orderkey, l_linenumber, (round((l_discount + 0.005::double) * 100::double)::bigint::decimal(18,2) / 100)::decimal(18,2)::varchar as via_double from lineitem")
def decimal_literal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", V.decimal_literal(F.col("l_discount") + F.lit(0.005), 18, 2).cast("string").alias("via_double"))


@query("select event_id, epoch_us(make_timestamp(e * 1000000)) as s, e * 1000000 + 5000 as ms, e * 1000000 + 7 as us, (e * 1000000000 + 123456) // 1000 as ns, (date '1970-01-01' + (e // 86400)::int)::varchar as day from (select event_id, epoch_us(ts) // 1000000 as e from events)")
def epoch_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.unix_seconds(F.col("ts").cast("timestamp"))
    ev = table(spark, sf_dir, "events").select("event_id", e.alias("e"))
    at = {"s": F.col("e"), "ms": F.col("e") * 1000 + 5, "us": F.col("e") * 1_000_000 + 7, "ns": F.col("e") * 1_000_000_000 + 123_456}
    return ev.select("event_id", *(F.unix_micros(V.instant(x, u)).alias(u) for u, x in at.items()), V.day(F.expr("e div 86400")).cast("string").alias("day"))


@query(f"select event_id, case when d between {V.DAYS[0]} and {V.DAYS[1]} then d end as day, case when s * 1000000 between {V.MICROS[0]} and {V.MICROS[1]} then (s * 1000000)::bigint end as micros from (select event_id, event_id * 1000 - 1000000 as d, event_id::hugeint * 1000000000 as s from events)")
def temporal_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select("event_id", (F.col("event_id") * 1000 - 1_000_000).alias("d"), (F.col("event_id") * 1_000_000_000).alias("s"))
    return ev.select("event_id", F.unix_date(V.day(F.col("d"))).cast("bigint").alias("day"), F.unix_micros(V.instant(F.col("s"), "s")).alias("micros"))


@query("select event_id, case when abs(m::double * 2592000 + d::double * 86400 + us::double / 1e6) <= 922337203685 then m::double * 2592000 + d::double * 86400 + us::double / 1e6 end as seconds from (select event_id, user_id * user_id * 10 as m, event_id % 31 as d, event_id * 1000 as us from events)")
def interval_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", V.interval_seconds(F.col("user_id") * F.col("user_id") * 10, F.col("event_id") % 31, F.col("event_id") * 1000).alias("seconds"))


@query("select event_id, epoch_us(ts - interval 9 hour) as micros, epoch_us(ts) as bare from events")
def to_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select("event_id", F.unix_micros(V.utc(ts, "Asia/Tokyo")).alias("micros"), F.unix_micros(V.utc(ts, None)).alias("bare"))


_UUID = "(select event_id, md5(event_id::varchar) as h from events)"


@query(f"select event_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21) as id, null::varchar as bad from {_UUID}")
def uuid_canon(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = F.upper(F.md5(F.col("event_id").cast("string")))
    return table(spark, sf_dir, "events").select("event_id", V.uuid(h).alias("id"), V.uuid(F.substring(h, 2, 31)).alias("bad"))


_MEMBERS = [("num", "bigint"), ("txt", "string")]


@query("select event_id, case when event_id % 2 = 0 then 'num' else 'txt' end as tag, case when event_id % 2 = 0 then event_id end as num, case when event_id % 2 = 1 then event_type end as txt from events")
def union_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("event_id") % 2 == 0, F.col("event_id").cast("string")).otherwise(F.col("event_type"))
    v = table(spark, sf_dir, "events").select("event_id", V.union_of(text, _MEMBERS).alias("v"))
    return v.select("event_id", "v.tag", V.union_member(F.col("v"), "num").alias("num"), V.union_member(F.col("v"), "txt").alias("txt"))


@query("select event_id, 'txt' as tag, event_id::varchar as txt, null::bigint as num from events")
def union_explicit(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "events").select("event_id", V.union_value("txt", F.col("event_id").cast("string"), _MEMBERS).alias("v"))
    return v.select("event_id", "v.tag", "v.txt", "v.num")


@query("""select o_orderkey, case o_orderkey % 4
  when 0 then case when o_orderkey % 3 = 0 then 'accessor' else 'accepted' end
  when 1 then case when length(o_orderkey::varchar) + 20 + o_orderkey % 30 > 38 then 'digits' else 'accepted' end
  when 2 then case when 50 + o_orderkey % 30 > 64 then 'depth' else 'accepted' end
  else case when o_orderkey % 3 = 0 then 'cast' else 'accepted' end end as verdict from orders""")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order's value, accepted or with the reason why it is refused: a union read as a member that it hasn't, a
    decimal of more than 38 digits, a list nested deeper than 64, a text that isn't the number that it is cast to."""
    key = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (key % 4).alias("kind"))
    text, bad = key.cast("string"), key % 3 == 0
    many = (key % 30).cast("int")
    own = lambda k, x: F.when(F.col("kind") == k, x)
    union = F.when(bad, V.union_value("txt", text, _MEMBERS)).otherwise(V.union_value("num", key, _MEMBERS))
    values = orders.select("o_orderkey", own(0, union).alias("u"), own(1, F.concat(text, F.repeat(F.lit("0"), 20 + many))).alias("digits"), own(2, F.concat(F.repeat(F.lit("["), 50 + many), F.repeat(F.lit("]"), 50 + many))).alias("list"), own(3, F.when(bad, F.concat(text, F.lit("x"))).otherwise(text)).alias("number"))
    rules = {"accessor": (F.col("u"), V.union_member(F.col("u"), "num")), "digits": (F.col("digits"), V.decimal_size(F.col("digits"))), "depth": (F.col("list"), V.nested_within(F.col("list"))), "cast": (F.col("number"), V.integer(F.col("number"), "int64"))}
    return values.select("o_orderkey", F.coalesce(V.first_refusal(rules), F.lit("accepted")).alias("verdict"))


# --- mutation log --------------------------------------------------------------------------------------------------


@query("select user_id, event_type, value, epoch_us(ts) as ts_us, event_id from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as k from events) where k = 1")
def lww_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = table(spark, sf_dir, "events").select("user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "event_id")
    return U.latest(log, ["user_id", "event_type"], "value", ["ts_us", "event_id"])


@query("select user_id, event_type, value, epoch_us(ts) as ts_us, event_id from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as k from events) where k = 1")
def lww_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same last writes by a stream in six micro-batches: three, then the stream is started again from its
    checkpoint with what came in meanwhile."""
    at, order = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}", ["ts_us", "event_id"]
    schema = "user_id bigint, event_type string, value double, ts_us bigint, event_id bigint"
    events = spark.read.schema(SCHEMAS["events"]).parquet(f"{sf_dir}/events.parquet")
    log = events.select("user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "event_id", F.pmod(F.xxhash64("event_id"), F.lit(2)).alias("part"))
    to = AttributeTable(spark, f"{at}/table", schema, ["user_id", "event_type"], "value", order)
    for part in (0, 1):
        log.where(F.col("part") == part).drop("part").repartition(3).write.mode("append").parquet(f"{at}/log")
        run_upserts(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{at}/log"), to, f"{at}/checkpoint").awaitTermination()
    return to.read()


# --- search --------------------------------------------------------------------------------------------------------


_TOPK = """with v as (select vec_id, embedding::double[] as e from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0)
select query_id, vec_id, score, place from (select q.vec_id as query_id, v.vec_id, round(list_cosine_similarity(q.e, v.e), 9) as score, row_number() over (partition by q.vec_id order by round(list_cosine_similarity(q.e, v.e), 9) desc, v.vec_id) as place
from v q join v on q.vec_id % 20 = 0 and q.vec_id <> v.vec_id) where place <= 10"""


@query(_TOPK)
def vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    out = N.vector_top_k(vectors, vectors.where("vec_id % 20 = 0"), 10)
    return out.select("query_id", "vec_id", "score", F.col("place").cast("long").alias("place"))


@query(_TOPK)
def vector_index_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows from a file of vectors by cells: the nearest cells first, then those that could hold better ones."""
    vectors = table(spark, sf_dir, "embeddings")
    index = VI.build(vectors, f"{shared_dir(spark)}/vectors-{uuid.uuid4().hex}")
    out = VI.top_k(index, vectors.where("vec_id % 20 = 0"), 10)
    return out.select("query_id", "vec_id", "score", F.col("place").cast("long").alias("place"))


_TERMS = ["license", "apache"]


_BM25 = """with w as (select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') as w from documents),
c as (select doc_id, len(w) as n, len(list_filter(w, lambda x: x = 'license')) as t0, len(list_filter(w, lambda x: x = 'apache')) as t1 from w),
a as (select count(*) as docs, avg(n) as mean, sum((t0 > 0)::int) as d0, sum((t1 > 0)::int) as d1 from c)
select doc_id, round(0.0::double + ln(1 + (docs - d0 + 0.5::double) / (d0 + 0.5::double)) * t0 * 2.2::double / (t0 + 1.2::double * (0.25::double + 0.75::double * n / mean))
  + ln(1 + (docs - d1 + 0.5::double) / (d1 + 0.5::double)) * t1 * 2.2::double / (t1 + 1.2::double * (0.25::double + 0.75::double * n / mean)), 9) as score
from c, a where t0 > 0 or t1 > 0"""


@query(_BM25)
def text_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a term, by BM25."""
    return N.bm25(table(spark, sf_dir, "documents"), _TERMS)


def _index(spark: SparkSession, sf_dir: str) -> I.TextIndex:
    return I.build(table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/index-{uuid.uuid4().hex}")


@query(_BM25)
def text_index_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores of text_topk from the postings of an inverted index."""
    return I.bm25(_index(spark, sf_dir), _TERMS)


@query(f"select doc_id, score from ({_BM25}) order by score desc, doc_id limit 10")
def text_index_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best, without the blocks of documents whose bound is below the tenth."""
    return I.bm25(_index(spark, sf_dir), _TERMS, 10)


@query(r"""with w as (select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w from documents)
select doc_id, times from (select doc_id, len(list_filter(range(1, len(w)), lambda i: w[i] = 'license' and w[i + 1] = 'version'))::bigint as times from w) where times > 0""")
def text_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.phrase(_index(spark, sf_dir), ["license", "version"])
