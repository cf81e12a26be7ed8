import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from graphloom.operators import match as M
from graphloom.operators import params as B
from graphloom.sources import graph as S


@pytest.fixture()
def knows(spark):
    g = S.Graph(spark)
    g.add_nodes("Person", spark.createDataFrame([(1, "Ada"), (2, "Grace"), (3, "Alan")], "id long, name string"), "id")
    g.add_rels("Knows", spark.createDataFrame([(1, 2, 1990), (2, 3, 1995)], "src long, dst long, since long"), "Person", "Person")
    return g


def test_one_hop_returns_both_ends_and_the_relationship(knows):
    rows = M.hop(knows, "Knows", M.scan(knows, "Person", id=1)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert (r["a_name"], r["b_name"], r["r_since"]) == ("Ada", "Grace", 1990)
    assert (r["r_src"], r["r_dst"]) == (r["a_id"], r["b_id"])


def test_parallel_relationships_match_each(spark, knows):
    g = S.Graph(spark).add_nodes("Person", knows.node("Person"), "id")
    g.add_rels("Knows", knows.rel("Knows").unionByName(knows.rel("Knows")), "Person", "Person")
    assert M.hop(g, "Knows").count() == 4


def test_keys_and_ends_are_checked(spark, knows):
    knows.check()
    bad = S.Graph(spark).add_nodes("P", spark.createDataFrame([(1,), (1,), (None,)], "id long"), "id")
    assert [r["violations"] for r in bad.key_violations().collect()] == [2]
    with pytest.raises(S.KeyViolation):
        bad.check()
    loose = S.Graph(spark).add_nodes("P", spark.createDataFrame([(1,)], "id long"), "id")
    loose.add_rels("R", spark.createDataFrame([(1, 9)], "src long, dst long"), "P", "P")
    with pytest.raises(S.KeyViolation):
        loose.check()
    with pytest.raises(ValueError):
        loose.add_nodes("P", loose.node("P"), "id")


def test_pinned_pair_needs_both_keys(knows):
    assert M.pinned_pair(knows, "Person", {"id": 1}, {"id": 2}).count() == 1
    with pytest.raises(ValueError):
        M.pinned_pair(knows, "Person", {"name": "Ada"}, {"id": 2})


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").select(F.col("a").alias("dup"), F.col("b").alias("dup"))
    assert M.with_unique_names(df).select("dup").first()[0] == 1
    with pytest.raises(AnalysisException):
        M.with_unique_names(df).select("nope")


def test_internal_ids_are_dense_by_key(spark):
    df = spark.range(0, 5000).select((F.col("id") * 37 % 5000 * 3).alias("k"))
    rows = S.internal_ids(df, "k", 4).orderBy("k").collect()
    assert [r["offset"] for r in rows] == list(range(5000)) and {r["table_id"] for r in rows} == {4}


def test_internal_ids_of_text_and_of_several_columns(spark):
    df = spark.createDataFrame([(f"k{k * 7 % 100}", k % 3) for k in range(100)], "k string, j long")
    by_text = S.internal_ids(df, "k", 0).orderBy("offset").collect()
    assert [r["k"] for r in by_text] == sorted(r["k"] for r in by_text) and [r["offset"] for r in by_text] == list(range(100))
    by_both = S.internal_ids(df, ["j", "k"], 0).orderBy("offset").collect()
    assert [(r["j"], r["k"]) for r in by_both] == sorted((r["j"], r["k"]) for r in by_both)
    assert S.internal_ids(df.limit(0), "k", 0).count() == 0


def test_values_carry_internal_ids(spark, knows):
    label = next(iter(knows.nodes))
    rel = next(iter(knows.rels))
    ids = {r["key"]: r["node"]["id"]["offset"] for r in M.node_values(knows, label, knows.nodes[label].pk).collect()}
    assert sorted(ids.values()) == list(range(len(ids))) and [k for k, _ in sorted(ids.items(), key=lambda x: x[1])] == sorted(ids)
    rows = M.rel_values(knows, rel, knows.rel(rel).columns).collect()
    assert len(rows) == knows.rel(rel).count() and sorted(r["rel"]["id"]["offset"] for r in rows) == list(range(len(rows)))
    for r in rows:
        assert (r["rel"]["src"]["offset"], r["rel"]["dst"]["offset"]) == (ids[r["src"]], ids[r["dst"]]) and r["rel"]["id"]["table_id"] == knows.table_id(rel)


def test_settings(spark):
    assert S.setting(spark, "spark.sql.session.timeZone") == "UTC" and S.setting(spark, "no.such.setting") is None


def test_csv_and_json_sources(spark, tmp_path):
    (tmp_path / "good.csv").write_text("1,Limbo\n2,Hall\n")
    (tmp_path / "bad.csv").write_text("x,Limbo\n")
    assert S.read_csv(spark, str(tmp_path / "good.csv"), "id long, name string").count() == 2
    with pytest.raises(Exception, match="(?i)malformed|cast|failfast"):
        S.read_csv(spark, str(tmp_path / "bad.csv"), "id long, name string").collect()
    (tmp_path / "r.json").write_text(json.dumps({"seed": 1, "results": [{"model": "map", "size": 10, "notes": ["a", "b"]}]}))
    df = S.read_results(spark, str(tmp_path / "r.json"))
    assert df.first()["model"] == "map"
    S.write_results(df, str(tmp_path / "out"))
    S.write_results(df.withColumn("size", F.lit(100)), str(tmp_path / "out"))
    S.write_results(df, str(tmp_path / "out"))
    assert sorted(r["size"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [10, 100]


def test_rows_stream_and_scripts(spark):
    assert [r["id"] for r in S.row_stream(spark.range(5).orderBy("id"))] == [0, 1, 2, 3, 4]
    assert [d.first()[0] for d in B.run_many(spark, ["select 1", "select 1", "select 1 + 100"])] == [1, 1, 101]


def test_parameters(spark):
    s = B.Statement(spark, "select * from range(5) where id >= :least and id < :below")
    s.bind(least=1, below=3)
    assert s.run().count() == 2
    assert s.bind(below=5).run().count() == 4
    assert s.bind(unknown=1).run().count() == 4
    with pytest.raises(ValueError):
        s.bind(**{" ": 1})
    with pytest.raises(Exception, match="UNBOUND_SQL_PARAMETER"):
        B.Statement(spark, "select :x").run()
    assert spark.sql("select :x is null", args={"x": None}).first()[0]
