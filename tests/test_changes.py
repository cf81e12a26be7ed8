import random

import pytest
from pyspark.sql import functions as F

from graphloom.operators import mutate as U
from graphloom.sources.graph import Graph, KeyViolation
from graphloom.streaming.upserts import AttributeTable, run_upserts


@pytest.fixture()
def people(spark):
    return spark.createDataFrame([(1, "Ada"), (2, "Grace")], "id long, name string")


def test_insert(spark, people):
    assert U.insert_nodes(people, spark.createDataFrame([(3, "Alan")], "id long, name string"), "id").count() == 3
    for bad in ([(2, "x")], [(5, "x"), (5, "y")], [(None, "x")]):
        with pytest.raises(KeyViolation):
            U.insert_nodes(people, spark.createDataFrame(bad, "id long, name string"), "id")
    rels = spark.createDataFrame([(1, 2)], "src long, dst long")
    assert U.insert_edges(rels, spark.createDataFrame([(2, 1), (2, 9)], "src long, dst long"), people, "id", people, "id").count() == 2


def test_update_and_delete(spark, people):
    news = spark.createDataFrame([(1, None)], "id long, name string")
    assert {r["id"]: r["name"] for r in U.update_scalar(people, "id", "name", news).collect()} == {1: None, 2: "Grace"}
    m = spark.createDataFrame([(1, {"a": "1"}), (2, {"a": "1"})], "id long, m map<string,string>")
    up = spark.createDataFrame([(1, "9")], "id long, value string")
    assert {r["id"]: r["m"] for r in U.update_map_key(m, "id", "m", "a", up).collect()} == {1: {"a": "9"}, 2: {"a": "1"}}
    assert {r["id"]: r["m"] for r in U.update_map_key(m, "id", "m", "b", up).collect()}[1] == {"a": "1", "b": "9"}
    assert U.delete_nodes(people, "id", news.select("id")).count() == 1


def test_all_or_nothing(spark, people):
    g = Graph(spark).add_nodes("P", people, "id").add_rels("R", spark.createDataFrame([(1, 2)], "src long, dst long"), "P", "P")
    new = U.apply_changes(g, U.Changes(nodes={"P": spark.createDataFrame([(3, "Alan")], "id long, name string")}, rels={"R": spark.createDataFrame([(2, 3)], "src long, dst long")}))
    assert new.rel("R").count() == 2 and g.rel("R").count() == 1
    with pytest.raises(KeyViolation):
        U.apply_changes(g, U.Changes(rels={"R": spark.createDataFrame([(2, 9)], "src long, dst long")}))
    with pytest.raises(KeyViolation):
        U.apply_changes(g, U.Changes(nodes={"X": people}))
    gone = U.apply_changes(g, U.Changes(deletes={"P": spark.createDataFrame([(2,)], "id long")}))
    assert gone.node("P").count() == 1 and gone.rel("R").count() == 0


def test_changes_are_checked_against_what_they_touch(spark, people):
    """An untouched table isn't read at all: this one fails when it is."""
    poison = spark.range(1).select(F.raise_error(F.lit("read")).cast("long").alias("src"), F.lit(1).cast("long").alias("dst"))
    g = Graph(spark).add_nodes("P", people, "id").add_nodes("Q", spark.createDataFrame([(1,), (2,)], "id long"), "id").add_rels("R", spark.createDataFrame([(1, 2)], "src long, dst long"), "P", "P").add_rels("Other", poison, "Q", "Q")
    one = lambda *rows: spark.createDataFrame(list(rows), "id long, name string")
    edge = lambda *rows: spark.createDataFrame(list(rows), "src long, dst long")
    gone = {"P": spark.createDataFrame([(2,)], "id long")}
    assert U.apply_changes(g, U.Changes(nodes={"P": one((2, "again"))}, rels={"R": edge((1, 2))}, deletes=gone)).node("P").count() == 2
    for bad in (U.Changes(nodes={"P": one((2, "taken"))}), U.Changes(nodes={"P": one((3, "x"), (3, "y"))}), U.Changes(nodes={"P": one((None, "x"))}), U.Changes(rels={"R": edge((1, 2))}, deletes=gone), U.Changes(rels={"R": edge((None, 1))})):
        with pytest.raises(KeyViolation):
            U.apply_changes(g, bad)
    with pytest.raises(Exception, match="read"):
        U.apply_changes(g, U.Changes(nodes={"P": one((3, "x"))}), whole=True)


LOG = "o long, k string, v string, ts long, seq long"


def test_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    """Six batches in two runs; a reader opened between them keeps its state; a replay changes nothing."""
    rnd = random.Random(8)
    rows = [(rnd.randrange(20), rnd.choice("ab"), f"v{k}", rnd.randrange(30), k) for k in range(300)]
    table = AttributeTable(spark, f"file://{tmp_path}/table", LOG, ["o", "k"], "v", ["ts", "seq"])
    assert table.read().count() == 0
    batch = lambda some: U.latest(spark.createDataFrame(some, LOG), ["o", "k"], "v", ["ts", "seq"])
    run = lambda: run_upserts(spark.readStream.schema(LOG).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log")), table, f"file://{tmp_path}/checkpoint").awaitTermination()
    between = None
    for part in (rows[:150], rows[150:]):
        spark.createDataFrame(part, LOG).repartition(3).write.mode("append").parquet(str(tmp_path / "log"))
        run()
        between = between or table.read()
    assert table.finished() == [0, 1, 2, 3, 4, 5]
    same = lambda x, y: sorted(map(tuple, x.collect())) == sorted(map(tuple, y.collect()))
    assert same(table.read(), batch(rows)) and same(between, batch(rows[:150]))
    table.apply(spark.createDataFrame([(1, "a", "other", 99, 99)], LOG), 4)
    assert same(table.read(), batch(rows))


def test_a_batch_that_broke_off_is_not_seen(spark, tmp_path):
    table = AttributeTable(spark, f"file://{tmp_path}/t", LOG, ["o", "k"], "v", ["ts", "seq"])
    table.apply(spark.createDataFrame([(1, "a", "new", 10, 1), (2, "a", "x", 1, 2)], LOG), 0)
    half = spark.createDataFrame([(1, "a", "half", 20, 3)], LOG)
    half.write.parquet(f"file://{tmp_path}/t/batch=1")
    assert {r["o"]: r["v"] for r in table.read().collect()} == {1: "new", 2: "x"}
    table.apply(spark.createDataFrame([(1, "a", "late", 5, 3), (1, "a", "tie", 10, 2)], LOG), 1)
    assert {r["o"]: r["v"] for r in table.read().collect()} == {1: "tie", 2: "x"}


def test_latest_of_random_logs(spark):
    rnd = random.Random(4)
    rows = [(rnd.randrange(5), rnd.randrange(100), rnd.randrange(8), k) for k in range(200)]
    df = spark.createDataFrame(rows, "o long, v long, ts long, seq long")
    best = {}
    for o, v, ts, seq in rows:
        best[o] = max(best.get(o, (-1, -1, -1)), (ts, seq, v))
    assert {r["o"]: (r["ts"], r["seq"], r["v"]) for r in U.latest(df, ["o"], "v", ["ts", "seq"]).collect()} == best
