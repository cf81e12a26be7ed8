import random

import pytest
from pyspark.sql import functions as F

from graphloom.operators import equality as E
from graphloom.operators import report as R
from graphloom.operators import search as N


def equal(spark, a, b):
    df = spark.range(1).select(a.alias("a"), b.alias("b"))
    return df.select(E.equal(df, "a", "b")).first()[0]


def struct(**v):
    return F.struct(*(F.lit(x).alias(k) for k, x in v.items()))


def test_equality(spark):
    arr = lambda *v: F.array(*map(F.lit, v))
    assert equal(spark, arr(1, 2), arr(1, 2)) and not equal(spark, arr(1, 2), arr(2, 1))
    assert equal(spark, struct(x=1, y="a"), struct(y="a", x=1)) and not equal(spark, struct(x=1), struct(z=1))
    m = lambda *kv: F.create_map(*map(F.lit, kv))
    assert equal(spark, m("a", 1, "b", 2), m("a", 1, "b", 2)) and not equal(spark, m("a", 1, "b", 2), m("b", 2, "a", 1))
    assert equal(spark, F.lit(b"ab"), F.lit(b"ab")) and not equal(spark, F.lit(b"ab"), F.lit(b"ac"))
    assert not equal(spark, F.lit(42).cast("long"), F.lit("42"))
    null = F.lit(None).cast("long")
    assert equal(spark, null, null) and not equal(spark, null, F.lit(1).cast("long"))


def test_distinct_and_hash_agree(spark):
    df = spark.createDataFrame([(1, [1, 2], {"k": 1}), (1, [1, 2], {"k": 1}), (1, [2, 1], {"k": 1}), (None, None, None)], "a int, b array<int>, c map<string,int>")
    assert E.distinct(df).count() == 3
    assert df.select(E.structural_hash(df)).distinct().count() == 3


def test_text(spark):
    df = spark.range(1).select(F.struct(F.lit(1).alias("a"), F.array(F.lit("x"), F.lit(None)).alias("b"), F.lit(b"abc").alias("c"), F.create_map(F.lit("k"), F.lit(2)).alias("d")).alias("p"))
    text = E.rendered(F.col("p"), df.schema["p"].dataType)
    assert df.select(text).first()[0] == "{a: 1, b: [x, null], c: Blob[3], d: {k: 2}}"
    assert df.select(E.rendered_node("P", F.col("p"), df.schema["p"].dataType)).first()[0].startswith("(:P {a: 1")
    assert df.select(E.rendered_rel("R", F.lit(None).cast("struct<a:int>"), df.select(F.lit(None).cast("struct<a:int>")).schema[0].dataType)).first()[0] == "[:R null]"


def test_latency_summary(spark):
    df = spark.createDataFrame([("a", x) for x in (4.0, 1.0, 3.0, 2.0)] + [("b", None), ("c", 7.0), ("c", None)], "g string, v double")
    got = {r["g"]: tuple(r)[1:] for r in R.latency_summary(df, ["g"], "v").collect()}
    assert got == {"a": (4, 3.0, 4.0, 4.0, 4.0, 2.5), "b": (0, 0.0, 0.0, 0.0, 0.0, 0.0), "c": (1, 7.0, 7.0, 7.0, 7.0, 7.0)}


def test_quantiles_of_any_doubles(spark, monkeypatch):
    """Against sorting: ties, all magnitudes, signs, infinities, neighbours, nulls, NaN, a null key; few parts a round."""
    rnd = random.Random(12)
    inf = float("inf")
    groups = {
        "ties": [rnd.choice([1.0, 2.0, 2.5]) for _ in range(500)],
        "wide": [rnd.choice([-1, 1]) * 10.0 ** rnd.uniform(-300, 300) for _ in range(400)],
        "far": [5e-324 * k for k in range(60)] + [1.7e308] * 30 + [-1.7e308],
        "near": [1 + 2**-52 * rnd.randrange(300) for _ in range(700)],
        "flat": [rnd.random() for _ in range(900)],
        "odd": [inf, -inf, 0.0, -0.0, 3.0, None, float("nan")],
        None: [float(k) for k in range(101)],
        "none": [None, float("nan")],
    }
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double")
    for parts in (4096, 5):
        monkeypatch.setattr(R, "PARTS", parts)
        got = {r["g"]: r for r in R.exact_quantiles(df, ["g"], "v", R.SHARES | {"p0": 0.0, "p100": 1.0}).collect()}
        assert set(got) == set(groups)
        for k, vs in groups.items():
            good = sorted(v for v in vs if v is not None and v == v)
            assert got[k]["n"] == len(good)
            for name, share in (R.SHARES | {"p0": 0.0, "p100": 1.0}).items():
                assert got[k][name] == (good[min(len(good) - 1, int(len(good) * share))] if good else None), (k, name)


def test_report_rules(spark):
    row = spark.range(1).select(
        R.verdict(F.lit(2.0), F.lit(2.0), F.lit(True), F.lit(1)), R.verdict(F.lit(9.9), F.lit(10.0), F.lit(False), F.lit(1)), R.verdict(F.lit(0.0), F.lit(1.0), F.lit(True), F.lit(0)),
        R.ratio(F.lit(3.0), F.lit(0.0)), R.rate(F.lit(10), F.lit(0)), R.rate(F.lit(10), F.lit(3)), R.scales(F.lit(1.6), F.lit(1.0)), R.scales(F.lit(1.5), F.lit(1.0)),
    ).first()
    assert tuple(row) == ("PASS", "FAIL", "not measured", 0.0, 0.0, 3.3, "yes", "no")
    notes = R.notes(spark.createDataFrame([("m", 1, ["a", "b"]), ("n", 1, [])], "model string, size int, notes array<string>"))
    assert notes.count() == 2


@pytest.mark.parametrize("group_rows", [7, 10_000])
def test_vector_top_k(spark, group_rows, monkeypatch):
    monkeypatch.setattr(N, "TILE_VECTORS", 16)
    rows = [(k, [float(k % 7), 1.0, float(k % 3)]) for k in range(60)] + [(100, None), (101, [0.0, 0.0, 0.0]), (102, [float("nan"), 1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in N.vector_top_k(df, df.where("vec_id % 20 = 0"), 3, group_rows).collect():
        got.setdefault(r["query_id"], []).append((r["place"], r["vec_id"], r["score"]))
    import math

    def cos(a, b):
        return round(sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b)), 9)

    for q in (0, 20, 40):
        best = sorted(((-cos(rows[q][1], v), k) for k, v in rows[:60] if k != q))[:3]
        assert [(k, s) for _, k, s in sorted(got[q])] == [(k, -s) for s, k in best]
    assert set(got) == {0, 20, 40}


def test_bm25_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert N.bm25(empty, ["a"]).count() == 0
    df = spark.createDataFrame([(1, "a b a"), (2, "b"), (3, None)], "doc_id long, text string")
    assert [r["doc_id"] for r in N.bm25(df, ["a"], 5).collect()] == [1]
