"""The file of vectors by cells against the search that scores every pair."""

import numpy as np
import pytest

from graphloom.operators import search as N
from graphloom.operators import vector_index as I


def rows_of(df):
    return sorted((r["query_id"], r["place"], r["vec_id"], r["score"]) for r in df.collect())


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 12))
    rows = [(k, [float(x) for x in centres[k % 30] + rng.normal(size=12) * (0.1 + k % 3)]) for k in range(900)]
    rows += [(1000 + k, rows[0][1]) for k in range(40)]  # ties beyond k
    rows += [(2000 + k, v) for k, v in enumerate([None, [], [0.0] * 12, [1.0] * 11 + [None], [float("nan")] * 12, [float("inf")] + [1.0] * 11])]
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, cell string")


def test_exact_search_gives_all_rows(spark, vectors, tmp_path):
    index = I.build(vectors, f"file://{tmp_path}/v", cells=25)
    assert index.vectors().count() == 940 and 1 < index.cells().count() <= 25
    queries = vectors.where("vec_id % 9 = 0")
    want = rows_of(N.vector_top_k(vectors, queries, 7))
    for probes, group_rows in ((1, 10), (4, 10_000)):
        assert rows_of(I.top_k(index, queries, 7, probes, group_rows=group_rows)) == want
    assert rows_of(I.top_k(index, queries, 2_000, 1)) == rows_of(N.vector_top_k(vectors, queries, 2_000))


def test_groups_meet_however_partitions_are_dealt(spark, vectors):
    queries = vectors.where("vec_id % 9 = 0")
    want = rows_of(N.vector_top_k(vectors, queries, 7))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert rows_of(N.vector_top_k(vectors, queries, 7, group_rows=200)) == want
        assert rows_of(N.vector_top_k(vectors, queries, 7, group_rows=40)) == want
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_recall_of_the_nearest_cells(spark, data, tmp_path):
    vectors = spark.read.parquet(f"{data}/embeddings.parquet")
    index = I.build(vectors, f"file://{tmp_path}/v", cells=16)
    queries = vectors.where("vec_id % 20 = 0")
    probes = I.probes_for(index)
    assert 1 <= probes <= 16
    want = {(q, v) for q, _, v, _ in rows_of(N.vector_top_k(vectors, queries, 10))}
    got = rows_of(I.top_k(index, queries, 10, probes, exact=False))
    assert len({(q, v) for q, _, v, _ in got} & want) >= 0.9 * len(want)


def test_odd_tables(spark, tmp_path):
    schema = "vec_id long, embedding array<double>"
    empty = I.build(spark.createDataFrame([], schema), f"file://{tmp_path}/none")
    some = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0])], schema)
    assert I.top_k(empty, some).count() == 0
    same = I.build(some, f"file://{tmp_path}/same")
    assert rows_of(I.top_k(same, some, 3)) == [(1, 1, 2, 1.0), (2, 1, 1, 1.0)]
    opposite = I.build(spark.createDataFrame([(1, [1.0, 0.0]), (2, [-1.0, 0.0]), (3, [-1.0, 0.0])], schema), f"file://{tmp_path}/opposite", cells=2)
    assert rows_of(I.top_k(opposite, some, 3, 1)) == [(1, 1, 2, -1.0), (1, 2, 3, -1.0), (2, 1, 1, 1.0), (2, 2, 3, -1.0)]
