"""The inverted index against plain Python and against the scores that are read off the texts."""

import random
import re
from collections import Counter

import pytest

from graphloom.operators import search as N
from graphloom.operators import text_index as I


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(9)
    words = [f"w{k}" for k in range(40)]
    texts = [" ".join(rnd.choices(words, weights=range(40, 0, -1), k=rnd.randrange(1, 120))) for _ in range(300)]
    return [*((7 * k, t) for k, t in enumerate(texts)), (5000, None), (5001, ""), (5002, "W1, w2; w1-w2 w1"), (5003, "w1 " * 3000), (5004, "É\u00e9 w1")]


@pytest.fixture(scope="module")
def index(spark, rows, tmp_path_factory):
    return I.build(spark.createDataFrame(rows, "doc_id long, text string"), f"file://{tmp_path_factory.mktemp('index')}", block=50)


def test_scores_are_those_of_the_texts(spark, rows, index):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for terms in (["w1"], ["w39", "w2"], ["w38", "w0", "w38"], ["absent"]):
        want = sorted(map(tuple, N.bm25(docs, list(dict.fromkeys(terms))).collect()))
        assert sorted(map(tuple, I.bm25(index, terms).collect())) == want
        for k in (1, 7, 1000):
            assert [tuple(r) for r in I.bm25(index, terms, k).collect()] == sorted(want, key=lambda r: (-r[1], r[0]))[:k]


def test_phrases(rows, index):
    for phrase in (["w1"], ["w1", "w2"], ["w1", "w1"], ["w0", "w1", "w0"], ["absent", "w1"]):
        want = Counter()
        for i, t in rows:
            w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
            want[i] = sum(w[k : k + len(phrase)] == phrase for k in range(len(w) - len(phrase) + 1))
        assert {r["doc_id"]: r["times"] for r in I.phrase(index, phrase).collect()} == {i: n for i, n in want.items() if n}
    with pytest.raises(ValueError):
        I.phrase(index, [])


def test_lookups_prune_the_postings(index):
    plan = index.postings(["w1"])._jdf.queryExecution().toString()
    assert "EqualTo(term,w1)], ReadSchema" in plan


def test_odd_rows(spark, tmp_path):
    rows = [(None, "a"), (1, "a b"), (1, "b c"), (2, None)]
    index = I.build(spark.createDataFrame(rows, "doc_id long, text string"), f"file://{tmp_path}/odd")
    assert index.totals().first()["n"] == 2
    assert [tuple(r) for r in I.phrase(index, ["b", "b"]).collect()] == [(1, 1)]
    empty = I.build(spark.createDataFrame([], "doc_id long, text string"), f"file://{tmp_path}/none")
    assert I.bm25(empty, ["a"]).count() == 0 and I.bm25(empty, ["a"], 3).count() == 0 and I.phrase(empty, ["a"]).count() == 0


def test_a_build_shuffles_less_than_its_texts(spark, rows, tmp_path):
    def shuffled():
        stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
        return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))

    docs = spark.createDataFrame([(10_000 * r + i, t) for r in range(8) for i, t in rows], "doc_id long, text string")
    before = shuffled()
    index = I.build(docs, f"file://{tmp_path}/bytes")
    assert shuffled() - before < sum(len(t or "") for _, t in rows) * 8
    assert index.totals().first()["n"] == docs.select("doc_id").distinct().count()


def test_many_short_runs(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    index = I.build(docs, f"file://{tmp_path}/runs", block=50, run_words=100)
    want = sorted(map(tuple, N.bm25(docs, ["w1", "w39"]).collect()))
    assert sorted(map(tuple, I.bm25(index, ["w1", "w39"]).collect())) == want
    assert [tuple(r) for r in I.bm25(index, ["w1", "w39"], 5).collect()] == sorted(want, key=lambda r: (-r[1], r[0]))[:5]
    assert I.phrase(index, ["w1", "w1"]).where("doc_id = 5003").first()["times"] == 2999
    assert I.bm25(index, [""]).count() == 0 and I.phrase(index, [""]).count() == 0
