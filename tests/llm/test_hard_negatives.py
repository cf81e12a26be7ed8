import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import hard_negatives as H

SCHEMA = "vec_id long, label int, embedding array<float>, score double, kind string"


def brute(rows, anchor, low=80):
    good = [(v, l, [math.floor(256 * x) for x in e]) for v, l, e in rows if v is not None and l is not None and e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for a, la, ea in good:
        if not anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(ea, e, strict=True)), v, l) for v, l, e in good if v != a and len(e) == len(ea))
        for p, vp, _ in [x for x in scored if x[2] == la][:5]:
            hard = [(v, -s) for s, v, l in scored if l != la and low * -p <= 100 * -s <= 100 * -p]
            out += [(a, vp, k, v, -p, s) for k, (v, s) in enumerate(hard[:5], 1)]
    return sorted(out)


def got(spark, rows, every, **more):
    df = spark.createDataFrame([(*r, 0.5, "x") for r in rows], SCHEMA)
    return sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % every == 0, **more).collect())


def near(rnd, center):
    return [float(np.float32(x + rnd.gauss(0, 0.3))) for x in center]


@pytest.fixture(params=["true", "false"])
def coalesced(spark, request):
    """With and without partitions put together: a table of the tests is else all in one, wherever its rows were dealt."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", request.param)
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.mark.parametrize("group_rows", [7, 50, 8192])
def test_against_brute_force(spark, group_rows, coalesced):
    """Groups of rows near each other across labels, copies, ties, odd vectors and other lengths."""
    rnd = random.Random(5)
    centers = [[rnd.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    rows = [(k, rnd.randrange(4), near(rnd, rnd.choice(centers))) for k in range(300)]
    rows += [(300 + k, rnd.randrange(3), rows[rnd.randrange(30)][2]) for k in range(60)]
    rows += [(400 + k, k % 2, [1.0, 0.0]) for k in range(12)] + [(420, 1, []), (421, 0, []), (430, 0, []), (440, 1, [])]
    rows += [(500, None, [1.0] * 8), (501, 1, None), (502, 1, [None] + [1.0] * 7), (503, 1, [float("nan")] * 8), (510, 1, [float("inf")] * 8), (None, 1, [1.0] * 8), (520, 2, [0.0] * 8), (530, 2, [-1.0] * 8)]
    rnd.shuffle(rows)
    assert got(spark, rows, 10, group_rows=group_rows) == brute(rows, lambda v: v % 10 == 0)


def test_repeated_rows_each_count_and_anchors_are_one(spark):
    rows = [(10, 1, [1.0]), (10, 1, [1.0]), (3, 1, [1.0]), (4, 2, [1.0]), (4, 2, [1.0]), (5, 2, [0.9])]
    p, n = 256 * 256, 256 * math.floor(256 * float(np.float32(0.9)))
    assert got(spark, rows, 10) == [(10, 3, 1, 4, p, p), (10, 3, 2, 4, p, p), (10, 3, 3, 5, p, n)]


def test_huge_components_are_exact_up_to_64_bits(spark):
    a = np.array([[2.0**40, 3.0], [2.0**80, 1.0]])
    b = np.array([[2.0**20, 1.0], [1.0, -1.0]])
    assert H.scores(a, b).tolist() == [[2**60 + 3, 2**40 - 3], [H.MOST, H.MOST]]
    assert H.within(np.array([2**62, 1]), 2**62, 80, 100).tolist() == [True, False]
    assert len(got(spark, [(10, 1, [1e30]), (1, 1, [1e30]), (2, 2, [1e30])], 10)) == 1


def test_empty(spark):
    assert got(spark, [], 10) == []
    assert got(spark, [(1, 1, [1.0])], 10) == []
    with pytest.raises(ValueError):
        got(spark, [], 10, high=120)
