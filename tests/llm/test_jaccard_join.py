import random

import numpy as np
import pyarrow as pa
import pytest

from graphloom.llm import jaccard_join as J
from graphloom.llm.components import components
from graphloom.llm.shingles import shingle_sets

from .conftest import jaccard_links, least_reachable, shingle_set


def brute(rows):
    sets = {i: shingle_set(t) for i, t in rows if i is not None}
    root = least_reachable(sets, jaccard_links(sets))
    return {i: (len(s), root[i]) for i, s in sets.items()}


def family(rnd, n, base, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def test_against_brute_force_with_odd_rows(spark):
    """Families near the threshold, small sets of all sizes, a common passage, copies, nulls, empty and long texts."""
    rnd = random.Random(7)
    word = lambda: f"w{rnd.randrange(5000)}"
    texts = [None, "", "  \n\t", "one", "ONE", "one two", "A b c d e", "a B c d e", "a b c d e f"]
    texts += family(rnd, 60, [word() for _ in range(150)], 8)
    texts += family(rnd, 40, [word() for _ in range(40)], 2)
    for n in range(5, 24):
        texts += family(rnd, 4, [word() for _ in range(n)], 1)
        base = [word() for _ in range(n)]
        texts += [" ".join(base[:k]) for k in range(max(5, n - 3), n + 1)]
    passage = [word() for _ in range(60)]
    texts += [" ".join([word() for _ in range(rnd.randrange(3, 40))] + passage) for _ in range(60)]
    texts += [" ".join(word() for _ in range(9000))] * 2 + ["same words here and there now"] * 30
    check(spark, texts, rnd.sample(range(len(texts)), len(texts)))


def check(spark, texts, ids):
    rows = list(zip(ids, texts, strict=True))
    random.Random(13).shuffle(rows)
    df = spark.createDataFrame([(i, t, "x", 1, 0) for i, t in rows], "doc_id long, text string, key string, n int, place int")
    got = J.jaccard_classes(df).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows)
    assert len(got) == len(rows)


def test_small_sets_link_whichever_has_the_larger_id(spark):
    """Pairs of 1 to 16 shingles that must link, or just must not, the smaller set first or second."""
    rnd = random.Random(17)
    texts = []
    for n in range(1, 17):
        for m in range(n, min(n + 4, 17) + 1):
            base = [f"w{rnd.randrange(10**6)}" for _ in range(m + 4)]
            texts += [" ".join(base[: n + 4]), " ".join(base)]
    for ids in (range(len(texts)), range(len(texts) - 1, -1, -1)):
        check(spark, texts, ids)


def test_lists_dealt_over_parts_lose_no_link(spark):
    """Each list has two sets at most, and the copies make the sketch deal it over many parts."""
    rnd = random.Random(11)
    texts = []
    for _ in range(40):
        base = [f"w{rnd.randrange(10**6)}" for _ in range(40)]
        texts += [" ".join(base)] * 12 + [" ".join([*base[:-1], "other"])]
    rows = list(enumerate(texts))
    for list_rows in (1, 5):
        got = J.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string"), list_rows=list_rows).collect()
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows)


def test_repeated_rows_and_rows_without_id(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (None, "z"), (9, "q r s t u v"), (7, "a b c d e f g")]
    got = sorted(((r["doc_id"], r["component_id"]) for r in J.jaccard_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == sorted([(5, 5), (5, 5), (None, 5), (None, None), (9, 9), (7, 7)], key=repr)


def test_empty_table(spark):
    out = J.jaccard_classes(spark.createDataFrame([], "doc_id long, text string"))
    assert out.columns == ["doc_id", "n_shingles", "component_id"] and out.count() == 0


def test_components_of_paths_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(100, 140)] + [(3, 1), (1, 3), (3, 3), (2, 1)] + [(500, k) for k in range(501, 540)] + [(None, 4)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(100, 141), 100), 1: 1, 2: 1, 3: 1, **dict.fromkeys(range(500, 540), 500)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_shingles_are_those_of_the_words():
    texts = [None, "", "a", "a b c d", "a b c d e a b c d e", "É é\tx\x0by\x0cz", "x" * 5000 + " y " * 6, "﻿a b c d e f"]
    for k, u in shingle_sets(pa.array(texts)):
        assert len(u) == len(shingle_set(texts[k])), texts[k]
    same = [u for _, u in shingle_sets(pa.array(["AbC d e f g", "q", "aBc  d\te\nf g"]))]
    assert np.array_equal(same[0], same[2])


@pytest.mark.parametrize("n", range(1, 40))
def test_prefixes_and_subsets_leave_no_link_out(n):
    for m in range(n, n * 100 // 80 + 1):
        c = J.needed(n, m, 80)
        assert 100 * c >= 80 * (n + m - c) and 100 * (c - 1) < 80 * (n + m - c + 1)
        assert n - c + 1 <= J.prefix(n, 80) and m - c + 1 <= J.prefix(m, 80)
        assert c in J.subset_sizes(n, 80, 99) and c in J.subset_sizes(m, 80, 99)
    assert 1 <= J.choose_boundary({n: 10}, 80) <= J.LARGEST_SMALL
