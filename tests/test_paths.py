"""Paths against a plain enumerator."""

import random
from collections import Counter

import pytest

from graphloom.operators import paths as G


def enumerate_paths(edges, low, high, mode):
    out = []
    by = {}
    for e in edges:
        by.setdefault(e[0], []).append(e)

    def go(nodes, rels):
        if low <= len(rels) <= high:
            out.append((tuple(nodes), tuple(rels)))
        if len(rels) == high:
            return
        for s, d, r in by.get(nodes[-1], []):
            if mode == "trail" and r in rels or mode == "acyclic" and d in nodes:
                continue
            go([*nodes, d], [*rels, r])

    for n in sorted({e[0] for e in edges}):
        go([n], [])
    return Counter(out)


@pytest.mark.parametrize("mode", ["walk", "trail", "acyclic"])
@pytest.mark.parametrize("seed", [1, 2])
def test_var_paths(spark, mode, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(7), rnd.randrange(7), k) for k in range(14)]
    df = spark.createDataFrame(edges, "src long, dst long, rid long")
    got = Counter((tuple(r["nodes"]), tuple(r["rels"])) for r in G.var_paths(df, 1, 3, mode, "rid").collect())
    assert got == enumerate_paths(edges, 1, 3, mode)


def test_chain_of_two_hops(spark):
    people = spark.createDataFrame([(1, "Ada"), (2, "Grace"), (3, "Alan")], "id long, name string")
    edges = spark.createDataFrame([(1, 2, 1990), (2, 3, 1995)], "src long, dst long, since long")
    start, end = spark.createDataFrame([(1,)], "id long"), spark.createDataFrame([(3,)], "id long")
    p = G.with_properties(G.var_paths(edges, 1, 3, starts=start, ends=end), people, "id", "name").collect()
    assert len(p) == 1 and p[0]["hops"] == 2
    assert [v["name"] for v in p[0]["node_values"]] == ["Ada", "Grace", "Alan"]
    assert [r["since"] for r in p[0]["rels"]] == [1990, 1995]
    one = G.var_paths(edges.where("src = 1"), 1, 3).collect()
    assert len(one) == 1 and len(one[0]["nodes"]) == 2 and len(one[0]["rels"]) == 1


def test_counts_agree_with_paths(spark):
    rnd = random.Random(5)
    edges = spark.createDataFrame([(rnd.randrange(6), rnd.randrange(6)) for _ in range(12)], "src long, dst long")
    walks = {(r["src"], r["dst"], r["hops"]): r["walks"] for r in G.walk_counts(edges, 3).collect()}
    df = G.var_paths(edges, 1, 3).groupBy("src", "dst", "hops").count()
    assert walks == {(r["src"], r["dst"], r["hops"]): r["count"] for r in df.collect()}


def test_reachability_ends_on_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "src long, dst long")
    got = {(r["src"], r["dst"]) for r in G.reachable(edges).collect()}
    assert got == {(a, b) for a in (1, 2, 3) for b in (1, 2, 3, 4)}
    only = G.reachable(edges, spark.createDataFrame([(3,)], "id long")).collect()
    assert {r["dst"] for r in only} == {1, 2, 3, 4}
    assert G.reachable(edges.limit(0)).count() == 0


def test_bounds_are_required(spark):
    edges = spark.createDataFrame([(1, 2)], "src long, dst long")
    for low, high in ((0, 2), (3, 2)):
        with pytest.raises(ValueError):
            G.var_paths(edges, low, high)
    with pytest.raises(ValueError):
        G.var_paths(edges, 1, 2, "other")


def test_depths_of_a_long_chain_and_of_what_is_no_forest(spark):
    nodes = spark.range(70).withColumnRenamed("id", "k")
    chain = [(k, k + 1) for k in range(60)] + [(65, 30)]
    got = {r["node"]: r["depth"] for r in G.depths(nodes, "k", spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert got == {k: max(0, 60 - k) if k <= 60 else 31 if k == 65 else 0 for k in range(70)}
    for bad in ([(0, 1), (0, 2)], [(0, 1), (1, 2), (2, 0)]):
        with pytest.raises(ValueError):
            G.depths(nodes, "k", spark.createDataFrame(bad, "src long, dst long")).count()


@pytest.mark.parametrize("mode", ["walk", "trail", "acyclic"])
def test_both_ends_pinned(spark, mode):
    """The same paths as all of them between these ends."""
    for seed in (1, 2, 3):
        rnd = random.Random(seed)
        edges = [(rnd.randrange(9), rnd.randrange(9), k) for k in range(20)]
        df = spark.createDataFrame(edges, "src long, dst long, rid long")
        starts, ends = (spark.createDataFrame([(k,) for k in rnd.sample(range(9), n)], "id long") for n in (3, 2))
        low = rnd.choice((1, 2, 3))
        got = Counter((tuple(r["nodes"]), tuple(r["rels"])) for r in G.var_paths(df, low, 3, mode, "rid", starts, ends).collect())
        at, to = ({r["id"] for r in x.collect()} for x in (starts, ends))
        assert got == Counter({k: n for k, n in enumerate_paths(edges, low, 3, mode).items() if k[0][0] in at and k[0][-1] in to})


def test_a_hub_costs_what_leads_through_it(spark):
    """0 -> hub -> 2,000 others, each with ten more; one of them leads to the end. Steps hold the prefixes of answers."""
    edges = [(0, 1)] + [(1, k) for k in range(2, 2002)] + [(k, 10_000 + 10 * k + j) for k in range(2, 2002) for j in range(10)] + [(77, 5)]
    df = spark.createDataFrame(edges, "src long, dst long")
    one = lambda k: spark.createDataFrame([(k,)], "id long")
    assert [x.count() for x in G.steps(df, 3, 3, starts=one(0), ends=one(5))] == [1, 1, 1]
    assert G.var_paths(df, 3, 3, starts=one(0), ends=one(5)).count() == 1


def closure(edges):
    by, out = {}, set()
    for a, b in edges:
        if a is not None and b is not None:
            by.setdefault(a, set()).add(b)
    for a in by:
        todo, seen = list(by[a]), set()
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += by.get(x, ())
        out |= {(a, x) for x in seen}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_closure_of_cyclic_graphs(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(25), rnd.randrange(25)) for _ in range(32)] + [(30, 31), (31, 32), (32, 30), (32, 33), (40, 40), (41, 42), (None, 1), (1, None)]
    df = spark.createDataFrame(edges, "src long, dst long")
    want = closure(edges)
    nodes = {x for e in edges if None not in e for x in e}
    got = {r["node"]: (r["component"], r["n"]) for r in G.reach_counts(df).collect()}
    assert got == {v: (min([v] + [w for x, w in want if x == v and (w, v) in want]), sum(x == v for x, _ in want)) for v in nodes}
    assert {tuple(r) for r in G.cyclic_reachable(df.where("src is not null and dst is not null")).collect()} == want


def test_a_ring_is_one_pair_of_components(spark):
    ring = spark.createDataFrame([(k, (k + 1) % 60) for k in range(60)], "src long, dst long")
    of = G.strong_components(ring)
    assert of.select("component", "size").distinct().collect() == [(0, 60)]
    assert G.condensed_closure(ring, of).count() == 1
    assert G.reach_counts(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_the_plan_of_a_spread_grows_with_its_steps(spark, monkeypatch):
    leaves, cut = [], G.cut

    def counted(df):
        leaves.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return cut(df)

    monkeypatch.setattr(G, "cut", counted)
    edges = spark.createDataFrame([(k, (k + 1) % 6) for k in range(6)] + [(7, 8), (8, 7), (0, 7), (9, 9), (3, 3)], "src long, dst long")
    found = {tuple(r) for r in G.strong_components(edges).collect()}
    assert found == {*((k, 0, 6) for k in range(6)), (7, 7, 2), (8, 7, 2), (9, 9, 1)}
    assert max(leaves) <= 3 * G.SPREAD_STEPS + 2
