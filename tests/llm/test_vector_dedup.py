import numpy as np

from graphloom.llm import vector_dedup as D

from .conftest import least_reachable


def brute(rows, threshold=0.95):
    good = {i: np.array(v, float) for i, v in rows if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = sorted(good)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if len(good[a]) == len(good[b]) and good[a] @ good[b] / np.sqrt(good[a] @ good[a]) / np.sqrt(good[b] @ good[b]) >= threshold]
    n = dict.fromkeys((i for i, _ in rows), 0)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    root = least_reachable([i for i, _ in rows], links)
    return {i: (n[i], root[i], root[i] == i) for i, _ in rows}


def vectors(rng, blocks):
    rows, k = [], 0
    for size, noise in blocks:
        centre = rng.normal(size=16)
        for _ in range(size):
            rows.append((k, [float(x) for x in np.float32(centre + rng.normal(size=16) * noise)]))
            k += 1
    return rows


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 20)  # many buckets in blocks
    rows = vectors(np.random.default_rng(1), [(90, 0.05), (60, 0.17), (1, 0)] + [(1, 0)] * 80 + [(2, 0.1)] * 30)
    n = len(rows)
    rows += [(n + k, rows[0][1]) for k in range(40)] + [(n + 40, [2 * x for x in rows[0][1]])]
    rows += [(n + 50 + k, v) for k, v in enumerate([None, [], [0.0] * 16, [1.0] * 15 + [None], [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [3.0]])]
    df = spark.createDataFrame([(i, v, 1, "c") for i, v in rows], "vec_id long, embedding array<float>, label int, codes string").repartition(3)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in D.near_vectors(df).collect()}
    want = brute([(i, None if v is None else [None if x is None else np.float32(x).item() for x in v]) for i, v in rows])
    wrong = [i for i in want if got[i] != want[i]]
    assert len(got) == len(rows) and len(wrong) <= 2, [(i, got[i], want[i]) for i in wrong[:5]]


def test_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(4, [1.0, 0.0]), (4, [1.0, 0.0]), (9, [1.0, 0.01]), (None, [1.0, 0.0])], "vec_id long, embedding array<float>")
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in D.near_vectors(df).where("vec_id is not null").collect()))
    assert got == [(4, 2, 4), (4, 2, 4), (9, 2, 4)]
    assert D.near_vectors(df.limit(0)).count() == 0


def test_plan_misses_few():
    for n in (1, 100, 10**5, 10**7):
        bits, tables = D.plan(n)
        assert (1 - (1 - np.arccos(0.95) / np.pi) ** bits) ** tables <= D.MISSED and tables < 256
