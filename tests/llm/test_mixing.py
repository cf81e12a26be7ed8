import random

from graphloom.llm import mixing as X

from .conftest import words


def water(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while True:
        total = sum(w[s] for s in open_)
        above = [s for s in open_ if left * w[s] / total >= most * sizes[s]]
        if not above:
            return out | {s: left * w[s] / total for s in open_}
        for s in above:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in above)
        open_ -= set(above)
        if not open_:
            return out


def test_targets_and_takes(spark):
    rnd = random.Random(8)
    rows = []
    for k in range(3000):
        source = rnd.choice(["hot"] * 8 + ["a", "b", "Ä", "z1", None, "tiny"])
        rows.append((k, "w " * rnd.randrange(0, 60), source, 7, "x"))
    rows += [(3000 + k, t, "odd", 7, "x") for k, t in enumerate([None, "", "word " * 20_000, "a b"])] + [(5, "again", "hot", 7, "x"), (None, "no id", "a", 7, "x"), (4000, "", "empty", 7, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, target string").repartition(4)
    got = X.digest(df).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, t, s, *_ in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want = water(sizes)
    taken = {}
    mixed = X.mix(df).collect()
    for r in mixed:
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, want[r["source"]]) and r["source_size"] == sizes[r["source"]]
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] = taken.get(r["source"], 0) + r["copies"] * r["size"]
    for s in sizes:
        longest = max(len(words(t)) for _, t, x, *_ in rows if x == s)
        assert abs(taken[s] - want[s]) <= longest / 2 + 1, s
    again = X.digest(df.repartition(2))
    assert again.exceptAll(X.digest(df)).isEmpty()


def test_inclusion_goes_by_weight(spark):
    """Of each size class about its own share is taken: certain copies, and p of the documents once more."""
    rnd = random.Random(4)
    rows = [(k, "w " * rnd.choice([1, 3, 10, 40, 200]), "s") for k in range(8000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    for share in (0.4, 1.6):
        sizes = {}
        for _, t, _ in rows:
            sizes.setdefault(len(t) // 2, []).append(len(t) // 2)
        weight = {n: n.bit_length() for n in sizes}
        target, open_ = share * sum(map(sum, sizes.values())), dict(sizes)
        want = {}
        while open_:
            c = target / sum(weight[n] * sum(v) for n, v in open_.items())
            above = [n for n in open_ if c * weight[n] >= 2]
            if not above:
                want |= {n: c * weight[n] for n in open_}
                break
            top = max(above)
            want[top], target = 2.0, target - 2 * sum(open_.pop(top))
        got = {}
        for r in X.mix(df, (1,), share).collect():
            got.setdefault(r["size"], []).append(r["copies"])
        for n, copies in got.items():
            assert set(copies) <= {int(want[n]), int(want[n]) + 1}
            assert abs(sum(copies) / len(copies) - want[n]) < 0.06, (share, n)
        assert want[200] > 1.2 * want[1]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert X.digest(df).count() == 0
    blank = spark.createDataFrame([(1, None, None)], "doc_id long, text string, source string")
    assert [r["taken"] for r in X.digest(blank).collect()] == [0]
