import math
import random
from collections import Counter

import pytest

from graphloom.llm import quality as Q

from .conftest import words


def stats(text):
    t, w = text or "", words(text)
    windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    covered = {k + d for k, x in enumerate(windows) if windows.count(x) > 1 for d in range(3)}
    lines, dup = [], 0
    for line in t.split("\n"):
        if words(line):
            dup += line in lines
            lines.append(line)
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def cases():
    rnd = random.Random(6)
    good = lambda: " ".join(rnd.choice(["the", "Élan", "of", "and", "river", "stone", "ñandú"]) + str(rnd.randrange(40)) for _ in range(80))
    junk = lambda: " ".join(rnd.choice(["buy", "now", "win"]) + str(rnd.randrange(40)) + "###" for _ in range(80))
    texts = [None, "", " \t\n", "a", "a a a a", "a b c a b c", "x\nx\n\n \n \nx", "é | <b>\né | <b>", "   ", "one two " * 3000]
    return texts + [good() for _ in range(30)] + [junk() for _ in range(30)] + ["l\n" * 70, "same line\nother line\n" * 2]


def test_counts_and_verdicts(spark):
    texts = cases()
    df = spark.createDataFrame([(k, t, True) for k, t in enumerate(texts)], "doc_id long, text string, trusted boolean").repartition(3)
    marks = [(k, 1) for k in range(10, 30)] + [(k, 0) for k in range(40, 60)] + [(11, 0), (None, 1), (500, 1)]
    got = {r["doc_id"]: r for r in Q.judged(df, spark.createDataFrame(marks, "doc_id long, quality int")).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        r = got[k]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == stats(t), t
        assert not (r["base_failed"] and r["kept"])
    assert all(got[k]["kept"] for k in range(10, 40)) and not any(got[k]["kept"] for k in range(40, 70))


def test_without_labels_the_base_rules_decide(spark):
    texts = cases()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r["kept"] == (not r["base_failed"]) for r in Q.digest(df, none).collect())
    assert Q.digest(df.limit(0), none).count() == 0
    assert Q.threshold([], 0.99) is None and Q.threshold([(-5, 0, 9), (1, 10, 0)], 0.99) == -2 and Q.threshold([(3, 5, 0), (4, 5, 0)], 0.9) == 3


def test_reruns_agree(spark, data):
    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    a, b = (Q.digest(d, labels) for d in (docs, docs.repartition(5)))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def ratios(texts, trusted, buckets):
    """Log ratio of each word and pair of words by plain counts; exact while no two of them share a bucket."""
    raw, target = Counter(), Counter()
    for k, t in enumerate(texts):
        raw.update(grams(t))
        if k in trusted:
            target.update(grams(t))
    p = lambda c, g: (c[g] + 1) / (c.total() + buckets)
    return {g: math.log(p(target, g) / p(raw, g)) for g in raw}


def grams(text):
    w = words(text)
    return [*w, *zip(w, w[1:], strict=False)]


def best_threshold(scores, trusted, others, keep):
    """Every step that a labelled text has, tried one by one."""
    seen = sorted({scores[k] for k in trusted | others})
    tried = []
    for n, s in enumerate(seen):
        lost = sum(scores[k] < s for k in trusted)
        if lost <= (1 - keep) * len(trusted):
            tried.append((-(1 - lost / len(trusted) + sum(scores[k] < s for k in others) / len(others)), n))
    n = min(tried)[1]
    return seen[n] if n == 0 else (seen[n - 1] + seen[n] + 1) // 2


@pytest.mark.parametrize("keep", [0.998, 0.8])
def test_scores_threshold_and_verdicts_by_plain_counts(spark, keep):
    rnd = random.Random(12)
    good, junk, buckets = [f"river{k}" for k in range(16)], [f"buy{k}" for k in range(12)], 1 << 22  # so many that no two of these n-grams share a bucket
    # the share of junk of trusted texts and of others overlaps, so a threshold loses some of either
    shares = [rnd.betavariate(2, 5) for _ in range(40)] + [rnd.betavariate(5, 2) for _ in range(40)] + [rnd.random() for _ in range(20)]
    texts = [" ".join(rnd.choice(junk if rnd.random() < s else good) for _ in range(rnd.randrange(50, 90))) for s in shares] + ["river1 river2", None]
    trusted, others = {*range(40), 100}, set(range(40, 80))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(k, int(k in trusted)) for k in trusted | others], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in Q.judged(df, labels, buckets, keep).collect()}
    ratio = ratios(texts, trusted, buckets)
    for k, t in enumerate(texts):
        g = grams(t)
        assert abs(got[k]["score"] - (sum(ratio[x] for x in g) / len(g) if g else 0)) <= 0.0011, k
    steps = {k: round(r["score"] * 1000) for k, r in got.items()}
    passes = {k for k, t in enumerate(texts) if not stats(t)[-1]}
    least = best_threshold(steps, trusted & passes, others & passes, keep)
    assert {round(r["threshold"] * 1000) for r in got.values()} == {least}
    assert {k for k, r in got.items() if r["kept"]} == {k for k in passes if steps[k] >= least}
    assert 10 < sum(r["kept"] for r in got.values()) < 95
