import hashlib
import random
from collections import Counter

import pytest

from graphloom.llm import repeats as R


def brute(rows, window):
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k : k + window] for _, b in texts for k in range(len(b) - window + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - window + 1):
            if seen[b[k : k + window]] > 1:
                gone[k : k + window] = b"\1" * window
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows, window, gram):
    df = spark.createDataFrame([(*r, "p", 0) for r in rows], "doc_id long, text string, p string, lo int").repartition(3)
    out = []
    for r in R.without_repeats(df, window, gram).collect():
        kept = bytes(r["kept"])
        assert r["n_bytes"] == len(kept) + sum(s["end"] - s["start"] for s in r["spans"])
        out.append((r["doc_id"], r["n_bytes"], r["n_bytes"] - len(kept), len(r["spans"]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, words=3000):
    rnd = random.Random(seed)
    some = lambda n: " ".join(f"w{rnd.randrange(words)}é"[: rnd.randrange(2, 8)] for _ in range(n))
    passages = [some(rnd.randrange(60, 200)) for _ in range(6)]
    texts = [some(rnd.randrange(5, 300)) for _ in range(40)]
    texts += [some(rnd.randrange(100)) + p[rnd.randrange(30) :] + some(rnd.randrange(100)) for p in passages for _ in range(3)]
    for t in [some(400) for _ in range(4)]:  # near copies
        for _ in range(3):
            b = list(t)
            for _ in range(rnd.randrange(4)):
                b[rnd.randrange(len(b))] = "#"
            texts.append("".join(b))
    texts += [texts[0]] * 3 + [None, "", "a", passages[0] * 2, passages[1][:399], passages[2] + passages[3], passages[3] + passages[2]]
    return texts


@pytest.mark.parametrize(("window", "gram"), [(400, 100), (60, 20), (50, 50)])
def test_against_brute_force(spark, window, gram):
    texts = corpus(window)
    rows = list(zip(random.Random(1).sample(range(1000), len(texts)), texts, strict=True))
    want = brute(rows, window)
    assert got(spark, rows, window, gram) == want and sum(r[2] for r in want) > 10_000


def test_windows_that_are_just_long_enough(spark):
    """Common strings of 399, 400 and 401 bytes at all kinds of places, touching runs, periods and runs of one character."""
    rnd = random.Random(2)
    own = lambda n: "".join(rnd.choice("abcdefgh") for _ in range(n))
    rows = []
    for k, n in enumerate((398, 399, 400, 401, 450, 800, 1201)):
        s = own(n)
        rows += [(10 * k, own(7 * k) + s + own(3)), (10 * k + 1, s), (10 * k + 2, own(500) + s)]
    rows += [(100, "x" * 399), (101, "y" * 400), (102, "z" * 401), (103, "ab" * 600), (104, (own(37)) * 20), (105, "é" * 300 + "e")]
    assert got(spark, rows, 400, 100) == brute(rows, 400)


def test_parts_of_long_texts(spark):
    """A repeat across the ends of parts, a long run of one character, and one long text twice with other beginnings."""
    rnd = random.Random(4)
    long_text = "".join(rnd.choice("abcdefghij ") for _ in range(700_000))
    rows = [(1, long_text), (2, "other beginning " + long_text[:600_000]), (3, long_text[R.PART - 300 : R.PART + 300]), (4, "q" * 600_000)]
    out = {r[0]: r for r in got(spark, rows, 400, 100)}
    assert [out[k][2] for k in (1, 2, 3, 4)] == [600_000, 600_000, 600, 600_000]
    assert [out[k][3] for k in (1, 2, 3, 4)] == [1, 1, 1, 1]


def test_rows_without_id_and_shared_ids(spark):
    t = "".join(random.Random(6).choice("abcdefgh") for _ in range(500))
    rows = [(None, t), (None, None), (5, t), (5, "short"), (5, "short")]
    assert got(spark, rows, 400, 100) == brute(rows, 400)


def test_empty(spark):
    assert got(spark, [], 400, 100) == []
    out = R.digest(spark.createDataFrame([(1, None)], "doc_id long, text string")).first()
    assert tuple(out) == (1, 0, 0, 0, hashlib.sha256(b"").hexdigest())
    with pytest.raises(ValueError):
        got(spark, [], 10, 20)
