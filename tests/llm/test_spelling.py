import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from graphloom.llm import spelling as S

from .conftest import LOWER


def counted(rows, drop=97):
    c = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % drop == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            c[run] += 1
    return {w: n for w, n in c.items() if len(w) >= 5 and n >= 3}


def apart_by_one(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(a) + 1 == len(b) and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(rows, drop=97):
    known = counted(rows, drop)
    near = {w: [v for v in known if apart_by_one(w, v)] for w in known}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-known[v], v), default=None)
        form[w] = best if best and known[best] >= 2 * known[w] else None
    out = []
    for w in known:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, known[w], len(near[w]), known[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def edited(rnd, w):
    k, c = rnd.randrange(len(w)), rnd.choice("abeé÷")
    return rnd.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]])


@pytest.fixture(scope="module")
def rows():
    """Words of 4 to 30 letters over few letters, with chains of edits, repeats and halves in common."""
    rnd = random.Random(3)
    base = ["".join(rnd.choice("abé") for _ in range(n)) for n in range(4, 31) for _ in range(4)] + ["aaaaa", "aaaaaa", "aaaaaaa", "Éabcd", "ÉABCD", "éabcd", "ab×cd"]
    base += [edited(rnd, w) for w in base for _ in range(3)]
    base += [edited(rnd, w) for w in base]
    texts = []
    for k in range(300):
        texts.append((k, rnd.choice([" ", ", ", "1", "_"]).join(rnd.choice(base[: 1 + rnd.randrange(len(base))]) for _ in range(60))))
    long_text = " ".join(rnd.choice(base) for _ in range(30000))
    return [*texts, (300, None), (301, ""), (302, "123 ..."), (303, long_text), (304, "x" * 5000 + " " + "x" * 5001), (304, "x" * 5000), (304, "X" * 5000), (None, "abcde abcdé"), (None, None), texts[7], texts[7]]


@pytest.mark.parametrize("block_words", [4, 1024])
def test_against_brute_force(spark, rows, block_words):
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(5)
    got = sorted((tuple(r) for r in S.variants(df, block_words=block_words).collect()), key=repr)
    want = brute(rows)
    assert got == want and len(want) > 300 and len({r[2] for r in want}) < len(want)


def test_left_out_code_points(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for drop in (1, 5):
        assert {r["word"]: r["n"] for r in S.words(df, drop=drop).collect()} == counted(rows, drop)


def test_hot_group(spark):
    """All words share a half, so one group holds them and is dealt over many tiles."""
    ws = [f"prefix{chr(97 + a)}{chr(97 + b)}{chr(97 + c)}" for a in range(8) for b in range(8) for c in range(8)]
    known = spark.createDataFrame([(w, 3 + len(set(w[6:]))) for w in ws], "word string, n long")
    got = {r["word"]: r["n_near"] for r in S.near_words(known, 50).collect()}
    assert got == dict.fromkeys(ws, 21)


def test_empty(spark):
    for rows in ([], [(1, None), (2, "one two")]):
        out = S.variants(spark.createDataFrame(rows, "doc_id long, text string"))
        assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"] and out.count() == 0
    with pytest.raises(ValueError):
        S.variants(spark.range(1).select(F.col("id").alias("doc_id"), F.lit("a").alias("text")), ratio=1)
