import math
import re
import struct
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

from graphloom.llm import language_id as L


def test_accuracy_on_held_out_rows(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    got = L.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and len(r["text"]) > 40]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.95


def test_odd_rows(spark):
    rows = [(k, "the thing was of the and that with from", "en", 1.0) for k in range(12)] + [(k, "der die das und nicht ist mit ein auch", "de", 1.0) for k in range(12, 24)]
    rows += [(k, "le la les des une pour avec dans que est", "fr", 1.0) for k in range(24, 36)]
    rows += [(100, None, "en", 1.0), (101, "", "en", 1.0), (102, "123 !!", "en", 1.0), (103, "und die der " * 50_000, None, 1.0), (None, "avec les une", None, 1.0), (0, "the thing was of the and that with from", "en", 1.0)]
    got = [tuple(r) for r in L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")).collect()]
    assert len(got) == len(rows)
    by = {r[0]: r for r in got}
    assert all(by[k][2:] == ("und", 0.0) for k in (100, 101, 102))
    assert by[103][2] == "de" and by[None][2] == "fr" and by[5][2] == "en" and by[15][2] == "de"


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "the", None)], "doc_id long, text string, lang string")
    assert [r["lang_pred"] for r in L.identify(df).collect()] == ["und"]
    assert L.identify(df.limit(0)).count() == 0


def test_families_and_duels():
    assert L.family("en") == L.family("de") == "germanic" and L.family("pt-BR") == "romance" and L.family("zz") is None
    assert L.families(["en", "zz", "zy"]) == {"en": "germanic", "zz": "own:zz", "zy": "own:zy"}
    many = [f"q{k}" for k in range(20)] + [f"Z{k}" for k in range(20)]
    assert set(L.families([*many, "en"]).values()) == {"other:q", "other:z", "germanic"}
    assert len(L.duels(many)) == 1 + 2 * 190
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(c, 0.3, (40, 5)) for c in (-1, 1)]).astype(np.float32)
    w = L.svm(x, np.repeat([-1.0, 1.0], 40))
    assert ((x @ w[:-1] + w[-1] > 0) == np.repeat([False, True], 40)).all()


def test_every_language_is_learned(spark):
    """More languages than any fixed number would do for; each has a word of its own."""
    codes = [f"{c}-{k}" for c in ("de", "fr", "pl", "hi", "tr", "fi", "ar") for k in range(30)]
    letters = "bcdfghjklmnpqrstvwxz"
    word = lambda k: "".join(letters[(k // 20**n + 7 * n * k) % 20] for n in range(4))
    rows = [(k * 10 + n, " ".join([word(k)] * 12), lang) for k, lang in enumerate(codes) for n in range(10)]
    got = L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)).collect()
    assert len(got) == len(rows) and {r["lang_pred"] for r in got} == set(codes)


def test_more_than_the_model_may_hold_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(L, "MODEL_BYTES", 10_000)
    rows = [(k, f"word{'abc'[k % 3]} again", ("en", "de", "fr")[k % 3]) for k in range(30)]
    with pytest.raises(ValueError, match="MODEL_BYTES"):
        L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def plain_vector(text):
    """Counter of hashed n-grams, square roots, length 1, as 32-bit floats."""
    data = bytes(x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x >= 128 else 32 for x in text.encode())
    data = data[:1] + re.sub(b" +", b" ", data[1:]) if data[:1] != b" " else re.sub(b" +", b" ", data)
    places = Counter()
    for n in (1, 2, 3):
        for k in range(len(data) - n + 1):
            gram = np.array([int.from_bytes(data[k : k + n], "big")], np.uint64)
            places[int(L.mix(gram, 70 + n)[0]) % L.SIZE] += 1
    norm = math.sqrt(sum(places.values())) or 1.0
    return {k: float(np.float32(math.sqrt(v) / norm)) for k, v in places.items()}


def plain_svm(xs, ys):
    share = {s: 0.5 / sum(y == s for y in ys) for s in set(ys)}
    w, bias, alpha, rng = defaultdict(float), 0.0, [0.0] * len(xs), np.random.default_rng(3)
    slack = [1 / (2 * L.PENALTY * len(xs) * share[y]) for y in ys]
    for _ in range(L.EPOCHS):
        for k in rng.permutation(len(xs)):
            x, y = xs[k], ys[k]
            margin = sum(v * w[i] for i, v in x.items()) + bias
            new = max(0.0, alpha[k] - (y * margin - 1 + slack[k] * alpha[k]) / (sum(v * v for v in x.values()) + 1 + slack[k]))
            for i, v in x.items():
                w[i] += (new - alpha[k]) * y * v
            bias += (new - alpha[k]) * y
            alpha[k] = new
    return w, bias


def plain_choice(x, names, fitted):
    won, margin, sure = Counter(), Counter(), dict.fromkeys(names, 1.0)
    for a, b in combinations(names, 2):
        w, bias = fitted[a, b]
        d = sum(v * w[i] for i, v in x.items()) + bias
        p = 1 / (1 + math.exp(-2 * max(-20, min(20, d))))
        won[b if d > 0 else a] += 1
        margin[b] += d
        margin[a] -= d
        sure[a], sure[b] = min(sure[a], 1 - p), min(sure[b], p)
    best = max(names, key=lambda n: (won[n], margin[n]))
    return best, sure[best]


@pytest.mark.parametrize("language_rows", [L.LANGUAGE_ROWS, 25])
def test_against_plain_python(spark, language_rows):
    """Sample, vectors, duels, votes and scores, each done again in plain Python. With 25, the sample is a part."""
    rng = np.random.default_rng(5)
    alphabet = {"en": "etaoinshr", "de": "enisratdüß", "sv": "enrtasiläöå", "fr": "esaitnrulé", "es": "eaosrnidñ", "ru": "оеаинтсрв", "xx": "zqxjkvwy"}
    rows = []
    for k in range(350):
        lang = list(alphabet)[k % 7]
        text = " ".join("".join(rng.choice(list(alphabet[lang]), 1 + rng.integers(7))) for _ in range(1 + rng.integers(9)))
        rows.append((k, [text, text.upper() + " 7!", " " + text + "\n"][k % 3], None if k % 11 == 0 else lang))
    rows += [(400, None, "en"), (401, "42 -", "en"), (402, "", None)]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, _, _ in rows}
    usable = [r for r in rows if not held[r[0]] and r[2] and r[1] and any(c.isalpha() for c in r[1])]
    counts, learned = Counter(r[2] for r in usable), []
    each = max(L.LEAST_ROWS, min(language_rows, L.SAMPLE_ROWS // len(counts)))
    for i, text, lang in usable:
        x = {k: float(np.float16(v)) for k, v in plain_vector(text).items()}
        h = xxhash.xxh64_intdigest(struct.pack("<q", i), 42)
        if h % 2**30 < int(min(1.0, each / counts[lang]) * 2**30):
            learned.append((lang, np.array([x.get(k, 0.0) for k in range(L.SIZE)], np.float16).tobytes(), x))
    assert len(learned) == len(usable) if language_rows > 100 else len(learned) < len(usable)
    learned.sort(key=lambda r: r[:2])
    of = {"en": "germanic", "de": "germanic", "sv": "germanic", "fr": "romance", "es": "romance", "ru": "slavic", "xx": "own:xx"}
    duel = lambda side, a, b: plain_svm([r[2] for r in learned if side(r[0]) in (a, b)], [1.0 if side(r[0]) == b else -1.0 for r in learned if side(r[0]) in (a, b)])
    names = sorted(set(of.values()))
    groups = {f: sorted(k for k in of if of[k] == f) for f in names}
    fitted = {(a, b): duel(of.get, a, b) for a, b in combinations(names, 2)}
    fitted |= {(a, b): duel(str, a, b) for v in groups.values() for a, b in combinations(v, 2)}
    want = {}
    for i, text, _ in rows:
        want[i] = ("und", 0.0)
        if text and any(c.isalpha() for c in text):
            x = plain_vector(text)
            f, sure = plain_choice(x, names, fitted)
            lang, own = plain_choice(x, groups[f], fitted)
            want[i] = (lang, sure * own)
    got = L.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5), language_rows=language_rows).collect()
    assert len(got) == len(rows)
    for r in got:
        lang, score = want[r["doc_id"]]
        assert r["held_out"] == held[r["doc_id"]] and r["lang_pred"] == lang and abs(r["score"] - score) < 1e-4, (r, want[r["doc_id"]])
