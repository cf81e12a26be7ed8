import hashlib
import random
import re
from math import log2

from pyspark.sql import functions as F

from graphloom.llm import secret_scan as S

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_spans(t):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def spans(t):
    base = base_spans(t)
    out = list(base)
    for m in re.finditer(S.CANDIDATE, t):
        x = m[0]
        if re.search(S.ALLOWED, x) or any(a < m.end() and m.start() < b for a, _, b in base):
            continue
        kind = "hex" if re.fullmatch("[0-9a-fA-F]+", x) else "mixed" if re.search("[0-9]", x) else "letters"
        windows = [x[k : k + S.WINDOW] for k in range(len(x) - S.WINDOW + 1)]
        if max(-sum(w.count(c) / S.WINDOW * log2(w.count(c) / S.WINDOW) for c in set(w)) for w in windows) >= S.LEAST_BITS[kind] - 1e-6:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def text_of(s):
    return ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in s)


def cases():
    rnd = random.Random(3)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    key = lambda n, a=b64: "".join(rnd.choice(a) for _ in range(n))
    out = [None, "", " ", "password=abc", "secret=token:abcdefgh", 'TOKEN = "abc123"', "api_key: 'x.y-z=q'", "apikey==abcdef", "é password=hunter22 ü", "paſſword=abcdefg"]
    out += ["AKIA" + "Z" * 15, "AKIA" + "Z" * 16, "xAKIAAKIA" + "Q" * 20, "0" * 23, "0" * 24, "A" + "f" * 30 + "g", "deadbeef" * 9]
    out += [f"\U0001f600 {key(40)} tail", key(300), "EXAMPLE" + key(40), "a" * 60, "x" * 30 + key(20), "donaudampfschifffahrtsgesellschaft", "0123456789" + key(20), f"token={key(30)} {key(30)}"]
    out += [" ".join(f"{key(rnd.randrange(1, 30))} token={key(rnd.randrange(1, 9))}" for _ in range(40)), "word " * 30000 + "secret=abcdef12"]
    out += [key(rnd.randrange(18, 40), "0123456789abcdefABCDEF") for _ in range(20)]
    return out


def test_against_python(spark):
    texts = cases()
    df = spark.createDataFrame([(k, t, "s", [1]) for k, t in enumerate(texts)], "doc_id long, text string, spans string, _x array<int>")
    for r in S.digest(df).collect():
        t = texts[r["doc_id"]] or ""
        assert r["spans"] == text_of(spans(t)), t[:200]
        base = base_spans(t)
        assert r["base_sha256"] == hashlib.sha256(text_of(base).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == n for _, k, _ in base) for n in range(3))


def test_redaction(spark):
    texts = cases()
    df = S.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", S.redacted(F.col("text"), F.col("spans")).alias("r"))
    for r in df.collect():
        t, at, out = texts[r["doc_id"]], 0, ""
        if t is None:
            assert r["r"] is None
            continue
        for a, _, b in spans(t):
            if a >= at:
                out += t[at:a] + "[SECRET]"
            at = max(at, b)
        assert r["r"] == out + t[at:]


def test_empty_table(spark):
    assert S.digest(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_many_keys_in_one_text(spark):
    """More matches than a block holds, and time that doesn't grow with their square."""
    import time

    rnd = random.Random(6)
    words = ["".join(rnd.choice("0123456789abcdef") for _ in range(32)) + rnd.choice(["", "", "Q", "token=abcdef"]) for _ in range(8_000)]
    took = {}
    for n in (500, 2_000, 8_000):
        t = " ".join(words[:n])
        df = S.scan(spark.createDataFrame([(1, t)], "doc_id long, text string")).select(S.joined(F.col("spans")).alias("s"), S.redacted(F.col("text"), F.col("spans")).alias("r"))
        df.collect()
        began = time.perf_counter()
        r = df.first()
        took[n] = time.perf_counter() - began
        assert r["r"].count("[SECRET]") >= n
        if n == 500:
            assert r["s"] == text_of(spans(t))
    assert took[8_000] < 6 * took[2_000] + 1, took
