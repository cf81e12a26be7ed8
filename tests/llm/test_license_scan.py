import random

from graphloom.llm import license_scan as S


def brute(text, held=S.HELD):
    """Templates that any window of the operator's grid holds, by plain sets."""
    w = S.re.findall("[a-z0-9]+", (text or "").translate(str.maketrans(S.UPPER, S.LOWER)))
    s = [" ".join(w[k : k + S.SHINGLE]) for k in range(len(w) - S.SHINGLE + 1)]
    out = {}
    for x in S.classes(held):
        for a in range(0, len(s), x["stride"]):
            window = set(s[a : a + x["window"]])
            for name in x["names"]:
                own = set(S.shingles_of(S.TEMPLATES[name]))
                if 100 * len(own & window) >= held * len(own):
                    out[name] = max(out.get(name, 0), len(own & window) / len(own))
    return out


def test_against_plain_sets(spark):
    rnd = random.Random(2)
    fill = lambda n: " ".join(rnd.choice(["river", "software", "License", "of", "the", "stone", "x9"]) for _ in range(n))
    texts = [None, "", "license", "the quick brown fox", "GNU " * 3000]
    for t in S.TEMPLATES.values():
        words = t.split()
        texts += [t, t.upper(), f"{fill(37)} {t} {fill(11)}", " ".join(words[1:]), " ".join(words[: len(words) // 2])]
        for _ in range(4):
            w = list(words)
            w[rnd.randrange(len(w))] = "other"
            texts.append(f"{fill(rnd.randrange(90))}\n{' '.join(w)}\n{fill(5)}")
    texts += ["\n".join(S.TEMPLATES.values()), "É" + S.TEMPLATES["mit"], fill(5000) + " " + S.TEMPLATES["gpl-header"]]
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in enumerate(texts)], "doc_id long, text string, names string, most int")
    for r in S.digest(df).collect():
        want = brute(texts[r["doc_id"]])
        assert (r["n_licenses"], r["licenses"]) == (len(want), ",".join(sorted(want))), texts[r["doc_id"]]
        assert abs(r["held"] - max(want.values(), default=0)) < 1e-12


def test_a_whole_template_is_found_wherever_it_stands():
    for x in S.classes():
        for name in x["names"]:
            n = S.n_words(S.TEMPLATES[name]) - S.SHINGLE + 1
            for at in range(3 * x["stride"]):
                start = at // x["stride"] * x["stride"]
                assert start <= at and at + n <= start + x["window"], name
        assert (1 - min(S.needs(k) / (x["window"] + len(S.shingles_of(S.TEMPLATES[k])) - S.needs(k)) for k in x["names"])) ** x["bands"] <= 1 - S.CERTAINTY + 1e-12


def test_texts_without_an_anchor_can_t_match():
    words = set(S.anchors())
    for name, t in S.TEMPLATES.items():
        free = [s for s in S.shingles_of(t) if not words & set(s.split())]
        assert len(free) < S.needs(name), name


def test_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(1, S.TEMPLATES["mit"]), (1, S.TEMPLATES["mit"]), (None, S.TEMPLATES["isc"])], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["licenses"]) for r in S.digest(df).collect()) == [(0, "isc"), (1, "mit"), (1, "mit")]
    assert S.digest(df.limit(0)).count() == 0
