import hashlib
import random

from pyspark.sql import functions as F

from graphloom.llm import chat_format as H


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def cases():
    rnd = random.Random(1)
    marks = ["<s>", "</s>", "[INST]", "[/INST]", " [/INST]", "<<SYS>>\n", "\n<</SYS>>\n", "[ROLE:", "[/ROLE]", "\\", "<", "[", "text", " ", "\n", "é", "\U0001f600", "<\\s>", "$1"]
    rows = [(1, 0, "user", None, 1), (1, 1, "assistant", "", 1), (2, 0, "assistant", "</s>", 1), (2, 1, None, "x", 1), (2, 2, "we[ird]é", "y", 1), (3, 5, "user", "same", 1), (3, 5, "user", "same", 1), (3, None, "system", "first", 1), (None, 0, "user", "no id", 1), (4, 0, "assistant", "z" * 300_000, 1)]
    for c in range(10, 90):
        for t in range(rnd.randrange(1, 6)):
            rows.append((c, t, rnd.choice(["user", "assistant", "system", "tool"]), "".join(rnd.choice(marks) for _ in range(rnd.randrange(8))), 1))
    return rows


def test_round_trip(spark):
    rows = cases()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int").repartition(3)
    chats = {}
    for c, t, role, text, _ in rows:
        chats.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    got = {r["conv_id"]: r for r in H.digest(df).collect()}
    assert set(got) == set(chats)
    for c, turns in chats.items():
        turns.sort()
        own = [t for *_, role, t in turns if role == "assistant"]
        r = got[c]
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == sha("".join(f"{role}\n{t}\n" for *_, role, t in turns))
        assert (r["loss_chars"], r["loss_sha256"]) == (len("".join(own)), sha("".join(own)))
    for r in H.format_chats(df).collect():
        assert len(r["formatted"]) == got[r["conv_id"]]["formatted_chars"]


def test_plain_text_stays_as_it_is(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 0, "user", "a [/INST] b")], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r["formatted"] for r in H.format_chats(df).collect()}
    assert got == {1: "[INST] hi [/INST]<s>yo</s>", 2: "[INST] a [\\/INST] b [/INST]"}


def test_the_parser_takes_nothing_else(spark):
    bad = ["[INST] a", "[INST] a</s>", "x[INST] a [/INST]", "[INST] a [/INST] ", "[INST] <s> [/INST]", "<s>a [INST]</s>"]
    df = spark.createDataFrame([(t,) for t in [*bad, "", "[INST] a [/INST]"]], "t string")
    assert [r[0] is None for r in df.select(H.parsed(F.col("t"))).collect()] == [True] * len(bad) + [False, False]


def test_empty(spark):
    assert H.digest(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
