"""Chat formatting by a grammar that is read back and compared, in DataFrame functions only.

A turn is an opening mark, its text and a closing mark:

    user        [INST] text [/INST]
    assistant   <s>text</s>
    system      <<SYS>>, a line feed, text, a line feed, <</SYS>>
    other       [ROLE:name in hex]text[/ROLE]

A conversation is rendered with its texts as they are and parsed again. If the parser doesn't recover the same
roles and texts, the turns that fail on their own are escaped, and if that isn't enough all of them, until source
and parse are identical: a backslash is doubled, and one goes behind the first character of each mark, so no mark
is left in a text. The parser takes the least text up to a closing mark, allows no mark in it and nothing between
turns, and drops escapes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template.
USER, ASSISTANT, SYSTEM = ("[INST] ", " [/INST]"), ("<s>", "</s>"), ("<<SYS>>\n", "\n<</SYS>>\n")
OTHER = ("[ROLE:", "]", "[/ROLE]")
ROLES = {"user": USER, "assistant": ASSISTANT, "system": SYSTEM}

MARK = r"<s>|</s>|<<SYS>>|<</SYS>>|\[INST\]|\[/INST\]|\[ROLE:|\[/ROLE\]"
FIRST_OF_MARK = r"(<(?=/?s>|</?SYS>>)|\[(?=/?INST\]|ROLE:|/ROLE\]))"
TURN = r"(?s)(\[INST\] |<s>|<<SYS>>\n|\[ROLE:[0-9A-F]*\])(.*?)( \[/INST\]|</s>|\n<</SYS>>\n|\[/ROLE\])"


def opening(role: Column) -> Column:
    out = F.concat(F.lit(OTHER[0]), F.hex(F.encode(role, "UTF-8")), F.lit(OTHER[1]))
    for name, (mark, _) in ROLES.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def closing(role: Column) -> Column:
    out = F.lit(OTHER[2])
    for name, (_, mark) in ROLES.items():
        out = F.when(role == name, F.lit(mark)).otherwise(out)
    return out


def escaped(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), FIRST_OF_MARK, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _turn(role: Column, text: Column) -> Column:
    return F.concat(opening(role), text, closing(role))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: _turn(t["role"], t["text"])), "")


def parsed(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation; null if it isn't one."""
    parts = [F.regexp_extract_all(formatted, F.lit(TURN), F.lit(k)) for k in range(4)]

    def turn(x: Column) -> Column:
        role = F.decode(F.unhex(F.regexp_extract(x["1"], r"^\[ROLE:([0-9A-F]*)\]$", 1)), "UTF-8")
        for name, (mark, _) in ROLES.items():
            role = F.when(x["1"] == mark, F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), unescaped(x["2"]).alias("text"), ((closing(role) == x["3"]) & ~x["2"].rlike(MARK)).alias("good"))

    zipped = F.arrays_zip(*(p.alias(str(k)) for k, p in enumerate(parts)))
    turns = F.transform(zipped, turn)
    whole = (F.array_join(parts[0], "") == formatted) & F.forall(turns, lambda t: t["good"])
    return F.when(whole, F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))


def format_chats(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): one row for each conv_id of turns(conv_id, turn, role, text).

    loss holds the places (start, stop; code points, the end exclusive) of the assistant's texts in formatted. Turns
    go by turn, role and text, null turns first; equal rows are turns each. A null text or role counts as empty; a
    null conv_id is a conversation of its own. An empty table gives none. A conversation is one row, as its text is.
    """
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    source = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    chats = rows.groupBy("conv_id").agg(source.alias("source"))
    chats = chats.withColumn("written", F.col("source")).withColumn("formatted", _rendered(F.col("source")))

    def redone(chats: DataFrame, again) -> DataFrame:
        """Conversations that don't parse to their source, written anew."""
        same = F.coalesce(parsed(F.col("formatted")) == F.col("source"), F.lit(False))
        out = chats.withColumn("same", same)
        out = out.withColumn("written", F.when(F.col("same"), F.col("written")).otherwise(F.transform("source", again)))
        return out.withColumn("formatted", F.when(F.col("same"), F.col("formatted")).otherwise(_rendered(F.col("written")))).drop("same")

    def where_it_fails(t: Column) -> Column:
        own = F.coalesce(F.get(parsed(_turn(t["role"], t["text"])), F.lit(0))["text"] == t["text"], F.lit(False))
        return F.struct(t["role"].alias("role"), F.when(own, t["text"]).otherwise(escaped(t["text"])).alias("text"))

    chats = redone(chats, where_it_fails)
    chats = redone(chats, lambda t: F.struct(t["role"].alias("role"), escaped(t["text"]).alias("text")))
    checked = F.when(parsed(F.col("formatted")) == F.col("source"), F.col("formatted")).otherwise(F.raise_error(F.lit("a formatted conversation doesn't parse to its source")))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("out"))

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + F.char_length(opening(t["role"]))
        stop = start + F.char_length(t["text"])
        own = F.when(t["role"] == "assistant", F.array(F.struct(start.alias("start"), stop.alias("stop")))).otherwise(F.array().cast("array<struct<start:int,stop:int>>"))
        return F.struct((stop + F.char_length(closing(t["role"]))).alias("at"), F.concat(state["out"], own).alias("out"))

    return chats.select("conv_id", checked.alias("formatted"), F.aggregate("written", zero, step, lambda s: s["out"]).alias("loss"))


def digest(turns: DataFrame) -> DataFrame:
    """What the formatted conversations say when read back: counts and digests of turns and of the text under loss."""
    read = format_chats(turns).withColumn("turns", parsed(F.col("formatted")))
    under = F.array_join(F.transform("loss", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["stop"] - s["start"]))), "")
    read = read.withColumn("under", under)
    all_turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(all_turns, 256).alias("turns_sha256"),
        F.char_length("under").cast("long").alias("loss_chars"),
        F.sha2(F.col("under"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
