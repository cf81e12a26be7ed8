"""Secret scans by patterns and by sliding-window entropy, in DataFrame functions only.

Patterns give the base spans. The entropy method looks at candidate strings, long runs of key characters. A window
slides over each one; the counts of its characters change by the one that enters and the one that leaves, and with
them the sum of c * log2(c), from which the Shannon entropy follows. The least sum of all windows decides, against
a limit for the string's character class. Strings of the allow list and strings that a base span overlaps add nothing.

Places are code points, the end exclusive. A null text counts as empty; an empty text has no span.
"""

from __future__ import annotations

from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")

# The patterns of the base spans. Runs are maximal, so a least length in the pattern drops the same ones.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"

#: A candidate string, the window, and the least entropy in bits of a window that counts, by character class:
#: hex digits alone; letters and joints without a digit; all else.
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
LEAST_BITS = {"hex": 3.0, "letters": 4.25, "mixed": 3.6}
#: Strings that look random and are known not to be secrets: names of examples, runs of the alphabet, UUIDs.
ALLOWED = r"(?i)example|sample|placeholder|changeme|dummy|x{8,}|0123456789|abcdefgh|^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"

#: c * log2(c) in millionths, as whole numbers: sums of them are exact in any order.
TERMS = [round(c * log2(c) * 1e6) if c else 0 for c in range(WINDOW + 1)]
MOST_SUM = {k: round(WINDOW * (log2(WINDOW) - bits) * 1e6) for k, bits in LEAST_BITS.items()}

_SPAN = "array<struct<start:int,rank:int,stop:int>>"
_STRING = "array<struct<start:int,stop:int,text:string>>"


#: Rows of a running result that are made in one go.
BLOCK = 128


def _bound(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(rows: Column, kind: str, zero: Column, step) -> Column:
    """What step(state, row) -> (state, out) gives for each row in turn, as an array of `kind`.

    An aggregate copies what it has so far at every step, so the states at the heads of blocks come first, and then
    each block by itself: for n rows n * BLOCK / 2 copies of a row and (n / BLOCK)^2 / 2 of a state.
    """

    def heads(blocks: Column) -> Column:
        none = F.struct(zero.alias("state"), F.filter(F.array(zero), lambda x: F.lit(False)).alias("all"))

        def add(x: Column, block: Column) -> Column:
            return F.struct(F.aggregate(block, x["state"], lambda s, row: step(s, row)[0]).alias("state"), F.concat(x["all"], F.array(x["state"])).alias("all"))

        return F.aggregate(blocks, none, add, lambda x: x["all"])

    def one(block: Column, head: Column) -> Column:
        def add(x: Column, row: Column) -> Column:
            state, out = step(x["state"], row)
            return F.struct(state.alias("state"), F.concat(x["out"], F.array(out)).alias("out"))

        return F.aggregate(block, F.struct(head.alias("state"), F.array().cast(f"array<{kind}>").alias("out")), add, lambda x: x["out"])

    def split(rows: Column) -> Column:
        last = F.floor((F.size(rows) - 1) / BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.slice(rows, k * BLOCK + 1, F.lit(BLOCK)))

    return _bound(_bound(rows, split), lambda blocks: F.flatten(F.zip_with(blocks, heads(blocks), one)))


def _placed(text: Column, found: Column, pattern: str) -> Column:
    """The matches with their places: what lies between them comes from splitting at the same pattern."""
    pairs = F.zip_with(found, F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), lambda m, gap: F.struct(m.alias("m"), F.char_length(gap).alias("gap"), F.char_length(m).alias("n")))

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + x["gap"]
        return start + x["n"], F.struct(start.alias("start"), (start + x["n"]).alias("stop"), x["m"].alias("text"))

    return F.when(F.size(found) > 0, _running(pairs, "struct<start:int,stop:int,text:string>", F.lit(0), step)).otherwise(F.array().cast(_STRING))


def _apart(strings: Column, base: Column) -> Column:
    """The strings that no base span overlaps: both in one row by their starts, once forward with how far base spans
    have reached, and once backward with where the next one starts."""
    marked = F.concat(
        F.transform(strings, lambda x: F.struct(x["start"].alias("start"), F.lit(1).alias("own"), x["stop"].alias("stop"), x["text"].alias("text"))),
        F.transform(base, lambda x: F.struct(x["start"].alias("start"), F.lit(0).alias("own"), x["stop"].alias("stop"), F.lit(None).cast("string").alias("text"))),
    )
    kind = "struct<start:int,own:int,stop:int,text:string>"

    def kept(x: Column, good: Column) -> Column:
        return F.struct(x["start"].alias("start"), F.when((x["own"] == 1) & ~good, F.lit(-1)).otherwise(x["own"]).alias("own"), x["stop"].alias("stop"), x["text"].alias("text"))

    def forward(reach: Column, x: Column) -> tuple[Column, Column]:
        return F.when(x["own"] == 0, F.greatest(reach, x["stop"])).otherwise(reach), kept(x, reach <= x["start"])

    def backward(next_: Column, x: Column) -> tuple[Column, Column]:
        return F.when(x["own"] == 0, x["start"]).otherwise(next_), kept(x, next_ >= x["stop"])

    once = _running(F.array_sort(marked), kind, F.lit(0), forward)
    twice = F.reverse(_running(F.reverse(once), kind, F.lit(2**31 - 1), backward))
    free = F.transform(F.filter(twice, lambda x: x["own"] == 1), lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["text"].alias("text")))
    return F.when((F.size(strings) > 0) & (F.size(base) > 0), free).otherwise(strings)


def least_sum(text: Column) -> Column:
    """The least sum of c * log2(c), in millionths, over all windows of an ASCII string of at least WINDOW characters."""
    codes = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), F.ascii)
    terms = F.array(*map(F.lit, TERMS))
    zero = F.struct(F.array_repeat(F.lit(0), 128).alias("counts"), F.lit(0).alias("sum"), F.lit(2**31 - 1).alias("least"))

    def step(state: Column, i: Column, codes: Column) -> Column:
        x, y = F.get(codes, i), F.coalesce(F.get(codes, i - WINDOW), F.lit(-1))
        counts = state["counts"]
        into, out = F.get(counts, x), F.coalesce(F.get(counts, y), F.lit(0))
        change = F.when(x == y, F.lit(0)).otherwise(F.get(terms, into + 1) - F.get(terms, into) + F.when(y < 0, F.lit(0)).otherwise(F.get(terms, out - 1) - F.get(terms, out)))
        total = state["sum"] + change
        moved = F.transform(counts, lambda c, k: c + F.when(k == x, F.lit(1)).otherwise(F.lit(0)) - F.when(k == y, F.lit(1)).otherwise(F.lit(0)))
        return F.struct(moved.alias("counts"), total.alias("sum"), F.when(i >= WINDOW - 1, F.least(state["least"], total)).otherwise(state["least"]).alias("least"))

    return _bound(codes, lambda a: F.aggregate(F.sequence(F.lit(0), F.size(a) - 1), zero, lambda s, i: step(s, i, a), lambda s: s["least"]))


def _random(text: Column) -> Column:
    limit = F.when(text.rlike("^[0-9a-fA-F]+$"), F.lit(MOST_SUM["hex"])).when(~text.rlike("[0-9]"), F.lit(MOST_SUM["letters"])).otherwise(F.lit(MOST_SUM["mixed"]))
    return ~text.rlike(ALLOWED) & (least_sum(text) <= limit)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with a column spans of (start, rank of the kind in KINDS, stop), ordered by start and kind."""
    names = [f"_secret_{k}" for k in KINDS]
    patterns = dict(zip(names, (ASSIGN, ACCESS, HEX, CANDIDATE), strict=True))
    whole = F.coalesce(F.col(text), F.lit(""))
    found = docs.withColumns({k: F.regexp_extract_all(whole, F.lit(p), F.lit(0)) for k, p in patterns.items()})
    placed = found.withColumns({k: _placed(whole, F.col(k), p) for k, p in patterns.items()})
    good = F.filter(names[0], lambda x: F.char_length(F.regexp_extract(x["text"], ASSIGN, 2)) >= ASSIGN_LEAST)

    def spans(strings: Column, rank: int) -> Column:
        return F.transform(strings, lambda x: F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), x["stop"].alias("stop")))

    based = placed.withColumn("_secret_base", F.concat(spans(good, 0), spans(F.col(names[1]), 1), spans(F.col(names[2]), 2)))
    based = based.withColumn(names[3], _apart(F.col(names[3]), F.col("_secret_base")))
    free = F.filter(names[3], lambda x: _random(x["text"]))
    ordered = F.array_sort(F.concat("_secret_base", spans(free, 3)))
    return based.withColumn("spans", F.coalesce(ordered, F.array().cast(_SPAN))).drop(*names, "_secret_base")


def joined(spans: Column) -> Column:
    """kind:start:stop of the spans in a row, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["stop"])), ",")


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each stretch that spans cover replaced by the mark.

    Pieces are cut from the text as four bytes a code point, so each one costs its own length only.
    """
    def step(at: Column, s: Column) -> tuple[Column, Column]:
        return F.greatest(at, s["stop"]), F.struct(at.alias("start"), s["start"].alias("stop"))

    gaps = F.filter(_running(spans, "struct<start:int,stop:int>", F.lit(0), step), lambda g: (g["stop"] >= g["start"]))
    end = F.array_max(F.transform(spans, lambda s: s["stop"]))

    def cut(wide: Column) -> Column:
        pieces = F.transform(gaps, lambda g: F.decode(F.substring(wide, 4 * g["start"] + 1, 4 * (g["stop"] - g["start"])), "UTF-32"))
        return F.array_join(F.concat(pieces, F.array(F.decode(F.substring(wide, 4 * end + 1, F.length(wide)), "UTF-32"))), mark)

    return F.when(F.size(spans) == 0, text).otherwise(_bound(F.encode(text, "UTF-32"), cut))


def of_kind(rank: int):
    return lambda r: r == rank


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans): one row for each of docs."""
    base = F.filter("spans", lambda s: s["rank"] < 3)
    counts = [F.size(F.filter(F.transform("spans", lambda s: s["rank"]), of_kind(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(3)]
    return scan(docs.select("doc_id", "text")).select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
