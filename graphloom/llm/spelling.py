"""Spelling variants: words that one inserted, deleted or replaced code point tells apart, by dense prefix-suffix tiling.

Two words, the longer one of L code points, are one edit apart exactly when their common prefix and suffix reach
L - 1 together. Then the first L // 2 code points agree, or the last L - L // 2 do, so every word meets only those that
share either half with it. Words of such a group are dealt into blocks of bounded size, and every two blocks of a group
meet as matrices of padded code points, aligned left for prefixes and right for suffixes. A pair counts where its
prefix is long enough, or else where its suffix is, so once. A tile returns a row for each word, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, stored

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Of runs whose checksum this number divides, one code point is left out.
DROP = 97
#: Words and code points of a block at most, and words of two blocks compared at once.
BLOCK_WORDS, BLOCK_CELLS, TILE = 1024, 1 << 20, 256


def words(docs: DataFrame, least_length: int = 5, least_count: int = 3, drop: int = DROP) -> DataFrame:
    """(word, n) of docs(doc_id, text): runs of letters in lower case, some with a code point left out."""
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("d"), F.explode(F.regexp_extract_all(F.translate(F.col("text").cast("string"), UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("r"))
    h = F.crc32(F.concat("d", F.lit(":"), "r"))
    runs = runs.select("r", h.alias("h"))
    at = (F.col("h") % F.char_length("r")).cast("int")
    word = F.when(F.col("h") % drop == 0, F.concat(F.substring("r", F.lit(1), at), F.substring("r", at + 2, F.char_length("r")))).otherwise(F.col("r"))
    counted = runs.select(word.alias("word")).where(F.char_length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= least_count)


def _common(a: np.ndarray, b: np.ndarray, same: np.ndarray) -> np.ndarray:
    """How many columns from the first on agree, for each row of a and of b of a pair that is the same so far."""
    total, alive = np.zeros(same.shape, np.int32), same.copy()
    for k in range(a.shape[1]):
        alive &= a[:, k, None] == b[None, :, k]
        if not alive.any():
            break
        total += alive
    return total


def _tile(length: int, by_prefix: bool, tile: np.ndarray, block: np.ndarray, word: list[str], n: np.ndarray) -> Iterator[tuple[str, int, int, int, str]]:
    """(word, its n, near words, the largest n of them, the first such word) of words that have near ones here.

    tile numbers are sorted; words meet within a tile, those with a block number only if it is another one.
    """
    left = np.array(word, f"<U{length}").view(np.uint32).reshape(len(word), length)
    size = np.array([len(w) for w in word])
    right = np.where((size == length)[:, None], left, np.roll(left, 1, 1))
    long = np.flatnonzero(size == length)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for x in range(0, len(long), TILE):
        a = long[x : x + TILE]
        lo, hi = np.searchsorted(tile, [tile[a[0]], tile[a[-1]] + 1])
        for y in range(lo, hi, TILE):
            b = np.arange(y, min(y + TILE, hi))
            same = (tile[a][:, None] == tile[b][None, :]) & ((size[b] < length)[None, :] | (b[None, :] > a[:, None]))
            same &= (block[a] < 0)[:, None] | (block[a][:, None] != block[b][None, :])
            if not same.any():
                continue
            prefix = _common(left[a], left[b], same)
            if not by_prefix:
                same &= prefix < length // 2
            suffix = _common(right[a][:, ::-1], right[b][:, ::-1], same)
            i, j = np.nonzero(same & (prefix + suffix >= length - 1))
            found += [(a[i], b[j]), (b[j], a[i])]
    if not found:
        return
    own, other = (np.concatenate(x) for x in zip(*found, strict=True))
    names = np.array(word, f"<U{length}")
    order = np.lexsort((names[other], -n[other], own))
    own, other = own[order], other[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]][: len(own)])
    for k, many in zip(first, np.diff(np.r_[first, len(own)]), strict=True):
        yield word[own[k]], int(n[own[k]]), int(many), int(n[other[k]]), word[other[k]]


@freed
def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (length, side, key, tile): as many whole tiles at once as make a matrix of bounded size."""
    names = ["word", "n", "near", "best_n", "best"]
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())

    def done(shape, rows):
        tile, block, word, n = zip(*rows, strict=True)
        out = list(_tile(*shape, np.array(tile), np.array(block), list(word), np.array(n)))
        columns = list(zip(*out, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    shape, at, tile, rows = None, None, 0, []
    for batch in batches:
        for length, side, key, i, j, block, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (length, side, key, i, j) != at:
                full = len(rows) >= BLOCK_WORDS or len(rows) * length >= BLOCK_CELLS
                if shape != (length, side) or full:
                    if rows:
                        yield done(shape, rows)
                    shape, rows, tile = (length, side), [], -1
                at, tile = (length, side, key, i, j), tile + 1
            rows.append((tile, block if i < j else -1, word, n))
    if rows:
        yield done(shape, rows)


def near_words(known: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) of the words of known(word, n) that have near ones: how many, and the one of them
    of largest n, ties to the first in code-point order. Words must be distinct, of two code points at least."""
    size = F.char_length("word")
    meets = []
    for more in (0, 1):  # as one of the longer words, or the shorter one of a pair
        half = F.floor((size + more) / 2).cast("int")
        meets += [F.struct((size + more).alias("length"), F.lit(True).alias("side"), F.substring("word", F.lit(1), half).alias("key")), F.struct((size + more).alias("length"), F.lit(False).alias("side"), F.right("word", size + more - half).alias("key"))]
    rows = known.select("word", "n", F.explode(F.array(*meets)).alias("m")).select("word", "n", "m.*")
    groups = rows.groupBy(F.col("length").alias("l"), F.col("side").alias("s"), F.col("key").alias("k")).agg(F.count("*").alias("c"), F.max(size == F.col("length")).alias("any")).where("c > 1 and any")
    most = F.greatest(F.lit(2), F.least(F.lit(block_words), (BLOCK_CELLS / F.col("l")).cast("int")))
    groups = groups.select("l", "s", "k", F.ceil(F.col("c") / most).cast("int").alias("blocks"))
    joined = rows.join(groups, (F.col("length") == F.col("l")) & (F.col("side") == F.col("s")) & (F.col("key") == F.col("k")))
    dealt = joined.withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")).withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    place = [F.col("length"), F.col("side"), F.col("key"), F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j")]
    tiles = dealt.select(*place, "block", "word", "n").repartition("length", "side", "key", "i", "j").sortWithinPartitions("length", "side", "key", "i", "j")
    met = tiles.mapInArrow(_tiles, "word string, n long, near long, best_n long, best string")
    out = met.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("down"), "best")).alias("b"))
    return out.select("word", "n_near", (-F.col("b.down")).alias("best_n"), F.col("b.best").alias("best"))


def variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, ratio: int = 2, drop: int = DROP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of docs(doc_id, text, ...).

    Words are maximal runs of ASCII letters and of U+00C0 to U+00FF with A-Z lower-cased, of least_length code points
    and least_count occurrences; where drop divides the unsigned crc32 h of "<doc_id>:<run>", the code point h % length
    of the run is left out. n_near counts words one edit away. form is the one of them of largest n, ties to the first
    in code-point order, if its n is at least ratio times the word's own; root is where forms end, the word itself if
    it has none. As each form is at least twice as frequent, they end after log2 of the largest n.

    A null or empty text has no words; a null doc_id counts as an empty one. Repeated rows count as often as they are
    there. Other columns aren't read; an empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("forms must be more frequent, or they needn't end")
    known = stored(words(docs, least_length, least_count, drop), "words")
    near = near_words(known, block_words).withColumnRenamed("word", "w")
    named = known.join(near, F.col("word") == F.col("w"), "left")
    has = F.col("best_n") >= ratio * F.col("n")
    named = stored(named.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n")), "forms")
    # each round doubles how far a word has come
    up = stored(named.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = up.select(F.col("word").alias("_w"), F.col("root").alias("_on"))
        step = stored(up.join(ahead, F.col("root") == F.col("_w"), "left").select("word", F.coalesce("_on", "root").alias("root"), F.col("_on").isNotNull().alias("moved")), "roots")
        up = step.select("word", "root")
        if step.where("moved").isEmpty():
            break
    roots = up.select(F.col("word").alias("_w"), "root")
    return named.join(roots, F.col("word") == F.col("_w"), "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
