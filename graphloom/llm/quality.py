"""Quality rules: plain rules, and a hashed n-gram log-likelihood ratio of trusted texts over the raw corpus.

Words and pairs of words are hashed into buckets. Their counts over all documents, and over the trusted ones, give
two smoothed multinomials. A document's score is the mean over its n-grams of the log ratio of the two, and one
threshold, found from the labelled documents' scores, decides for every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, small, stored
from .shingles import mix, text_slices, word_hashes, words

BUCKETS = 1 << 16
CHUNK = 1 << 12
SMOOTHING = 1.0
#: Scores are compared in steps of this, and none lies beyond the limit: the threshold sees a bounded histogram.
STEP, LIMIT = 0.001, 16.0
#: Of the trusted documents, the share that the threshold keeps at least.
KEEP_TRUSTED = 0.998
LEAST_WORDS, MOST_REPEATED = 50, 50

_symbols = np.zeros(256, bool)
_symbols[[ord(c) for c in "#*$%&|<>"]] = True


def _grams(h: np.ndarray, first: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and of the pairs within a row (-1 for a pair across rows)."""
    one = (mix(h, 31) & np.uint64(buckets - 1)).astype(np.int64)
    two = np.full(len(h), -1, np.int64)
    if len(h) > 1:
        two[:-1] = (mix(h[:-1] * np.uint64(3) + mix(h[1:], 32), 33) & np.uint64(buckets - 1)).astype(np.int64)
    last = first[1:] - 1
    two[last[(last >= 0) & (first[1:] > first[:-1])]] = -1
    return one, two


def _count(buckets: int):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, buckets), np.int64)
        for batch in batches:
            trusted = np.asarray(batch.column(1).fill_null(False).cast(pa.int8())).astype(bool)
            for lo, hi, data, offsets in text_slices(batch.column(0)):
                starts, ends, first = words(data, offsets)
                one, two = _grams(word_hashes(data, starts, ends, lower=False), first, buckets)
                own = np.repeat(trusted[lo:hi], np.diff(first))
                for grams in (one, two):
                    ok = grams >= 0
                    counts[0] += np.bincount(grams[ok], minlength=buckets)
                    counts[1] += np.bincount(grams[ok & own], minlength=buckets)
        if counts.any():
            parts = counts.reshape(2, -1, min(CHUNK, buckets))
            n = parts.shape[1]
            yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), *(pa.array([parts[k, c].tobytes() for c in range(n)], pa.binary()) for k in (0, 1))], names=["chunk", "raw", "target"])

    return run


@freed
def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for chunk, *both in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            got = [np.frombuffer(x, np.int64) for x in both]
            total[chunk] = [a + b for a, b in zip(total[chunk], got, strict=True)] if chunk in total else got
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), *(pa.array([x[k].tobytes() for x in total.values()], pa.binary()) for k in (0, 1))], names=["chunk", "raw", "target"])


def _repeats(keys: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key of a row: whether the row has it more than once, and whether this is not its first place."""
    if not len(keys):
        return np.zeros(0, bool), np.zeros(0, bool)
    _, first, inverse, counts = np.unique(mix(keys ^ mix(row.astype(np.uint64), 41), 42), return_index=True, return_inverse=True, return_counts=True)
    return counts[inverse] > 1, first[inverse] != np.arange(len(keys))


def _line_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the lines between line feeds."""
    feeds = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], feeds + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], feeds]), kind="stable")
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _stats(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
    def per_row(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(flags)])
        return run[at[1:]] - run[at[:-1]]

    n = np.diff(first)
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = per_row(heads[ends] - heads[starts], first)
    row = np.repeat(np.arange(len(n)), n)
    windows = max(0, len(h) - 2)
    inside = row[:windows] == row[2:] if windows else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    again, _ = _repeats(mix(h[at], 51) * np.uint64(5) + mix(h[at + 1], 52) * np.uint64(7) + h[at + 2], row[at])
    covered = np.zeros(len(h), bool)
    for k in range(3):
        covered[at[again] + k] = True
    a, b, of = _line_bounds(data, offsets)
    real = np.searchsorted(starts, b) > np.searchsorted(starts, a)
    a, b, of = a[real], b[real], of[real]
    _, later = _repeats(word_hashes(data, a, b, lower=False), of)
    dup = np.bincount(of[later], minlength=len(n))
    return [n, chars, per_row(_symbols[data], offsets), dup, per_row(covered, first)]


def _measured(column: pa.Array, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The counts of _STATS, a row each, and the scores in steps."""
    cols, score = np.zeros((len(_STATS), len(column)), np.int64), np.zeros(len(column))
    for lo, hi, data, offsets in text_slices(column):
        starts, ends, first = words(data, offsets)
        h = word_hashes(data, starts, ends, lower=False)
        cols[:, lo:hi] = _stats(data, offsets, starts, ends, first, h)
        one, two = _grams(h, first, len(ratio))
        each = ratio[one] + np.where(two >= 0, ratio[two], 0)
        run_sum = np.concatenate([[0], np.cumsum(each)])
        n = np.diff(first)
        score[lo:hi] = (run_sum[first[1:]] - run_sum[first[:-1]]) / np.maximum(1, 2 * n - 1)
    return cols, np.rint(np.clip(score, -LIMIT, LIMIT) / STEP).astype(np.int32)


def _failed(n_words, n_repeat_words):
    """By the base rules; for columns and for arrays."""
    return (n_words < LEAST_WORDS) | (100 * n_repeat_words > MOST_REPEATED * n_words)


def _score(model):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols, at = _measured(batch.column(1), model.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, cols), pa.array(at)], names=["doc_id", *_STATS, "steps"])

    return run


def _keep(model, least: int | None, at: int):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols, steps = _measured(batch.column(at).cast(pa.string()), model.value)
            kept = ~_failed(cols[_STATS.index("n_words")], cols[_STATS.index("n_repeat_words")])
            yield batch.filter(pa.array(kept & (steps >= least) if least is not None else kept))

    return run


def _learned(docs: DataFrame, labels: DataFrame, buckets: int, keep_trusted: float) -> tuple:
    """(the broadcast log ratio of each bucket, the scored documents, the threshold in steps or None)."""
    spark = docs.sparkSession
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("_doc")).agg((F.max("quality") > 0).alias("trusted"))
    marks = stored(marks, "labels")
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    trusted = texts.join(small(marks.where("trusted")), F.col("doc_id") == F.col("_doc"), "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
    parts = stored(trusted.mapInArrow(_count(buckets), "chunk int, raw binary, target binary"), "counts")
    counts = np.zeros((2, buckets), np.int64)
    for chunk, *both in parts.repartition("chunk").mapInArrow(_add_up, "chunk int, raw binary, target binary").toLocalIterator():
        for k, x in enumerate(both):
            x = np.frombuffer(x, np.int64)
            counts[k, chunk * len(x) : (chunk + 1) * len(x)] = x
    p = [(c + SMOOTHING) / (c.sum() + SMOOTHING * buckets) for c in counts]
    fitted = bool(counts[1].any())
    model = spark.sparkContext.broadcast(np.log(p[1]) - np.log(p[0]) if fitted else np.zeros(buckets))
    scored = stored(texts.mapInArrow(_score(model), "doc_id long, " + ", ".join(f"{k} long" for k in _STATS) + ", steps int"), "scored")
    least = None
    if fitted:
        # labels meet the scores, which are small, not the texts
        sure = scored.where(~_failed(F.col("n_words"), F.col("n_repeat_words"))).select("doc_id", "steps").join(small(marks), F.col("doc_id") == F.col("_doc"))
        seen = sure.groupBy("steps").agg(F.sum(F.col("trusted").cast("long")).alias("good"), F.count("*").alias("all")).orderBy("steps").collect()
        least = threshold([(r["steps"], r["good"], r["all"] - r["good"]) for r in seen], keep_trusted)
    return model, scored, least


def judged(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, keep_trusted: float = KEEP_TRUSTED) -> DataFrame:
    """One row for each of docs: doc_id, the counts, base_failed, score, threshold and kept.

    Trusted texts are those with quality 1 in labels(doc_id, quality); the others with a label count against a
    threshold only. The threshold parts the two best (by the sum of the shares that it gets right, the lowest of
    equals) among those that keep the share keep_trusted of the trusted ones. Without trusted texts there is no
    model and the base rules decide alone; without others, the threshold keeps that share. A null or empty text has
    no word and fails the base rules. If a document has labels that differ, the best one counts; a null doc_id has
    no label. Repeated rows are judged alike. Other columns are not read.
    """
    model, scored, least = _learned(docs, labels, buckets, keep_trusted)
    model.destroy()
    failed = _failed(F.col("n_words"), F.col("n_repeat_words"))
    kept = ~failed & (F.col("steps") >= F.lit(least) if least is not None else F.lit(True))
    scale = lambda x: x / F.lit(round(1 / STEP))
    return scored.select("doc_id", *_STATS, failed.alias("base_failed"), scale(F.col("steps")).alias("score"), scale(F.lit(least).cast("int")).alias("threshold"), kept.alias("kept"))


def passing(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, keep_trusted: float = KEEP_TRUSTED) -> DataFrame:
    """The rows of docs, with all their columns, that judged keeps. Each row goes by its own text, whatever its doc_id;
    scoring it again is cheaper than a join of texts with verdicts."""
    model, _, least = _learned(docs, labels, buckets, keep_trusted)
    return docs.mapInArrow(_keep(model, least, docs.columns.index("text")), docs.schema)


def threshold(seen: list[tuple[int, int, int]], keep_trusted: float) -> int | None:
    """The lowest step to keep, from (step, trusted, others) in rising order: midway between the best step and the
    next lower one that is seen, so texts like the kept ones have some room below them."""
    good, bad = sum(x[1] for x in seen), sum(x[2] for x in seen)
    if not good:
        return None
    best, lost_good, lost_bad, lower = None, 0, 0, None
    for step, g, b in seen:
        if lost_good > (1 - keep_trusted) * good:
            break
        right = (good - lost_good) / good + (lost_bad / bad if bad else lost_good / good)
        if best is None or right > best[0] + 1e-12:
            best = (right, step if lower is None else (lower + step + 1) // 2)
        lost_good, lost_bad, lower = lost_good + g, lost_bad + b, step
    return best[1]


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judged(docs, labels).select("doc_id", *_STATS, "base_failed", "kept", "score", "threshold")
