"""Hard negatives by a secondary sort: an anchor's rows come in descending score, positives open windows, negatives close them.

Vectors and anchors are dealt into groups of bounded size, and every two groups meet in one task, which scores them by
matrix products. The first round keeps of each meeting what can be among an anchor's positives; the second one what can be among the
first negatives of a positive's window. What is kept goes through one shuffle by anchor, sorted within its partitions by
the key (anchor, descending score, kind, id), and is read as a stream that holds the open windows of one anchor.
Nothing that could be returned is left out: the best of all rows are among the best of the groups.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import freed, stored

#: Components and rows of a group at most, and anchors scored at once.
GROUP_CELLS, GROUP_ROWS, TILE = 1 << 20, 8192, 64
#: A score beyond a 64-bit integer counts as the largest one.
MOST = 2**63 - 1
SCALE = 256
_as_int = np.frompyfunc(int, 1, 1)


def _lengths(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix of whole numbers) of the rows of each vector length."""
    e = rows.column("embedding").combine_chunks()
    if isinstance(e, pa.ChunkedArray):
        e = pa.concat_arrays(e.chunks) if e.num_chunks else pa.array([], pa.list_(pa.float64()))
    starts = np.asarray(e.offsets)
    flat = np.floor(SCALE * np.asarray(e.values, np.float64))
    size = np.diff(starts)
    for n in np.unique(size):
        at = np.flatnonzero(size == n)
        yield at, flat[starts[at][:, None] + np.arange(n)]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers; beyond 64 bits they stay at the largest number of 64 bits."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), np.int64)
    if a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max()) < 2**53:
        return (a @ b.T).astype(np.int64)
    return np.clip(_as_int(a) @ _as_int(b).T, -MOST, MOST).astype(np.int64)


def within(negative, positive: int, low: int, high: int):
    """low * positive <= 100 * negative <= high * positive, without overflow."""
    if len(negative) and (max(abs(int(negative.max())), abs(int(negative.min())), abs(positive)) >= 2**55):
        negative = negative.astype(object)
    return (low * positive <= 100 * negative) & (100 * negative <= high * positive)


def _meet(pick):
    """Of a group of anchors and one of rows: (anchor_id, kind, vec_id, score) of what pick keeps for each anchor."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], []]
        if len(anchors) and len(rows):
            a_id, a_label = (np.asarray(anchors.column(c)) for c in ("vec_id", "label"))
            bounds = anchors.column("bounds").to_pylist() if "bounds" in anchors.column_names else [()] * len(a_id)
            r_id, r_label = (np.asarray(rows.column(c)) for c in ("vec_id", "label"))
            by_length = {m.shape[1]: (at, m) for at, m in _lengths(rows)}
            for a_at, a in _lengths(anchors):
                if a.shape[1] not in by_length:
                    continue
                at, m = by_length[a.shape[1]]
                ids, labels = r_id[at], r_label[at]
                for k in range(0, len(a), TILE):
                    for own, s in zip(a_at[k : k + TILE], scores(a[k : k + TILE], m), strict=True):
                        best = pick(s, ids, labels == a_label[own], ids != a_id[own], bounds[own])
                        for to, x in zip(found, (np.full(len(best), a_id[own]), ids[best], s[best]), strict=True):
                            to.append(x)
        return pa.table([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in found], names=["anchor_id", "vec_id", "score"])

    return run


def _positives(most: int):
    def pick(s, ids, same, other, _) -> np.ndarray:
        at = np.flatnonzero(same & other)
        return at[np.lexsort((ids[at], -s[at]))[:most]]

    return pick


def _negatives(most: int, low: int, high: int):
    def pick(s, ids, same, other, bounds) -> np.ndarray:
        keep = [np.zeros(0, np.int64)]
        for positive in bounds:
            at = np.flatnonzero(~same & other & within(s, positive, low, high))
            keep.append(at[np.lexsort((ids[at], -s[at]))[:most]])
        return np.unique(np.concatenate(keep))

    return pick


def _windows(most: int, negatives: int, low: int, high: int):
    """Reads rows sorted by (anchor, descending score, kind, id). Holds one anchor's open windows, never its rows."""

    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, windows, seen = None, [], 0
        for batch in batches:
            out: list[tuple] = []
            for anchor, score, kind, vec in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if anchor != at:
                    at, windows, seen = anchor, [], 0
                if kind == 0:
                    if seen < most:
                        seen += 1
                        windows.append([vec, score, 0])
                    continue
                windows = [w for w in windows if w[2] < negatives and low * w[1] <= 100 * score]
                for w in windows:
                    if 100 * score <= high * w[1]:
                        w[2] += 1
                        out.append((anchor, w[0], w[2], vec, w[1], score))
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])

    return run


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for vectors(vec_id, label, embedding, ...).

    A component x counts as floor(256 * x); scores are exact integer inner products. An anchor's positives are its
    first rows of the same label, its negatives for a positive the first ones of another label with
    low * positive <= 100 * negative <= high * positive; higher scores come first, ties go to the smaller vec_id.
    high is 100 at most, so that a window never reaches above its positive.

    Rows with a null vec_id, label or vector, or a component that is null or not finite, take no part. Only rows of the
    anchor's vec_id aren't other rows to it; rows that share another one each count. Anchors that share a vec_id are one,
    with the least (label, vector). A vector of another length than the anchor's has no score with it; an empty one
    scores 0 with empty ones. Other columns aren't read; an empty table gives an empty result.
    """
    if high > 100:
        raise ValueError("a window can't reach above its positive")
    e = F.col("embedding")
    good = vectors.where("vec_id is not null and label is not null and embedding is not null").where(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    good = good.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), e.cast("array<double>").alias("embedding"), is_anchor.alias("_anchor"))
    # the rows' numbers are stored with them, so that a task that runs again deals as before
    rows = stored(good.withColumn("_number", F.monotonically_increasing_id()), "vectors")
    size = rows.agg(F.count("*"), F.max(F.size("embedding"))).first()
    group_rows = max(1, min(group_rows, GROUP_CELLS // max(1, size[1] or 1)))
    anchors = rows.where("_anchor").groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("_a")).select("vec_id", F.col("_a.label").alias("label"), F.col("_a.embedding").alias("embedding"))
    anchors = stored(anchors, "anchors")
    n_rows, n_anchors = (max(1, -(-n // group_rows)) for n in (size[0], anchors.count()))

    def met(own: DataFrame, pick) -> DataFrame:
        # both sides' keys are int: cogroup deals each side by a hash of its own columns, and that of a long is another
        left = own.withColumn("_a", F.pmod(F.xxhash64("vec_id"), F.lit(n_anchors)).cast("int")).withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(n_rows - 1))))
        right = rows.drop("_anchor").withColumn("_r", (F.col("_number") % n_rows).cast("int")).withColumn("_a", F.explode(F.sequence(F.lit(0), F.lit(n_anchors - 1))))
        return left.groupBy("_a", "_r").cogroup(right.groupBy("_a", "_r")).applyInArrow(_meet(pick), "anchor_id long, vec_id long, score long")

    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("score"), "vec_id"))
    first = stored(met(anchors, _positives(positives)).withColumn("_place", place).where(F.col("_place") <= positives).drop("_place"), "positives")
    bounds = first.groupBy(F.col("anchor_id").alias("_id")).agg(F.collect_set("score").alias("bounds"))  # as many as positives at most
    asked = stored(anchors.join(bounds, F.col("vec_id") == F.col("_id")).drop("_id"), "asked")
    both = first.withColumn("kind", F.lit(0)).unionByName(met(asked, _negatives(negatives, low, high)).withColumn("kind", F.lit(1)))
    dealt = both.select("anchor_id", "score", "kind", "vec_id").repartition("anchor_id").sortWithinPartitions("anchor_id", F.desc("score"), "kind", "vec_id")
    return dealt.mapInArrow(_windows(positives, negatives, low, high), "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
