"""Exact vector search and BM25 term search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.sources.checkpoints import cut

#: Rows of a group of queries or vectors; every two groups meet in one task, tile by tile.
GROUP_ROWS = 10_000
TILE_QUERIES, TILE_VECTORS = 256, 2_000


def _matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    e = rows.column("embedding").combine_chunks()
    v = np.asarray(e.flatten(), np.float64).reshape(len(rows), -1)
    return np.asarray(rows.column("vec_id")), v, np.sqrt((v * v).sum(1))


def top_of_groups(k: int):
    """Of one group of queries and one of vectors: the k best of the group for each query; ties go to the least id."""

    def run(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        found: list[list[np.ndarray]] = [[], [], []]
        if len(queries) and len(vectors):
            (q_ids, q, q_norm), (ids, v, norm) = _matrix(queries), _matrix(vectors)
            for a in range(0, len(q_ids), TILE_QUERIES):
                own, best_id, best = q_ids[a : a + TILE_QUERIES], None, None
                for b in range(0, len(ids), TILE_VECTORS):
                    part = ids[b : b + TILE_VECTORS]
                    score = np.round(q[a : a + TILE_QUERIES] @ v[b : b + TILE_VECTORS].T / (q_norm[a : a + TILE_QUERIES, None] * norm[None, b : b + TILE_VECTORS]), 9)
                    score[own[:, None] == part[None, :]] = -np.inf
                    all_id, all_ = np.broadcast_to(part, score.shape), score
                    if best is not None:
                        all_id, all_ = np.hstack([best_id, all_id]), np.hstack([best, all_])
                    if all_.shape[1] > k:  # all that are as good as the k-th stay, then ids decide
                        least = -np.partition(-all_, k - 1, axis=1)[:, k - 1]
                        wide = max(k, int((all_ >= least[:, None]).sum(1).max()))
                        at = np.argsort(-all_, axis=1, kind="stable")[:, :wide] if wide > 4 * k else np.argpartition(-all_, min(wide, all_.shape[1] - 1), axis=1)[:, :wide]
                        all_id, all_ = np.take_along_axis(all_id, at, 1), np.take_along_axis(all_, at, 1)
                    order = np.lexsort((all_id, -all_), axis=1)[:, :k]
                    best_id, best = np.take_along_axis(all_id, order, 1), np.take_along_axis(all_, order, 1)
                keep = np.isfinite(best.ravel())
                for to, x in zip(found, (np.repeat(own, best.shape[1]), best_id.ravel(), best.ravel()), strict=True):
                    to.append(x[keep])
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(np.concatenate(x) if x else [], t) for x, t in zip(found, kinds, strict=True)], names=["query_id", "vec_id", "score"])

    return run


def usable(df: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that have a direction: not null or zero, all components finite."""
    e = F.col("embedding")
    ok = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    return df.select(F.col("vec_id").cast("long").alias("vec_id"), e.cast("array<double>").alias("embedding")).where(ok)


def vector_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(query_id, vec_id, score, place) of the k rows nearest to each query by cosine, itself left out.

    Scores are rounded to nine places, and ties go to the least id. Vectors that are null, zero or hold a null or
    non-finite component take no part. Queries and vectors are dealt into groups of bounded size, every two of which
    meet in a task of their own; a query's best of each group are ranked at the end. Vectors must be of one length.
    """

    rows, wanted = usable(vectors), usable(queries)
    n_rows, n_wanted = (max(1, -(-x.count() // group_rows)) for x in (rows, wanted))

    def dealt(df: DataFrame, own: str, groups: int, other: str, others: int) -> DataFrame:
        # both sides' keys must be of one type: cogroup deals each side by a hash of its own columns
        return df.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))

    left, right = dealt(wanted, "_q", n_wanted, "_v", n_rows), dealt(rows, "_v", n_rows, "_q", n_wanted)
    met = left.groupBy("_q", "_v").cogroup(right.groupBy("_q", "_v")).applyInArrow(top_of_groups(k), "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return met.withColumn("place", place).where(F.col("place") <= k)


def _is(term: str):
    return lambda word: word == term


def bm25(docs: DataFrame, terms: list[str], k: int | None = None, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(doc_id, score) of the documents that hold a term, best first; the k best if k is given.

    Words are runs of letters and digits in lower case. Scores are rounded to nine places, ties go by doc_id. Texts
    are read and split once; what remains of them, a length and a count for each term, is kept for the two uses.
    """
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+")

    def counts(w):
        return F.struct(F.size(F.filter(w, lambda x: x != "")).alias("len"), *(F.size(F.filter(w, _is(t))).alias(f"tf{n}") for n, t in enumerate(terms)))

    # the one-element array binds a text's words, which are so split once
    counted = docs.select("doc_id", F.inline(F.transform(F.array(words), counts)))
    counted = cut(counted)
    whole = counted.agg(F.count("*").alias("n"), F.avg("len").alias("mean"), *(F.sum((F.col(f"tf{n}") > 0).cast("long")).alias(f"df{n}") for n in range(len(terms))))
    joined = counted.where(F.greatest(F.lit(0), F.lit(0), *(F.col(f"tf{n}") for n in range(len(terms)))) > 0).crossJoin(F.broadcast(whole))  # one row of totals
    score = F.lit(0.0)
    for n in range(len(terms)):
        tf, df = F.col(f"tf{n}"), F.col(f"df{n}")
        idf = F.log(1 + (F.col("n") - df + 0.5) / (df + 0.5))
        score = score + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("len") / F.col("mean")))
    out = joined.select("doc_id", F.round(score, 9).alias("score")).orderBy(F.desc("score"), "doc_id")
    return out if k is None else out.limit(k)
