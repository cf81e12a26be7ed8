"""Vector best-fit packing of token pieces into sequences.

Each piece asks for tokens, one document place and attention cost (its length squared); each bin has capacities of
all three. Pieces are dealt by hash into groups of bounded size, and each group packs its pieces, longest first:
among the bins with room in every dimension the score of the residual vector chooses, or else a new bin opens.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, stored
from .tokens import encoder, larger

TOKENS = 2048
#: Capacities: tokens, documents, attention cost; by default the last two bind no earlier than the first.
CAPACITY = (TOKENS, TOKENS, TOKENS * TOKENS)
#: Weights of the residuals, each as a share of its capacity.
WEIGHTS = (1.0, 0.01, 0.05)
#: Pieces of a group; each one leaves one bin or a few that are not full.
GROUP_ROWS = 16_000
END_ID = 0

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(path: str, most: int, with_ids: bool):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with encoder(path) as encode:
            for batch in larger(batches):
                names = batch.column(0)
                for first, ids, at in encode.slices(batch.column(1)):
                    row, piece, start, length, crc, body = [], [], [], [], [], []
                    for k in range(len(at) - 1):
                        own = np.append(ids[at[k] : at[k + 1]], np.uint32(END_ID)).astype("<u4")
                        for n, a in enumerate(range(0, len(own), most)):
                            part = own[a : a + most].tobytes()
                            for to, x in ((row, first + k), (piece, n), (start, a), (length, len(part) // 4), (crc, zlib.crc32(part))):
                                to.append(x)
                            if with_ids:
                                body.append(part)
                    columns = [names.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns + [pa.array(body, pa.binary())] * with_ids, names=["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)

    return run


def pieces(docs: DataFrame, path: str, most: int = TOKENS, with_ids: bool = False) -> DataFrame:
    """Pieces of at most `most` ids of each row of docs, its end id included; only longer documents are cut."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_pieces(path, most, with_ids), _PIECE + ", ids binary" * with_ids)


def best_fit(lengths: np.ndarray, capacity: tuple[int, int, int] = CAPACITY, weights: tuple[float, float, float] = WEIGHTS, score: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; lengths must be in falling order and none above the capacity.

    score "norm" takes the bin whose residual vector has the least weighted norm with the piece in it; "dot" takes
    the one with the greatest weighted product of its residual and the piece. Ties go to the oldest bin.
    """
    full, w = np.array(capacity, float), np.array(weights)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    if not len(lengths):
        return bins, offsets
    least, made = int(lengths[-1]), 0
    room, number = np.zeros((3, 256)), np.zeros(256, np.int64)
    opened = 0
    for k, n in enumerate(lengths.tolist()):
        need = (n, 1, n * n)
        r = room[:, :opened]
        fits = np.flatnonzero((r[0] >= n) & (r[1] >= 1) & (r[2] >= n * n))
        if len(fits):
            left = [(r[d, fits] - (need[d] if score == "norm" else 0)) / full[d] for d in range(3)]
            if score == "norm":
                at = fits[np.argmin(w[0] * left[0] ** 2 + w[1] * left[1] ** 2 + w[2] * left[2] ** 2)]
            else:
                at = fits[np.argmax(sum(w[d] * left[d] * need[d] / full[d] for d in range(3)))]
        else:
            if opened == room.shape[1]:
                keep = np.flatnonzero((room[0] >= least) & (room[1] >= 1))
                if len(keep) > opened // 2:
                    room, number = np.hstack([room, np.zeros_like(room)]), np.append(number, np.zeros_like(number))
                else:
                    room[:, : len(keep)], number[: len(keep)], opened = room[:, keep], number[keep], len(keep)
            at, opened = opened, opened + 1
            room[:, at], number[at], made = full, made, made + 1
        bins[k], offsets[k] = number[at], capacity[0] - room[0, at]
        room[:, at] -= need
    return bins, offsets


def _pack_group(capacity, weights, score):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], na_position="first")
        bins, offset = best_fit(rows["length"].to_numpy(), capacity, weights, score)
        return rows.assign(sequence_id=(key[0] << 32) + bins, offset=offset).drop(columns="_group")

    return run


def pack(docs: DataFrame, path: str, capacity: tuple[int, int, int] = CAPACITY, weights: tuple[float, float, float] = WEIGHTS, score: str = "norm", group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): where each piece of each document goes.

    A null or empty text is its end id alone. Repeated rows are packed each; a null doc_id stays null. Texts of any
    length are cut into whole pieces; ties of length go by doc_id and piece. An empty table gives no piece.
    """
    if capacity[0] > capacity[2] ** 0.5:
        raise ValueError("a piece of full length must fit the attention capacity")
    cut = stored(pieces(docs, path, capacity[0]), "pieces")
    groups = max(1, -(-cut.count() // group_rows))
    dealt = cut.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(_pack_group(capacity, weights, score), _PIECE + ", sequence_id long, offset long")


def sequences(docs: DataFrame, path: str, capacity: tuple[int, int, int] = CAPACITY, **options) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed id streams themselves, from the placements and the pieces' ids."""
    placed = stored(pack(docs, path, capacity, **options), "placed")
    body = pieces(docs, path, capacity[0], True).select("doc_id", "piece", "ids_crc32", "length", "ids").dropDuplicates(["doc_id", "piece", "ids_crc32", "length"])
    same = [placed[k].eqNullSafe(body[k]) for k in ("doc_id", "piece", "ids_crc32", "length")]
    joined = placed.join(body, same).select("sequence_id", "offset", placed["length"], "ids")
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.aggregate(ordered, F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
