"""Near-duplicate vectors by random-hyperplane signs in several tables, exact cosines and components.

Equal vectors are one class with a weight. Each class has a code of sign bits in every table; classes that share a
code in a table meet in its bucket and their cosines are computed there in double precision. A pair counts in the
first table in which it meets, so weights add up without a list of pairs. A bucket gives its members' link counts and
the components of its own links, both one row a member. Buckets beyond BLOCK members are dealt in blocks, every two
of which meet once.

Bits grow with the number of classes, so buckets stay small; tables grow with the bits, so that a pair at the very
threshold is missed with probability MISSED at most, and closer pairs less.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, small, stored
from .components import components

THRESHOLD = 0.95
MISSED = 1e-4
BUCKET = 8
LEAST_BITS, MOST_BITS = 6, 28
BLOCK = 1_000
SEED = 20_240


def plan(classes: int, threshold: float = THRESHOLD, missed: float = MISSED) -> tuple[int, int]:
    """(bits, tables)."""
    bits = min(MOST_BITS, max(LEAST_BITS, ceil(log2(max(1, classes) / BUCKET)) if classes > BUCKET else LEAST_BITS))
    meet = (1 - acos(threshold) / pi) ** bits
    return bits, ceil(log(missed) / log(1 - meet))


def _coded(bits: int, tables: int):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            raw = batch.column(2).to_pylist()
            codes = [b""] * len(raw)
            by_size: dict[int, list[int]] = {}
            for k, x in enumerate(raw):
                by_size.setdefault(len(x), []).append(k)
            for n, rows in by_size.items():
                if n not in planes:
                    planes[n] = np.random.default_rng([SEED, n]).standard_normal((n, bits * tables))
                signs = (np.array([raw[k] for k in rows], np.float64) @ planes[n] > 0).reshape(len(rows), tables, bits)
                packed = (signs @ (1 << np.arange(bits))).astype("<i4")
                for k, own in zip(rows, packed, strict=True):
                    codes[k] = own.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array([np.array(x, "<f8").tobytes() for x in raw], pa.binary()), pa.array(codes, pa.binary())], names=["id", "weight", "v", "codes"])

    return run


def _keys(tables: int):
    """A row for each table: what a vector's bucket is called there."""

    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            codes = np.frombuffer(b"".join(batch.column(3).to_pylist()), "<i4").reshape(n, tables)
            size = np.array([len(x) for x in batch.column(2).to_pylist()], np.int64) // 8
            for lo in range(0, n, 500):
                part = np.arange(lo, min(n, lo + 500)).repeat(tables)
                table = np.tile(np.arange(tables, dtype=np.int64), len(part) // tables)
                key = (size[part] << 40) | (table << 32) | codes[part, table]
                yield pa.RecordBatch.from_arrays([pa.array(key), *(c.take(pa.array(part)) for c in batch.columns)], names=["key", "id", "weight", "v", "codes"])

    return run


def _links(ids, weights, v, codes, table, halves, threshold) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(members, weight of their links, least id of their component here) of those with a link."""
    norm = np.sqrt((v * v).sum(1))
    near = (v @ v.T) / (norm[:, None] * norm[None, :]) >= threshold
    np.fill_diagonal(near, False)
    if halves is not None:
        near &= halves[:, None] != halves[None, :]
    if not near.any():
        return (np.zeros(0, np.int64),) * 3
    local = np.where(near, ids[None, :], np.iinfo(np.int64).max).min(1)
    label = np.minimum(ids, local)
    while True:
        new = np.minimum(label, np.where(near, label[None, :], np.iinfo(np.int64).max).min(1))
        if (new == label).all():
            break
        label = new
    first = near.copy()
    for t in range(table):
        first &= codes[:, t][:, None] != codes[:, t][None, :]
    got = np.flatnonzero(near.any(1))
    return ids[got], (first @ weights)[got], label[got]


def _met(tables: int, threshold: float):
    """Rows sorted by bucket and block pair; each run of them is one meeting."""

    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at = None

        def settle() -> tuple:
            if len(held) < 2:
                return (np.zeros(0, np.int64),) * 3
            v = np.frombuffer(b"".join(x[2] for x in held), "<f8").reshape(len(held), -1)
            codes = np.frombuffer(b"".join(x[3] for x in held), "<i4").reshape(len(held), tables)
            halves = np.array([x[4] for x in held]) if at[1] != at[2] else None
            return _links(np.array([x[0] for x in held], np.int64), np.array([x[1] for x in held], np.int64), v, codes, (at[0] >> 32) & 255, halves, threshold)

        def out(parts: list[tuple]) -> pa.RecordBatch:
            cols = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(3)]
            return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names=["id", "n", "label"])

        for batch in batches:
            parts = []
            for key, lo, hi, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, lo, hi) != at:
                    parts.append(settle())
                    held.clear()
                    at = (key, lo, hi)
                held.append(tuple(rest))
            yield out(parts)
        yield out([settle()])

    return run


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, missed: float = MISSED) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row for each of vectors(vec_id, embedding).

    n_links counts the other rows whose vector has at least this cosine with it; component_id is the least vec_id
    reachable by links, its own included; kept says whether it is its own. A vector that is null, empty, zero or has
    a component that is null or not finite links with nothing, nor do vectors of different lengths. Repeated rows
    are vectors each. Other columns are not read; an empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("e", lambda x: x != 0)
    rows = stored(rows.withColumn("e", F.when(finite, F.col("e"))), "vectors")
    classes = rows.where("e is not null and vec_id is not null").groupBy("e").agg(F.min("vec_id").alias("id"), F.count("*").alias("weight"))
    classes = stored(classes.select("id", "weight", "e"), "classes")
    bits, tables = plan(classes.count(), threshold, missed)
    if tables > 256:
        raise ValueError("too many tables: raise MISSED or lower BUCKET")
    coded = stored(classes.mapInArrow(_coded(bits, tables), "id long, weight long, v binary, codes binary"), "coded")
    keyed = coded.mapInArrow(_keys(tables), "key long, id long, weight long, v binary, codes binary")
    full = coded.select("id", "weight", "v", "codes").mapInArrow(_keys(tables), "key long, id long, weight long, v binary, codes binary").groupBy(F.col("key").alias("k")).agg(F.count("*").alias("members"))
    large = stored(full.where(F.col("members") > BLOCK).select("k", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")), "large")
    dealt = keyed.join(small(large), F.col("key") == F.col("k"), "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "id", "weight", "v", "codes", "block")
    met = dealt.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "id").mapInArrow(_met(tables, threshold), "id long, n long, label long")
    met = stored(met.groupBy("id", "label").agg(F.sum("n").alias("n")), "met")
    counts = met.groupBy(F.col("id").alias("i")).agg(F.sum("n").alias("n"))
    labels = stored(components(met.where("id <> label"), "id", "label"), "labels")
    of = classes.join(counts, F.col("id") == F.col("i"), "left").join(labels, F.col("id") == F.col("node"), "left")
    of = of.select(F.col("e").alias("c"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n"), F.coalesce("component", "id").alias("component"))
    out = rows.join(of, F.col("e") == F.col("c"), "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
