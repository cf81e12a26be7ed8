"""Token ids in a content-addressed store.

A document's id stream (its end id included) is cut where a rolling hash over the last ids meets a mask, so equal
passages give equal chunks wherever they stand. Three tables make the store, all Parquet:

    chunks     digest (128 bits of BLAKE2b of the ids as stored), n, ids (unsigned, low byte first, 2 bytes each if
               the vocabulary allows it, else 4): each distinct chunk once
    recipes    row, root, digests, lengths: the chunks of each document in order, one row a document
    manifests  doc_id, row, start, n_chunks, n_tokens, root: in ascending doc_id order, a null one first; start
               counts the ids of all documents before, root is the Merkle root over the document's digests

Recipes and chunks leave the encoding in one pass; only manifests, which are small, are sorted. Reading back checks
each chunk against its digest, each recipe against its root and each root against its manifest; a difference is an
error. The CRC of a document is the sum (by exclusive or) of those of its chunks, each moved by what follows it, so
no document is put together to be checked.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import freed, fresh_dir, little_memory, stored
from .shingles import mix
from .tokens import encoder, larger

END_ID = 0
#: Chunk sizes in ids: least, about the mean less the least, most. Well below a document and a shared passage.
LEAST, MEAN, MOST = 16, 64, 1024
WINDOW = 8
DIGEST = 16
#: Digests that make one inner node of a Merkle tree.
FAN = 16
#: Bytes of texts that are encoded at once: the more, the more cuts repeat among them.
ENCODED_BYTES = 4 << 20
#: Digests of bodies that a task remembers to have sent.
REMEMBERED = 200_000

_gear = mix(np.arange(1 << 16, dtype=np.uint64), 61).astype(np.uint32)
_PARTS = "kind string, part binary, row long, doc_id long, n_chunks int, n long, root binary, lengths binary, body binary"
_NAMES = ["kind", "part", "row", "doc_id", "n_chunks", "n", "root", "lengths", "body"]
_TYPES = [pa.string(), pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def rolling(ids: np.ndarray) -> np.ndarray:
    """A hash of the last WINDOW ids at each place, of which the upper bits depend on all of them; all ids at once, by
    sums that double their reach."""
    out, reach = _gear[ids & 0xFFFF], 1
    while reach < WINDOW:
        moved = out[:-reach] << np.uint32(reach)
        out[reach:] += moved
        reach *= 2
    return out


def cuts(marks: np.ndarray, n: int, least: int = LEAST, most: int = MOST) -> list[int]:
    """Ends of the chunks of a stream of n ids, whose marked places may end one."""
    out, a = [], 0
    places = marks.tolist()
    for p in [*places, n - 1]:
        while p + 1 - a > most:
            a += most
            out.append(a)
        if p + 1 - a >= least or p + 1 == n:
            if p + 1 > a:
                out.append(p + 1)
            a = p + 1
    return out


def digest_of(body: bytes) -> bytes:
    return blake2b(body, digest_size=DIGEST).digest()


def merkle_root(digests: bytes) -> bytes:
    """Of digests in a row. FAN of them make a node, level by level; nodes hash unlike chunks."""
    step = FAN * DIGEST
    while True:
        digests = b"".join([blake2b(digests[k : k + step], digest_size=DIGEST, person=b"node").digest() for k in range(0, max(1, len(digests)), step)])
        if len(digests) == DIGEST:
            return digests


def _split(path: str, wide: bool, mean: int):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent, kind, width = set(), "<u4" if wide else "<u2", 4 if wide else 2
        with encoder(path) as encode:
            for batch in larger(batches, ENCODED_BYTES):
                for first, ids, at in encode.slices(batch.column(2), ENCODED_BYTES):
                    n_rows = len(at) - 1
                    ids = np.insert(ids, at[1:], END_ID)
                    at = (at + np.arange(n_rows + 1)).tolist()
                    raw = ids.astype(kind).tobytes()
                    marks = np.flatnonzero(rolling(ids) < np.uint32((1 << 32) // mean))
                    lo = np.searchsorted(marks, at).tolist()
                    keys, sizes, bodies, counts, roots, recipes, lengths = ([] for _ in range(7))
                    for k in range(n_rows):
                        begin, a = at[k], 0
                        ends = cuts(marks[lo[k] : lo[k + 1]] - begin, at[k + 1] - begin)
                        own, held = [], []
                        for b in ends:
                            body = raw[width * (begin + a) : width * (begin + b)]
                            own.append(d := blake2b(body, digest_size=DIGEST).digest())
                            if d not in sent:
                                if len(sent) >= REMEMBERED:
                                    sent.clear()
                                sent.add(d)
                                keys.append(d)
                                sizes.append(b - a)
                                bodies.append(body)
                            held.append(b - a)
                            a = b
                        recipes.append(joined := b"".join(own))
                        counts.append(len(ends))
                        roots.append(merkle_root(joined))
                        lengths.append(np.array(held, "<u2").tobytes())
                    none = [None] * len(keys)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([["chunk"] * len(keys), keys, none, none, none, sizes, none, none, bodies], _TYPES, strict=True)], names=_NAMES)
                    rows, names = batch.column(0).slice(first, n_rows), batch.column(1).slice(first, n_rows)
                    parts = [x.to_bytes(8, "big") for x in rows.to_numpy().tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array(["recipe"] * n_rows), pa.array(parts, pa.binary()), rows, names, pa.array(counts, pa.int32()), pa.array(np.diff(at)), pa.array(roots, pa.binary()), pa.array(lengths, pa.binary()), pa.array(recipes, pa.binary())], names=_NAMES)

    return run


def write(docs: DataFrame, path: str, to: str, mean: int = MEAN) -> None:
    """Writes docs(doc_id, text) as tables under `to`. A null or empty text is its end id alone.

    row tells repeated rows apart, and orders those that share a doc_id. Texts may be of any length: a chunk holds
    MOST ids at most.
    """
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    wide = Tokenizer.from_file(path).get_vocab_size() > 1 << 16
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = rows.mapInArrow(_split(path, wide, mean), _PARTS)
    # chunks meet by digest; each task has sent a body once, and recipes have parts of their own. The part comes first,
    # as rows are sorted by the first bytes of the first column
    same = Window.partitionBy("part", "kind").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    once = parts.withColumn("seen", F.count(F.lit(1)).over(same)).where("seen = 1").withColumn("part", F.when(F.col("kind") == "chunk", F.col("part"))).drop("seen")
    with little_memory(spark):
        once.write.partitionBy("kind").option("compression", "zstd").parquet(f"{to}/content")
    # running totals over ranges of (doc_id, row): sums of the ranges first, then within each
    light = _content(spark, to, "recipe").select("doc_id", "row", "n_chunks", F.col("n").alias("n_tokens"), "root")
    ranged = stored(light.repartitionByRange("doc_id", "row").withColumn("range", F.spark_partition_id()), "ranged")
    ahead = ranged.groupBy(F.col("range").alias("g")).agg(F.sum("n_tokens").alias("sum")).withColumn("ahead", F.coalesce(F.sum("sum").over(Window.orderBy("g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("g", "ahead")
    within = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("range").orderBy("doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranged.withColumn("within", within).join(F.broadcast(ahead), F.col("range") == F.col("g")).select("doc_id", "row", (F.col("ahead") + F.col("within")).alias("start"), "n_chunks", "n_tokens", "root")
    placed.repartitionByRange("start").sortWithinPartitions("start").write.parquet(f"{to}/manifests")


def _content(spark: SparkSession, at: str, kind: str) -> DataFrame:
    fields = [x for x in _PARTS.split(", ") if not x.startswith("kind")]
    return spark.read.schema(", ".join([*fields, "kind string"])).parquet(f"{at}/content").where(F.col("kind") == kind)


def tables(spark: SparkSession, at: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """chunks, recipes and manifests of a store."""
    chunks = _content(spark, at, "chunk").select(F.col("part").alias("digest"), "n", F.col("body").alias("ids"))
    recipes = _content(spark, at, "recipe").select("row", "root", F.col("body").alias("digests"), "lengths")
    return chunks, recipes, spark.read.schema("doc_id long, row long, start long, n_chunks int, n_tokens long, root binary").parquet(f"{at}/manifests")


def _values(column: pa.Array) -> list:
    return column.to_numpy(zero_copy_only=False).tolist()


@freed
def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of chunks (digest, n, ids): how many ids each one holds, and the CRC of them as 4 bytes each."""
    for batch in batches:
        digests, n, bodies = (_values(batch.column(k)) for k in range(3))
        width = 4 if sum(map(len, bodies)) == 4 * sum(n) else 2
        for digest, count, body in zip(digests, n, bodies, strict=True):
            if digest_of(body) != digest or len(body) != width * count:
                raise ValueError(f"chunk {digest.hex()} holds other ids than its digest says")
        joined = b"".join(bodies)
        ids = memoryview(joined if width == 4 else np.frombuffer(joined, "<u2").astype("<u4").tobytes())
        crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in pairwise(accumulate(n, initial=0))]
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(n, pa.int64()), pa.array(crcs, pa.int64())], names=["d", "held", "crc"])


@freed
def _expanded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each chunk of recipes (row, root, digests, lengths): what it must hold and how many ids follow it."""
    for batch in batches:
        rows, roots, recipes, lengths = (_values(batch.column(k)) for k in range(4))
        for lo in range(0, len(rows), 2_000):
            some = slice(lo, lo + 2_000)
            for row, root, recipe in zip(rows[some], roots[some], recipes[some], strict=True):
                if merkle_root(recipe) != root:
                    raise ValueError(f"the recipe of row {row} differs from its root: the store doesn't reconstruct it")
            joined, n = b"".join(recipes[some]), np.frombuffer(b"".join(lengths[some]), "<u2").astype(np.int64)
            count = np.array([len(x) for x in lengths[some]], np.int64) // 2
            last = np.cumsum(count) - 1
            if len(joined) != DIGEST * len(n):
                raise ValueError("digests and lengths differ: the store doesn't reconstruct its documents")
            to = np.cumsum(n)
            digests = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.arange(0, len(joined) + 1, DIGEST, dtype=np.int32)), pa.py_buffer(joined)])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.array(rows[some], np.int64), count)), digests, pa.array(n), pa.array(np.repeat(to[last], count) - to)], names=["row", "digest", "n", "after"])


def _zeros_operators() -> np.ndarray:
    """For k: tables of what 2^k zero bytes do to each byte of a CRC register."""
    def apply(table: np.ndarray, x: np.ndarray) -> np.ndarray:
        return table[0][x & 255] ^ table[1][(x >> 8) & 255] ^ table[2][(x >> 16) & 255] ^ table[3][x >> 24]

    # of a CRC whose register starts with its own value, one zero byte more; the final inversions cancel
    one = np.array([[zlib.crc32(b"\0", (v << 8 * k)) ^ zlib.crc32(b"\0", 0) for v in range(256)] for k in range(4)], np.uint32)
    out = [one]
    for _ in range(44):
        out.append(np.stack([apply(out[-1], row) for row in out[-1]]))
    return np.array(out)


_zeros: list[np.ndarray] = []


def moved(crc: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """What each CRC adds to that of a longer string, of which so many bytes follow."""
    if not _zeros:
        _zeros.append(_zeros_operators())
    x, k = crc.astype(np.uint32), 0
    while (zeros >> k).any():
        at = np.flatnonzero((zeros >> k) & 1)
        y, t = x[at], _zeros[0][k]
        x[at] = t[0][y & 255] ^ t[1][(y >> 8) & 255] ^ t[2][(y >> 16) & 255] ^ t[3][y >> 24]
        k += 1
    return x


@freed
def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, crc, after, held = batch.columns
        yield pa.RecordBatch.from_arrays([row, pa.array(moved(np.asarray(crc), 4 * np.asarray(after)).astype(np.int64)), held], names=["r", "crc", "held"])


def read_back(spark: SparkSession, at: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, n_chunks, merkle_root) of each document of a store, all of it verified."""
    chunks, recipes, manifests = tables(spark, at)
    sums = chunks.mapInArrow(_checked, "d binary, held long, crc long")
    named = recipes.mapInArrow(_expanded, "row long, digest binary, n long, after long")
    found = named.join(sums, (F.col("digest") == F.col("d")) & (F.col("n") == F.col("held")), "left")
    found = found.select("row", F.coalesce("crc", F.lit(0)).alias("crc"), "after", F.coalesce("held", F.lit(-1)).alias("held"))
    parts = found.mapInArrow(_moved, "r long, crc long, held long").groupBy("r").agg(F.bit_xor("crc").alias("crc"), F.sum("held").alias("held"), F.count("*").alias("found"), F.min("held").alias("least"))
    light = recipes.select(F.col("row").alias("of"), F.col("root").alias("own_root"))
    whole = manifests.join(parts, F.col("row") == F.col("r"), "left").join(light, F.col("row") == F.col("of"), "left")
    good = (F.col("least") >= 0) & (F.col("found") == F.col("n_chunks")) & (F.col("held") == F.col("n_tokens")) & (F.col("root") == F.col("own_root"))
    wrong = F.raise_error(F.concat(F.lit("the store doesn't reconstruct document "), F.coalesce(F.col("doc_id").cast("string"), F.lit("without id"))))
    return whole.select("doc_id", "start", "n_tokens", F.when(good, F.col("crc")).otherwise(wrong.cast("long")).alias("ids_crc32"), "n_chunks", F.lower(F.hex("root")).alias("merkle_root"))


def reconstructed(spark: SparkSession, at: str) -> DataFrame:
    """(row, ids): the id streams put together again, each id as wide as the store has it."""
    chunks, recipes, _ = tables(spark, at)
    named = recipes.mapInArrow(_expanded, "row long, digest binary, n long, after long")
    joined = named.join(chunks.select(F.col("digest").alias("d"), "ids"), F.col("digest") == F.col("d"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("after")).alias("place"), "ids")))
    return joined.groupBy("row").agg(F.aggregate(ordered, F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))


def digest(docs: DataFrame, path: str) -> DataFrame:
    spark = docs.sparkSession
    write(docs, path, at := fresh_dir(spark, "store"))
    return read_back(spark, at)
