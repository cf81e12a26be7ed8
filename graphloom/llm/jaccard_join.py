"""N-gram Jaccard self-join by size: subsets for small sets, inverted lists for large ones.

The sets are distinct word shingles of whole texts. Equal sets collapse into one class first.

* A small set (fewer shingles than the boundary) lists all subsets of the sizes at which it could meet a partner.
  Two small sets link exactly when they share a subset of their required overlap, and then both link with the
  smallest set that has this subset, so one link to that set for each holds the class together.
* A large set, and each small one that could be its partner, enters the inverted lists of its rarest shingles, as
  many as leave too few others for a link. The centre of a list is the set with the fewest rarer shingles before
  this one, so it is close to what the list's sets have in common. First each set is held against one centre, then
  against the centres of other lists, and at last lists are scanned for pairs that are in different components
  still. Each pair passes exact bounds (sizes, places in the order, parity bitmaps) before its sets are intersected.
* The boundary is where listing subsets begins to cost more than scanning, by the sets' own sizes.

The order of shingles is by a count sketch over the corpus whose size is bounded, so a frequent passage is last in
it. Lists that the sketch says are beyond LIST_ROWS are dealt over up to 255 salted parts in all but the last scan,
which joins the sides by key and leaves splitting to Spark. What a set needs to know of a subset is one aggregate
row a task, joined back.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import freed, small, stored
from .components import components
from .shingles import SHINGLE, mix, shingle_sets

#: Sketch cells are a power of two between these: 2 bytes a cell, so 64 MB at most are broadcast. A task counts up to
#: 65,535 in a cell; the sums are kept as the upper half of a float, which has the order of the counts to 1 in 128.
LEAST_CELLS, MOST_CELLS, CELLS_A_ROW = 1 << 16, 1 << 25, 32
CHUNK = 1 << 15
#: A list that the sketch says is longer is dealt over parts.
LIST_ROWS = 20_000
#: Sets of this size and above are never small.
LARGEST_SMALL = 16
#: Rows of subsets that verifying one candidate costs.
SCAN_COST = 24
#: Sets checked against one copy of a centre.
PER_CENTRE = 64


def needed(n: int, m: int, percent: int) -> int:
    """Least overlap of sets of n and m shingles that link: 100 * both >= percent * either."""
    return -(-percent * (n + m) // (100 + percent))


def subset_sizes(n: int, percent: int, below: int) -> list[int]:
    """Overlaps that a set of n needs with partners that are small too."""
    return sorted({needed(n, m, percent) for m in range(-(-percent * n // 100), min(100 * n // percent, below - 1) + 1)})


def prefix(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def choose_boundary(sizes: dict[int, int], percent: int) -> int:
    """The boundary with the least rows to list and scan, given how many sets have each size under LARGEST_SMALL."""

    def cost(b: int) -> int:
        return sum(k * (sum(comb(n, c) for c in subset_sizes(n, percent, b)) if n < b else prefix(n, percent) + SCAN_COST) for n, k in sizes.items())

    return min(range(1, LARGEST_SMALL + 1), key=lambda b: (cost(b), b))


def _cells(u: np.ndarray, cells: int) -> np.ndarray:
    return (u >> np.uint64(20)).astype(np.int64) & (cells - 1)


def _describe(cells: int, shingle: int):
    """Each row's set size and 128-bit fingerprint, and the task's share of the count sketch."""

    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, some = np.zeros(cells, np.uint16), False
        names = ["doc_id", "n_shingles", "hi", "lo", "chunk", "counts"]
        for batch in batches:
            n, hi, lo = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for row, u in shingle_sets(batch.column(1), shingle):
                n[row] = len(u)
                if len(u):
                    hi[row], lo[row] = (np.add.reduce(mix(u, k)).view(np.int64) for k in (11, 12))
                    at = _cells(u, cells)
                    counts[at] += counts[at] < 65535
                    some = True
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(hi), pa.array(lo), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], names=names)
        if some:
            parts = counts.reshape(-1, min(CHUNK, cells))
            used = [k for k in range(len(parts)) if parts[k].any()]
            none = [None] * len(used)
            yield pa.RecordBatch.from_arrays([*(pa.array(none, pa.int64()) for _ in range(4)), pa.array(used, pa.int32()), pa.array([parts[k].tobytes() for k in used], pa.binary())], names=names)

    return run


@freed
def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the chunks that this task gets."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = np.frombuffer(counts, np.uint16).astype(np.uint64)
            total[chunk] = total[chunk] + x if chunk in total else x
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([short(x).tobytes() for x in total.values()], pa.binary())], names=["chunk", "counts"])


def short(counts: np.ndarray) -> np.ndarray:
    """The upper halves of counts as floats of 4 bytes: in the order of the counts, and never above them."""
    return (counts.astype(np.float32).view(np.uint32) >> np.uint32(16)).astype("<u2")


def long(codes: np.ndarray) -> np.ndarray:
    return (codes.astype(np.uint32) << np.uint32(16)).view(np.float32).astype(np.uint64)


def _parity(u: np.ndarray) -> bytes:
    """One bit for each hash value: whether an odd number of shingles has it. As many bits as shingles, about."""
    bits = max(64, 1 << int(len(u) - 1).bit_length()) if len(u) else 64
    return np.packbits(np.bincount((u >> np.uint64(3)).astype(np.int64) & (bits - 1), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


SUBSET, RARE, BITS = range(3)


def _signatures(sketch, cells: int, percent: int, boundary: int, shingle: int, list_rows: int):
    """Rows by kind: SUBSET (size c in place); RARE, a rare shingle of the set (its place in the order); BITS, the bitmap."""
    lists_from = -(-percent * boundary // 100)

    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sketch.value
        for batch in batches:
            ids = np.asarray(batch.column(0))
            out: dict[str, list] = {k: [] for k in ("kind", "key", "doc", "n", "place")}
            bits_of, bits = [], []

            def put(kind: int, key: np.ndarray, row: int, n: int, place: np.ndarray) -> None:
                out["kind"].append(np.full(len(key), kind, np.int32))
                out["key"].append(key)
                out["doc"].append(np.full(len(key), ids[row], np.int64))
                out["n"].append(np.full(len(key), n, np.int32))
                out["place"].append(place.astype(np.int32))

            def flush():
                k = {x: np.concatenate(y) if y else np.zeros(0, np.int64) for x, y in out.items()}
                kinds = k["kind"].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(kinds), pa.array(k["key"].astype(np.uint64).view(np.int64)), pa.array(k["doc"].astype(np.int64)), pa.array(k["n"].astype(np.int32)), pa.array(k["place"].astype(np.int32)), pa.nulls(len(kinds), pa.binary())], names=names)
                yield pa.RecordBatch.from_arrays([pa.array([BITS] * len(bits), pa.int32()), pa.nulls(len(bits), pa.int64()), pa.array(bits_of, pa.int64()), pa.nulls(len(bits), pa.int32()), pa.nulls(len(bits), pa.int32()), pa.array(bits, pa.binary())], names=names)
                for x in (*out.values(), bits_of, bits):
                    x.clear()

            names = ["kind", "key", "doc", "n", "place", "bits"]
            held = 0
            for row, u in shingle_sets(batch.column(1), shingle):
                n = len(u)
                if not n:
                    continue
                if n < boundary:
                    for c in subset_sizes(n, percent, boundary):
                        key = np.add.reduce(mix(u[np.array(list(combinations(range(n), c)))], 21), axis=1)
                        put(SUBSET, mix(key, 22 + c), row, n, np.full(len(key), c))
                if n >= lists_from:
                    order = (counts[_cells(u, cells)].astype(np.uint64) << np.uint64(48)) | (u >> np.uint64(16))
                    p = min(prefix(n, percent), n)
                    first = np.sort(np.partition(order, p - 1)[:p])
                    parts = np.minimum(long(first >> np.uint64(48)) // np.uint64(list_rows) + np.uint64(1), np.uint64(255))
                    part = np.where(parts > 1, mix(first ^ np.uint64(ids[row] & (2**63 - 1))) % parts + np.uint64(1), np.uint64(0))
                    put(RARE, (first << np.uint64(8)) | part, row, n, np.arange(p))
                    bits_of.append(int(ids[row]))
                    bits.append(_parity(u))
                    held += p
                if held > 50_000:
                    yield from flush()
                    held = 0
            yield from flush()

    return run


def _unlike(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Bits in which the bitmaps of a and b differ, the longer one folded to the shorter: no more than their sets do."""
    out = np.zeros(len(a), np.int64)
    for k, (x, y) in enumerate(zip(*(x.to_numpy(zero_copy_only=False).tolist() for x in (a, b)), strict=True)):
        x, y = sorted((np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)), key=len)
        out[k] = np.bitwise_count(x ^ np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)).sum()
    return out


def _could(percent: int):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (np.asarray(batch.column(k)).astype(np.int64) for k in (2, 3))
            most = (n + m - _unlike(batch.column(4), batch.column(5))) // 2
            yield batch.select([0, 1, 2, 3]).filter(pa.array((100 + percent) * most >= percent * (n + m)))

    return run


def _as_sets(shingle: int):
    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sets, held = [], [], 0
            for row, u in shingle_sets(batch.column(1), shingle):
                rows.append(row)
                sets.append(u.tobytes())
                held += len(sets[-1])
                if held > 4 << 20:
                    yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(rows)) for k in (0, 2, 3)), pa.array(sets, pa.large_binary()).cast(pa.binary())], names=["doc", "centre", "part", "members"])
                    rows, sets, held = [], [], 0
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(rows, pa.int64())) for k in (0, 2, 3)), pa.array(sets, pa.binary())], names=["doc", "centre", "part", "members"])

    return run


def _against_centre(percent: int):
    """Rows sorted by (centre, part), the centre's own first: the others are intersected with it."""

    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            a, b = [], []
            docs, centres, parts, members = (batch.column(k).to_numpy(zero_copy_only=False).tolist() for k in range(4))
            for doc, centre, part, raw in zip(docs, centres, parts, members, strict=True):
                u = np.frombuffer(raw, np.uint64)
                if (centre, part) != at:
                    at, own = (centre, part), np.zeros(0, np.uint64)
                if doc == centre:
                    own = np.union1d(own, u) if len(own) else u
                    continue
                both = np.intersect1d(own, u, assume_unique=True).size if len(own) else 0
                if both and 100 * both >= percent * (len(own) + len(u) - both):
                    a.append(doc)
                    b.append(centre)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _bounded(pairs: DataFrame, bitmaps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, n, m) that sizes and bitmaps don't rule out."""
    x = bitmaps.select(F.col("doc").alias("da"), F.col("bits").alias("bits_a"))
    y = bitmaps.select(F.col("doc").alias("db"), F.col("bits").alias("bits_b"))
    both = pairs.join(x, F.col("a") == F.col("da")).join(y, F.col("b") == F.col("db"))
    return both.select("a", "b", "n", "m", "bits_a", "bits_b").mapInArrow(_could(percent), "a long, b long, n int, m int")


def _verified(pairs: DataFrame, texts: DataFrame, percent: int, shingle: int, name: str) -> DataFrame:
    """Pairs (a, b) whose sets do link. Each pair sends a's set to b's; a centre of many is copied for every PER_CENTRE."""
    pairs = stored(pairs.select("a", "b"), f"{name}-pairs")
    many = pairs.groupBy(F.col("b").alias("centre")).agg(F.ceil(F.count("*") / PER_CENTRE).cast("int").alias("parts"))
    sent = pairs.join(many, F.col("b") == F.col("centre")).select(F.col("a").alias("doc"), "centre", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("part"))
    own = many.select(F.col("centre").alias("doc"), "centre", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    asked = stored(sent.unionByName(own), f"{name}-asked")
    sets = texts.join(small(asked), F.col("doc_id") == F.col("doc")).select("doc", "text", "centre", "part").mapInArrow(_as_sets(shingle), "doc long, centre long, part int, members binary")
    dealt = sets.repartition("centre", "part").sortWithinPartitions("centre", "part", F.col("doc") != F.col("centre"))
    return stored(dealt.mapInArrow(_against_centre(percent), "a long, b long"), f"{name}-links")


def jaccard_classes(docs: DataFrame, percent: int = 80, shingle: int = SHINGLE, list_rows: int = LIST_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of docs(doc_id, text, ...).

    Two texts link when 100 * common shingles >= percent * shingles of either. component_id is the least doc_id
    reachable by links, the row's own included. A null or empty text, and one without words, has no shingle and is
    its own component; fewer words than a shingle are one whole shingle. Rows that share a doc_id count as one
    document with the links of all of them; a row without doc_id keeps a null component unless a text equal to its
    own has one. Other columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    cells = LEAST_CELLS
    rows = docs.count()
    while cells < min(MOST_CELLS, CELLS_A_ROW * rows):
        cells *= 2

    described = stored(texts.mapInArrow(_describe(cells, shingle), "doc_id long, n_shingles long, hi long, lo long, chunk int, counts binary"), "described")
    merged = described.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(_add_up, "chunk int, counts binary")
    counts = np.zeros(cells, np.uint16)
    for chunk, part in merged.toLocalIterator():
        x = np.frombuffer(part, "<u2")
        counts[chunk * len(x) : (chunk + 1) * len(x)] = x
    sketch = spark.sparkContext.broadcast(counts)

    of = described.where("chunk is null").select("doc_id", "n_shingles", "hi", "lo")
    classes = stored(of.where("n_shingles > 0").groupBy("n_shingles", "hi", "lo").agg(F.min("doc_id").alias("least")), "classes")
    sizes = {r[0]: r[1] for r in classes.where(F.col("n_shingles") < LARGEST_SMALL).groupBy("n_shingles").count().collect()}
    boundary = choose_boundary(sizes, percent)

    kept = classes.where("least is not null").select(F.col("least").alias("rep")).distinct()
    others = of.select("doc_id").distinct().join(kept, F.col("doc_id") == F.col("rep"), "left_anti").select(F.col("doc_id").alias("copy"))
    others = stored(others, "copies")
    alone = texts.where("doc_id is not null").join(small(others), F.col("doc_id") == F.col("copy"), "left_anti")
    signed = stored(alone.mapInArrow(_signatures(sketch, cells, percent, boundary, shingle, list_rows), "kind int, key long, doc long, n int, place int, bits binary"), "signed", "kind")
    sketch.destroy()
    by_subset, lists, bitmaps = (signed.where(F.col("kind") == k).drop("kind") for k in (SUBSET, RARE, BITS))

    # Small sets: the smallest set of a subset links with each other one for which the subset is large enough.
    least = by_subset.groupBy(F.col("key").alias("k")).agg(F.min(F.struct("n", "doc")).alias("least"), F.min("doc").alias("from_"), F.max("doc").alias("to_")).where("from_ <> to_").select("k", "least")
    near = by_subset.join(least, F.col("key") == F.col("k"))
    small_links = near.where((F.col("doc") != F.col("least.doc")) & ((100 + percent) * F.col("place") >= percent * (F.col("n") + F.col("least.n")))).select(F.col("doc").alias("a"), F.col("least.doc").alias("b"))

    # Inverted lists of two sets and more, with the one of the least place as centre. A set that is alone in its part of
    # a dealt list, where the part isn't 0, stays for the last scan, which finds the list's other parts.
    w = Window.partitionBy("key")
    scanned = lists.withColumn("centre", F.min(F.struct("place", "n", "doc")).over(w)).withColumn("others", F.max("doc").over(w) != F.min("doc").over(w)).where(F.col("others") | (F.col("key").bitwiseAND(F.lit(255)) > 0))
    scanned = stored(scanned.select(F.col("key").bitwiseAND(F.lit(~255)).alias("key"), "doc", "n", "place", F.col("centre.doc").alias("centre"), F.col("centre.n").alias("m"), F.col("centre.place").alias("centre_place")), "lists")

    def fits(n, m, p, q):
        """Sizes and places leave room for a link whose first common shingle in the order is this one. A pair that
        links passes in the list of that shingle, so other lists needn't let it pass."""
        most = 1 + F.least(n - p - 1, m - q - 1)
        return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & ((100 + percent) * most >= percent * (n + m))

    star = scanned.where(F.col("doc") != F.col("centre")).where(fits(F.col("n"), F.col("m"), F.col("place"), F.col("centre_place")))
    star = star.groupBy(F.col("doc").alias("a"), F.col("centre").alias("b")).agg(F.first("n").alias("n"), F.first("m").alias("m"), F.count("*").alias("times"))
    star = stored(star, "star")
    possible = stored(_bounded(star, bitmaps, percent), "possible")
    timed = possible.join(star.select("a", "b", "times"), ["a", "b"])
    best = timed.groupBy("a").agg(F.max_by("b", F.struct("times", -F.col("b"))).alias("b"))
    links = stored(small_links.distinct(), "small").unionByName(_verified(best, texts, percent, shingle, "first"))

    def labels(of: DataFrame) -> DataFrame:
        return stored(components(of), "labels")

    def apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
        x = known.select(F.col("node").alias("na"), F.col("component").alias("ca"))
        y = known.select(F.col("node").alias("nb"), F.col("component").alias("cb"))
        joined = pairs.join(x, F.col("a") == F.col("na"), "left").join(y, F.col("b") == F.col("nb"), "left")
        return joined.where(F.coalesce("ca", "a") != F.coalesce("cb", "b"))

    known = labels(links)
    tried = best
    rest = apart(possible, known).join(tried, ["a", "b"], "left_anti").select("a", "b")
    links = links.unionByName(_verified(rest, texts, percent, shingle, "second"))
    known = labels(links)

    # What is left: pairs of a list that are in different components.
    named = scanned.join(known, F.col("doc") == F.col("node"), "left").select("key", "doc", "n", "place", F.coalesce("component", "doc").alias("label"))
    mixed = named.groupBy(F.col("key").alias("k")).agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("k")
    left = stored(named.join(mixed, F.col("key") == F.col("k"), "left_semi"), "left")
    right = left.select(F.col("key").alias("k"), F.col("doc").alias("d"), F.col("n").alias("m"), F.col("place").alias("q"), F.col("label").alias("other"))
    # the smaller set of a pair must have room for an overlap with one of its own size
    right = right.where((100 + percent) * (F.col("m") - F.col("q")) >= 2 * percent * F.col("m"))
    cross = left.join(right, (F.col("key") == F.col("k")) & (F.col("label") != F.col("other")) & (F.struct("n", "doc") > F.struct("m", "d")))
    cross = cross.where(fits(F.col("n"), F.col("m"), F.col("place"), F.col("q"))).select(F.col("doc").alias("a"), F.col("d").alias("b"), "n", "m").distinct()
    cross = cross.join(star.select("a", "b"), ["a", "b"], "left_anti")
    links = links.unionByName(_verified(_bounded(cross, bitmaps, percent), texts, percent, shingle, "last"))
    known = labels(links)

    named = classes.join(known, F.col("least") == F.col("node"), "left").select(F.col("n_shingles").alias("n"), F.col("hi").alias("h"), F.col("lo").alias("l"), F.coalesce("component", "least").alias("component_id"))
    same = (F.col("n_shingles") == F.col("n")) & (F.col("hi") == F.col("h")) & (F.col("lo") == F.col("l"))
    result = of.join(named, same, "left")
    return result.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
