"""Repeated byte strings by radix passes over suffixes, which go no deeper than the threshold.

Each window of the threshold's length is a suffix cut off at that depth; the passes split the suffixes into groups, the
most significant digit first, and drop those that are alone. Groups that are left after the last pass are exactly the
repeated windows.

* The first digit of a window is the string of GRAM bytes in it with the least hash, and its place there; equal windows
  have the same. Adjacent windows nearly always share the string, so they travel as one item: its place and the range
  of distances at which they begin before it. There is an item for every 150 bytes or so instead of a row a byte.
* The next digits halve down the range, eight ways a pass, until an item is one window: the digit of a part of the
  range is what all windows in it have in common. An item also knows all bytes that its windows cover. Where two items
  agree in those, all their windows repeat and the item is done; where nobody shares the digit, none does.
* Of items that agree in all their bytes, one goes on for all, to meet those that agree in a part. From the second pass
  on, items carry their own bytes; texts are joined once for those and once for the result, compressed on the way.

A task merges its own equal items before anything is shuffled, so a run of one character costs a row. Counts are
aggregates with map-side combine, joined back; no task holds a group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import freed, stored
from .shingles import mix, powers, text_slices

WINDOW, GRAM = 400, 100
#: Ways in which a pass splits an item, and bytes of a part of a long text.
FANOUT, PART = 8, 1 << 18

_values = [mix(np.arange(1, 257, dtype=np.uint64), seed) for seed in (31, 32)]
ITEM = "_row long, at long, p long, lo int, hi int, core long, hull long, n long"


class _Hashes:
    """Two polynomial hashes of any part of data, from running sums."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.runs = []
        for values in _values:
            run = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(values[data] * up[: len(data)], out=run[1:])
            self.runs.append(run)

    def of(self, kind: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.runs[kind][end] - self.runs[kind][start]) * self.down[start]


def _parts(texts: pa.Array) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, place, bytes, offsets) of consecutive whole texts, or of the part of a long one from place
    on. Parts overlap so that each window is whole in exactly one of them."""
    for lo, hi, data, offsets in text_slices(texts):
        if len(data) <= PART:
            yield lo, hi, 0, data, offsets
        else:
            for a in range(0, len(data), PART):
                part = data[a : a + PART + WINDOW - 1]
                yield lo, hi, a, part, np.array([0, len(part)])


def _items(hashes: _Hashes, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(p, lo, hi): the place of the least string of each window, and how far before it windows with that string begin."""
    n, wide = int(offsets[-1]), window - gram + 1
    if n < window:
        return (np.zeros(0, np.int64),) * 3
    at = np.arange(n - gram + 1)
    least = (mix(hashes.of(0, at, at + gram), 33) & ~np.uint64((1 << 20) - 1)) | at.astype(np.uint64)
    span = 1
    while 2 * span <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[: len(least) - (wide - span)], least[wide - span :])
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    start = np.flatnonzero(np.arange(len(least)) + window <= ends)
    if not len(start):
        return (np.zeros(0, np.int64),) * 3
    p = (least[start] & np.uint64((1 << 20) - 1)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, p[1:] != p[:-1]])
    p = p[new]
    return p, p - start[np.r_[new[1:], len(start)] - 1], p - start[new]


def _merged(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans that overlap or touch as one; rows lie one after the other."""
    if not len(start):
        return row, start, end
    order = np.argsort(start, kind="stable")
    row, start, end = row[order], start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.r_[True, (start[1:] > end[:-1]) | (row[1:] != row[:-1])])
    return row[new], start[new], end[np.r_[new[1:], len(end)] - 1]


def _digits(window: int, gram: int, size: int):
    """Items of (row, at, text) or, after the first pass, of (row, at, text, items), text being the document's bytes from
    place `at` on: split into parts of `size` distances, equal ones of a part of the input merged. A row without core is
    a span that is repeated: p is its start, n its length."""
    wide = window - gram + 1

    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, begin, given = np.asarray(batch.column(0)), np.asarray(batch.column(1)), None
            if batch.num_columns > 3:
                items = batch.column(3)
                of = np.repeat(np.arange(len(items)), np.asarray(items.value_lengths()))
                given = (of, *(np.asarray(x) for x in items.flatten().flatten()))
            for first, last, place, data, offsets in _parts(batch.column(2)):
                if given is not None:
                    mine = (given[0] >= first) & (given[0] < last)
                    if not mine.any():
                        continue
                hashes = _Hashes(data)
                if given is None:
                    p, lo, hi = _items(hashes, offsets, window, gram)
                else:
                    of, p, lo, hi = (x[mine] for x in given)
                    p, lo, hi = p - begin[of] + offsets[of - first], lo.astype(np.int64), hi.astype(np.int64)
                many = hi // size - lo // size + 1
                k = np.repeat(np.arange(len(p)), many)
                node = lo[k] // size + np.arange(len(k)) - np.repeat(np.cumsum(many) - many, many)
                a, b = node * size, np.minimum(node * size + size - 1, wide - 1)
                p, lo, hi = p[k], np.maximum(lo[k], a), np.minimum(hi[k], b)
                core = mix(hashes.of(0, p - a, p - b + window) ^ mix((a * wide + b).astype(np.uint64), 34), 35)
                hull = mix(hashes.of(1, p - hi, p - lo + window) ^ mix((lo * wide + hi).astype(np.uint64), 36), 37)
                order = np.lexsort((p, hull, core))
                p, lo, hi, core, hull = (x[order] for x in (p, lo, hi, core, hull))
                new = np.r_[True, (core[1:] != core[:-1]) | (hull[1:] != hull[:-1])][: len(p)]
                row = np.searchsorted(offsets, p, "right") - 1
                spans = _merged(row[~new], (p - hi)[~new], (p - lo + window)[~new])
                count = np.diff(np.r_[np.flatnonzero(new), len(p)]) if len(p) else np.zeros(0, np.int64)
                p, lo, hi, core, hull, row = (x[new] for x in (p, lo, hi, core, hull, row))
                base = begin[first:last] + place - offsets[:-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(np.r_[x[first + row], x[first + spans[0]]].astype(np.int64)) for x in (ids, begin)),
                        pa.array(np.r_[p + base[row], spans[1] + base[spans[0]]]),
                        *(pa.array(np.r_[x, np.zeros(len(spans[0]), np.int64)].astype(np.int32)) for x in (lo, hi)),
                        *(pa.concat_arrays([pa.array(x.view(np.int64)), pa.nulls(len(spans[0]), pa.int64())]) for x in (core, hull)),
                        pa.array(np.r_[count, spans[2] - spans[1]]),
                    ],
                    names=["_row", "at", "p", "lo", "hi", "core", "hull", "n"],
                )

    return run


@freed
def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, a text, compressed, and its bytes."""
    codec = pa.Codec("zstd", 1)
    for batch in batches:
        texts = [t or b"" for t in batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()]
        own = [pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary()), pa.array(map(len, texts), pa.int64())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *own], names=[*batch.schema.names[:-1], "packed", "n_bytes"])


def _unpacked(packed: pa.Array, sizes: pa.Array) -> Iterator[np.ndarray]:
    codec = pa.Codec("zstd")
    for p, n in zip(packed, sizes.to_pylist(), strict=True):
        yield np.frombuffer(codec.decompress(p.as_buffer(), n), np.uint8) if n else np.zeros(0, np.uint8)


def _places(lists: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each row's part of the fields of a list of structs begins, and the fields."""
    return np.r_[0, np.cumsum(np.asarray(lists.value_lengths().fill_null(0)))], [np.asarray(x) for x in lists.flatten().flatten()]


def _cut_out(window: int):
    """Of (row, packed, n_bytes, items): each item with the bytes of its windows, as (row, at, text, items)."""

    @freed
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            upto, (_, p, lo, hi) = _places(batch.column(3))
            texts = []
            for row, data in enumerate(_unpacked(batch.column(1), batch.column(2))):
                texts += [data[p[k] - hi[k] : p[k] - lo[k] + window].tobytes() for k in range(upto[row], upto[row + 1])]
            items = pa.StructArray.from_arrays([pa.array(x) for x in (p, lo, hi)], ["p", "lo", "hi"])
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.asarray(batch.column(0)), np.diff(upto))), pa.array(p - hi), pa.array(texts, pa.binary()), pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1, dtype=np.int32)), items)], names=["_row", "at", "text", "items"])

    return run


@freed
def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (doc_id, packed, n_bytes, spans in any order): what the text keeps, and its removed runs."""
    for batch in batches:
        upto, (start, end) = _places(batch.column(3))
        spans, kept = [], []
        for row, data in enumerate(_unpacked(batch.column(1), batch.column(2))):
            at = slice(upto[row], upto[row + 1])
            _, a, b = _merged(np.zeros(len(start[at]), np.int64), start[at], end[at])
            spans.append([{"start": x, "end": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)])
            kept.append(b"".join(data[x:y].tobytes() for x, y in zip(np.r_[0, b], np.r_[a, len(data)], strict=True)))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])


def _by(of: DataFrame, keys: tuple[str, ...], name: str, *columns: str) -> DataFrame:
    """One row for each value of the keys, under names with a line before them, with an array of its items."""
    return of.groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(F.collect_list(F.struct(*columns)).alias(name))


def repeated_spans(texts: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(_row, start, end) of texts(_row, text): spans whose union is every byte of a window that starts elsewhere too."""
    if not 1 <= gram <= window:
        raise ValueError("a window holds one gram at least")
    wide, sizes = window - gram + 1, [1]
    while sizes[0] * FANOUT < wide:
        sizes.insert(0, sizes[0] * FANOUT)
    if wide > 1:
        sizes.insert(0, wide)
    found, rows = None, texts.select("_row", F.lit(0).cast("long").alias("at"), "text")
    for size in sizes:
        digits = stored(rows.mapInArrow(_digits(window, gram, size), ITEM), "digits")
        items = digits.where("core is not null")
        cores = items.groupBy(F.col("core").alias("c")).agg(F.sum("n").alias("m"), (F.min("hull") != F.max("hull")).alias("mixed")).where("m > 1")
        shared = stored(items.join(cores, F.col("core") == F.col("c")).drop("c", "m"), "shared")
        mixed = shared.where("mixed")
        classes = stored(mixed.groupBy("core", "hull").agg(F.sum("n").alias("m"), F.min(F.struct("_row", "at", "p", "lo", "hi")).alias("item")), "classes")
        again = classes.where("m > 1").select(F.col("core").alias("c"), F.col("hull").alias("h"))
        done = shared.where("not mixed").select(*items.columns).unionByName(mixed.join(again, (F.col("core") == F.col("c")) & (F.col("hull") == F.col("h")), "left_semi").select(*items.columns))
        spans = digits.where("core is null").select("_row", F.col("p").alias("start"), (F.col("p") + F.col("n")).alias("end"))
        spans = spans.unionByName(done.select("_row", (F.col("p") - F.col("hi")).alias("start"), (F.col("p") - F.col("lo") + window).alias("end")))
        found = spans if found is None else found.unionByName(spans)
        open_ = classes.select("item.*")
        if size == wide > 1:
            packed = texts.select("_row", "text").mapInArrow(_packed, "_row long, packed binary, n_bytes long")
            joined = packed.join(_by(open_, ("_row",), "items", "at", "p", "lo", "hi"), F.col("_row") == F.col("__row"))
            cuts = stored(joined.select("_row", "packed", "n_bytes", "items").mapInArrow(_cut_out(window), "_row long, at long, text binary, items array<struct<p:long,lo:int,hi:int>>"), "cuts")
            rows = cuts
        elif size > 1:
            given = _by(open_, ("_row", "at"), "items", "p", "lo", "hi")
            rows = cuts.drop("items").join(given, (F.col("_row") == F.col("__row")) & (F.col("at") == F.col("_at"))).select("_row", "at", "text", "items")
    return found


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of each row of docs(doc_id, text, ...): its text as UTF-8 bytes without each byte
    that a string of `window` bytes covers which also starts at another place, in this text or another one. Strings are
    judged on the input; overlaps count. spans are the maximal removed runs, kept the other bytes in a row.

    A null text is empty. Every row is a text of its own, also without doc_id or with a shared one. Other columns
    aren't read; an empty table gives an empty result. gram is the length of a window's first digit: exact for any.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if texts.count() == texts.where("doc_id is not null").select("doc_id").distinct().count():
        texts = texts.withColumn("_row", F.col("doc_id"))
    else:  # numbers are stored with the rows, so that they stay the same when a task runs again
        texts = stored(texts.withColumn("_row", F.monotonically_increasing_id()), "texts")
    spans = _by(repeated_spans(texts, window, gram), ("_row",), "spans", "start", "end")
    packed = texts.select("doc_id", "_row", "text").mapInArrow(_packed, "doc_id long, _row long, packed binary, n_bytes long")
    joined = packed.join(spans, F.col("_row") == F.col("__row"), "left")
    return joined.select("doc_id", "packed", "n_bytes", "spans").mapInArrow(_without, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")


def digest(docs: DataFrame) -> DataFrame:
    out = without_repeats(docs)
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
