"""An inverted index of a table of texts: postings with positions, in sorted runs, and bounds by block.

All of a document's words are in its own row, so its postings are made where it is read, and only bounds are shuffled. A
task sorts postings by (term, doc_id) in runs of bounded size and writes them one after the other; a lookup of a few
terms reads a page or so of each run, which Parquet finds by the pages' least and greatest terms. Runs grow with the
texts, and no task holds all of a term. Blocks are ranges of doc_id; for each term and block the index has the greatest
count and the least length, which bound what any document of the block can score.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.sources.checkpoints import cut

BLOCK = 1024
#: Words of a run, from which a text may add its own.
RUN_WORDS = 2_000_000
#: Rows up to which a side is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000
#: The empty term, which is no word, stands for the documents: each has one posting of it, without places.
DOCUMENT = ""
POSTINGS = "term string, doc_id bigint, block bigint, len int, tf int, positions array<int>"
BLOCKS = "term string, block bigint, docs bigint, most int, shortest int"


def words_of(text: Column) -> Column:
    """Runs of letters and digits in lower case."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


class TextIndex:
    """The index under `at`, any folder that Spark can write."""

    def __init__(self, spark: SparkSession, at: str):
        self.spark, self.at = spark, at.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.at}/{name}")

    def postings(self, terms: list[str]) -> DataFrame:
        return self._read("postings", POSTINGS).where(F.col("term").isin(terms))

    def totals(self) -> DataFrame:
        """One row: documents and their mean length."""
        return self.postings([DOCUMENT]).agg(F.count("*").alias("n"), F.avg("len").alias("mean"))


def _run(held: list[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """The postings of batches (doc_id, words), ordered by (term, doc_id)."""
    docs = pa.Table.from_batches(held).sort_by("doc_id").combine_chunks()
    ids, lists = docs.column(0).to_numpy(), docs.column(1).combine_chunks()
    size = pc.list_value_length(lists).to_numpy()
    coded = lists.flatten().dictionary_encode()
    rank = np.empty(len(coded.dictionary), np.int64)
    order = pc.sort_indices(coded.dictionary)
    rank[order] = np.arange(len(rank))
    doc = np.repeat(np.arange(len(ids)), size)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
    key = rank[coded.indices] * len(ids) + doc
    by_key = np.argsort(key, kind="stable")  # places stay in order
    key = key[by_key]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    term, doc = np.divmod(key[first], len(ids))
    at = np.append(first, len(key))
    # the documents' own rows come first, as the empty term does
    terms = pa.concat_arrays([pa.repeat(DOCUMENT, len(ids)), coded.dictionary.take(order).take(pa.array(term))])
    doc = np.concatenate([np.arange(len(ids)), doc])
    tf = np.concatenate([np.zeros(len(ids), np.int64), np.diff(at)])
    ends = np.concatenate([np.zeros(len(ids), np.int64), at]).astype(np.int32)
    positions = pa.ListArray.from_arrays(pa.array(ends), pa.array(place[by_key].astype(np.int32)))
    columns = [terms, pa.array(ids[doc]), pa.array(ids[doc] // block), pa.array(size[doc].astype(np.int32)), pa.array(tf.astype(np.int32)), positions]
    yield from pa.table(columns, names=["term", "doc_id", "block", "len", "tf", "positions"]).to_batches(max_chunksize=20_000)


def _runs(block: int, run_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = [], 0
        for batch in batches:
            ends, lo = np.cumsum(pc.list_value_length(batch.column(1)).to_numpy()), 0
            while lo < len(batch):
                done = ends[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(ends, done + run_words, "right")))
                held.append(batch.slice(lo, hi - lo))
                words, lo = words + ends[hi - 1] - done, hi
                if words >= run_words:
                    yield from _run(held, block)
                    held, words = [], 0
        if held:
            yield from _run(held, block)

    return run


def build(docs: DataFrame, at: str, block: int = BLOCK, run_words: int = RUN_WORDS) -> TextIndex:
    """The index of docs(doc_id, text). Rows without doc_id aren't in it; rows that share one are one document whose
    texts follow each other, in their order as strings. A null or empty text is a document without words."""
    spark, index = docs.sparkSession, TextIndex(docs.sparkSession, at)
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    shared = cut(rows.groupBy("doc_id").count().where("count > 1").select(F.col("doc_id").alias("_id")))
    n = shared.count()
    if n:
        some = F.broadcast(shared) if n <= BROADCAST_ROWS else shared
        alone = rows.join(some, F.col("doc_id") == F.col("_id"), "left_anti")
        joined = rows.join(some, F.col("doc_id") == F.col("_id"), "left_semi").groupBy("doc_id").agg(F.array_join(F.array_sort(F.collect_list("text")), " ").alias("text"))
        rows = alone.unionByName(joined)
    postings = rows.select("doc_id", words_of(F.col("text")).alias("words")).mapInArrow(_runs(block, run_words), POSTINGS)
    postings.write.option("compression", "zstd").parquet(f"{index.at}/postings")
    bounds = index._read("postings", POSTINGS).where(F.col("term") != DOCUMENT).groupBy("term", "block").agg(F.count("*").alias("docs"), F.max("tf").alias("most"), F.min("len").alias("shortest"))
    bounds.sortWithinPartitions("term", "block").write.option("compression", "zstd").parquet(f"{index.at}/blocks")
    return index


def _score(tf: Column, length: Column, k1: float, b: float) -> Column:
    """A term's part of BM25. It grows with tf and falls with length."""
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / F.col("mean")))


def bm25(index: TextIndex, terms: list[str], k: int | None = None, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(doc_id, score) of the documents that hold a term; the k best if k is given, best first, ties by doc_id.

    No text is read. With k, the blocks of greatest bound are scored first, as many as hold k documents for sure; then
    those whose bound reaches the k-th score found there, so blocks that can't hold one of the k best are never read.
    """
    terms = list(dict.fromkeys(terms))
    found = index._read("blocks", BLOCKS).where(F.col("term").isin(terms))
    # one row a term, with the totals beside it
    about = F.broadcast(cut(found.groupBy(F.col("term").alias("t")).agg(F.sum("docs").alias("df")).crossJoin(index.totals())))

    def scored(postings: DataFrame) -> DataFrame:
        each = postings.join(about, F.col("term") == F.col("t")).select("doc_id", "term", _score(F.col("tf"), F.col("len"), k1, b).alias("part"))
        parts = each.groupBy("doc_id").agg(*(F.max(F.when(F.col("term") == t, F.col("part"))).alias(f"_{i}") for i, t in enumerate(terms)))
        # terms are added in the order in which they were given, so sums don't depend on the order of rows
        return parts.select("doc_id", F.round(reduce(lambda x, y: x + y, (F.coalesce(f"_{i}", F.lit(0.0)) for i in range(len(terms))), F.lit(0.0)), 9).alias("score"))

    everything = index.postings(terms).select("term", "doc_id", "block", "len", "tf")
    if k is None:
        return scored(everything)
    bounds = cut(found.join(about, F.col("term") == F.col("t")).groupBy("block").agg(F.sum(_score(F.col("most"), F.col("shortest"), k1, b)).alias("bound"), F.max("docs").alias("docs")))
    # a block of bound x holds its largest term's documents; k blocks hold k documents at least
    first = bounds.orderBy(F.desc("bound"), "block").limit(k).select(F.col("block").alias("_b"))
    sure = scored(everything.join(F.broadcast(first), F.col("block") == F.col("_b"), "left_semi")).orderBy(F.desc("score"), "doc_id").limit(k)
    least = sure.agg(F.when(F.count("*") == k, F.min("score")).otherwise(F.lit(0.0)).alias("least"))
    # scores are rounded, so a bound may fall short of a score by half a unit of the ninth place
    able = bounds.crossJoin(F.broadcast(least)).where(F.col("bound") >= F.col("least") - 1e-8).select(F.col("block").alias("_b"))
    return scored(everything.join(able, F.col("block") == F.col("_b"), "left_semi")).orderBy(F.desc("score"), "doc_id").limit(k)


def phrase(index: TextIndex, words: list[str]) -> DataFrame:
    """(doc_id, times) of the documents that hold the words one after the other, and at how many places."""
    if not words:
        raise ValueError("a phrase has a word at least")
    postings = index.postings(list(dict.fromkeys(words))).select("term", "doc_id", "positions")
    after = F.array(*(F.struct(F.lit(w).alias("word"), F.lit(i).alias("i")) for i, w in enumerate(words)))
    each = postings.select("doc_id", "term", "positions", F.explode(after).alias("a")).where("term = a.word")
    starts = each.select("doc_id", F.col("a.i").alias("i"), F.explode("positions").alias("p")).select("doc_id", (F.col("p") - F.col("i")).alias("start"))
    whole = starts.groupBy("doc_id", "start").agg(F.count("*").alias("c")).where(F.col("c") == len(words))
    return whole.groupBy("doc_id").agg(F.count("*").alias("times"))
