"""A file of vectors by cells: k-means centres from a bounded sample, every vector stored with its nearest centre.

A query goes to the cells of its nearest centres and is scored there exactly. Angles obey the triangle inequality, so a
cell's radius bounds the score of all that it holds; the exact way then visits each other cell whose bound reaches the
query's k-th score. What a task gets is a group of bounded size of one cell's vectors and of its queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.operators.search import GROUP_ROWS, top_of_groups, usable
from graphloom.sources.checkpoints import cut

#: Vectors of a cell, on average, up to MOST_CELLS cells; centres are fitted on about SAMPLE_OF_CELL vectors for each cell.
CELL_ROWS, MOST_CELLS, SAMPLE_OF_CELL = 500, 4_096, 64
ROUNDS, SEED = 15, 7
#: Cells that a query visits first.
PROBES = 8
#: By so much an angle may be wrong: the arc cosine of a rounded cosine near 1.
SLACK = 1e-6
VECTORS = "cell int, vec_id bigint, embedding array<double>"
CELLS = "cell int, n bigint, radius double"


class VectorIndex:
    """The index under `at`, any folder that Spark can write."""

    def __init__(self, spark: SparkSession, at: str):
        self.spark, self.at = spark, at.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.at}/{name}")

    def vectors(self) -> DataFrame:
        return self._read("vectors", VECTORS)

    def cells(self) -> DataFrame:
        """(cell, n, radius): vectors of each cell and the greatest angle between one of them and its centre."""
        return self._read("cells", CELLS)

    def centres(self) -> np.ndarray:
        """Unit vectors, one a cell, MOST_CELLS at most."""
        rows = self._read("centres", "cell int, centre array<double>").orderBy("cell").collect()
        return np.array([r["centre"] for r in rows], np.float64)


def _angles(rows: pa.Array, centres: np.ndarray) -> np.ndarray:
    """The angle of each row and each centre; the widest where a row's length isn't a finite number."""
    v = np.asarray(rows.flatten(), np.float64).reshape(len(rows), -1)
    with np.errstate(all="ignore"):
        return np.nan_to_num(np.arccos(np.clip(v @ centres.T / np.sqrt((v * v).sum(1))[:, None], -1, 1)), nan=np.pi)


def _placed(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                angle = _angles(b.column(1), centres)
                cell = angle.argmin(1)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), *b.columns, pa.array(angle[np.arange(len(cell)), cell])], names=["cell", "vec_id", "embedding", "angle"])

    return run


def build(vectors: DataFrame, at: str, cells: int | None = None) -> VectorIndex:
    """The index of vectors(vec_id, embedding), all of one length. Vectors that are null, empty, zero or hold a null or
    non-finite component aren't in it; repeated rows are vectors each; an empty table gives an empty index.

    Centres come from a sample by hash of about SAMPLE_OF_CELL rows a cell; every vector is stored, in the order of cells.
    """
    spark, index = vectors.sparkSession, VectorIndex(vectors.sparkSession, at)
    rows = cut(usable(vectors))
    n = rows.count()
    cells = min(MOST_CELLS, max(1, -(-n // CELL_ROWS))) if cells is None else cells
    share = min(1.0, SAMPLE_OF_CELL * cells / max(1, n))
    some = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_000)) < share * 1_000_000) if share < 1 else rows
    sample = cut(some.select(array_to_vector("embedding").alias("features")))
    if sample.isEmpty():
        sample = cut(rows.limit(cells).select(array_to_vector("embedding").alias("features")))
    found = []
    if n:
        model = KMeans(k=max(2, cells), maxIter=ROUNDS, seed=SEED, distanceMeasure="cosine").fit(sample)
        found = [c / np.sqrt(c @ c) for c in model.clusterCenters() if c @ c > 0] or [np.eye(1, len(model.clusterCenters()[0]))[0]]
    spark.createDataFrame([(k, [float(x) for x in c]) for k, c in enumerate(found)], "cell int, centre array<double>").coalesce(1).write.parquet(f"{index.at}/centres")
    placed = rows.mapInArrow(_placed(np.array(found)), f"{VECTORS}, angle double")
    placed.repartitionByRange("cell", "vec_id").sortWithinPartitions("cell", "vec_id").write.parquet(f"{index.at}/vectors")
    stored = spark.read.schema(f"{VECTORS}, angle double").parquet(f"{index.at}/vectors")
    stored.groupBy("cell").agg(F.count("*").alias("n"), F.max("angle").alias("radius")).coalesce(1).write.parquet(f"{index.at}/cells")
    return index


def _routed(centres: np.ndarray, radius: np.ndarray, probes: int, rest: bool):
    """The cells that a query visits: its nearest ones, or all others whose bound reaches its score `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            angle = _angles(b.column(1), centres)
            angle[:, radius < 0] = np.inf  # cells that hold nothing
            near = np.zeros(angle.shape, bool)
            np.put_along_axis(near, np.argsort(angle, axis=1, kind="stable")[:, :probes], True, 1)
            if rest:
                bound = np.cos(np.minimum(np.pi, np.maximum(0, angle - radius - SLACK)))
                wanted = ~near & (bound >= np.asarray(b.column(2))[:, None] - 1e-8)
            else:
                wanted = near
            wanted &= radius >= 0
            at, cell = np.nonzero(wanted)
            for lo in range(0, len(at), 1_000):  # copies of a query in small batches
                own = pa.array(at[lo : lo + 1_000])
                yield pa.RecordBatch.from_arrays([pa.array(cell[lo : lo + 1_000].astype(np.int32)), b.column(0).take(own), b.column(1).take(own)], names=["cell", "vec_id", "embedding"])

    return run


def _visited(index: VectorIndex, routed: DataFrame, k: int, group_rows: int) -> DataFrame:
    """The k best of each group of vectors for each query that comes to its cell."""
    routed = cut(routed)
    parts = lambda n: F.ceil(F.col(n) / group_rows).cast("int")
    come = routed.groupBy(F.col("cell").alias("c")).agg(F.count("*").alias("come"))
    # a row a cell, MOST_CELLS at most
    groups = F.broadcast(index.cells().join(come, F.col("cell") == F.col("c")).select("c", parts("n").alias("vs"), parts("come").alias("qs")))

    def dealt(df: DataFrame, own: str, groups_of: str, other: str, others: str) -> DataFrame:
        # all keys are int on both sides, as cogroup deals each side by a hash of its own columns
        met = df.join(groups, F.col("cell") == F.col("c")).withColumn(own, F.pmod(F.xxhash64("vec_id"), F.col(groups_of)).cast("int"))
        return met.select("cell", own, F.explode(F.sequence(F.lit(0), F.col(others) - 1)).alias(other), "vec_id", "embedding")

    left, right = dealt(routed, "_q", "qs", "_v", "vs"), dealt(index.vectors(), "_v", "vs", "_q", "qs")
    keys = ("cell", "_q", "_v")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(top_of_groups(k), "query_id long, vec_id long, score double")


def _ranks(centres: np.ndarray):
    """For each pair of a query and a cell: how many centres are nearer to the query than the cell's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                order = np.argsort(np.argsort(_angles(b.column(1), centres), axis=1, kind="stable"), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(order[np.arange(b.num_rows), np.asarray(b.column(0))])], names=["rank"])

    return run


def probes_for(index: VectorIndex, recall: float = 0.9, k: int = 10, queries: int = 200, margin: float = 0.02) -> int:
    """How many of its nearest cells a query must visit to find this part of its k nearest rows, and the margin more.

    Measured: about so many stored vectors, taken by hash, are searched exactly, and the cells of what they find are ranked
    by nearness to the query. Vectors without clusters need a large part of the cells, whatever their number.
    """
    stored, centres = index.vectors(), index.centres()
    n = index.cells().agg(F.sum("n")).first()[0] or 0
    some = cut(stored.where(F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.lit(1_000_000)) < min(1.0, queries / max(1, n)) * 1_000_000).select("vec_id", "embedding"))
    near = top_k(index, some, k).select("query_id", F.col("vec_id").alias("near"))
    at = near.join(F.broadcast(some), F.col("query_id") == F.col("vec_id")).select("near", "embedding")
    of = stored.select(F.col("vec_id").alias("v"), "cell").join(at, F.col("v") == F.col("near")).select("cell", "embedding")
    ranks = of.mapInArrow(_ranks(centres), "rank long").groupBy("rank").count().orderBy("rank").collect()  # a row a cell at most
    total, got = sum(r["count"] for r in ranks), 0
    for r in ranks:
        got += r["count"]
        if got >= min(1.0, recall + margin) * total:
            return r["rank"] + 1
    return max(1, len(centres))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("place", place).where(F.col("place") <= k)


def top_k(index: VectorIndex, queries: DataFrame, k: int = 10, probes: int = PROBES, exact: bool = True, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(query_id, vec_id, score, place) as search.vector_top_k has them, from the index.

    exact gives the very rows of vector_top_k: after its `probes` nearest cells a query visits each other cell that could
    hold a better row than its k-th. Without it, rows of other cells are missed; each score is right all the same, and
    probes_for says how many cells a wanted recall takes.
    Queries must have ids of their own, as a row's id is what is left out of its own results.
    """
    centres, wanted = index.centres(), cut(usable(queries))
    radius = np.full(len(centres), -1.0)
    for r in index.cells().collect():  # a row a cell
        radius[r["cell"]] = r["radius"]
    if not len(centres):
        return wanted.sparkSession.createDataFrame([], "query_id long, vec_id long, score double, place int")
    first = _ranked(_visited(index, wanted.mapInArrow(_routed(centres, radius, probes, False), VECTORS), k, group_rows), k)
    if not exact:
        return first
    first = cut(first.select("query_id", "vec_id", "score"))
    full = first.groupBy(F.col("query_id").alias("q")).agg(F.when(F.count("*") >= k, F.min("score")).otherwise(F.lit(-2.0)).alias("least"))
    known = wanted.join(full, F.col("vec_id") == F.col("q"), "left").select("vec_id", "embedding", F.coalesce("least", F.lit(-2.0)).alias("least"))
    return _ranked(first.unionByName(_visited(index, known.mapInArrow(_routed(centres, radius, probes, True), VECTORS), k, group_rows)), k)
