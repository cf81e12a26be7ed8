"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words, and each document an expected number of copies: in proportion to its own weight
(the digits of its size in base 2, so a long document counts more than a short one, but less than by its length), up
to the most copies, and so that the expected words of a source are its target. The whole part of it is allotted for
certain, and the rest is the document's inclusion probability p in one order sample: documents rank by the random
odds u / (1 - u) over the inclusion odds p / (1 - p), and the least ranks fill what the target still lacks.
u is a hash of the document's id, so reruns agree.

The ranks of a source are summed in bands of equal width first. Only the band in which the target falls is sorted,
so no task sorts a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, small, stored

#: Weights of the sources in order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: All targets together as a share of all sizes, and the most copies of a source or document.
SHARE = 1.5
MOST_COPIES = 2
BAND_ROWS = 256
MOST_BANDS = 1 << 20
SEED = "mix"


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in order of code points, null last, have the weights in turn. Those whose share would be above most
    times their size stop there, the ones with the least size for their weight first, and the rest is shared anew.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = sizes.withColumn("place", F.row_number().over(by_name)).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") - 1) % len(weights) + 1))
    lean = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), "place")
    before, everything = lean.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = F.lit(share) * F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shared = weighed.withColumn("left", left).withColumn("weight_left", weight_left)
    shared = shared.withColumn("stops", most * F.col("source_size") * F.col("weight_left") <= F.col("left") * F.col("weight"))
    # one that stops comes before all that don't, in this order
    first = F.min_by(F.struct("left", "weight_left"), F.when(~F.col("stops"), F.struct(F.col("source_size") / F.col("weight"), "place"))).over(everything)
    level = shared.withColumn("first", first)
    return level.select("source", "source_size", F.when(F.col("stops"), most * F.col("source_size")).otherwise(F.col("first.left") * F.col("weight") / F.col("first.weight_left")).cast("double").alias("target"))


def expected_copies(classes: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """(source, weight, source_size, target, expected, lacks) from (source, weight, class_size, source_size, target).

    The documents of a source that have one weight are a class. The heaviest classes whose share would be above most
    copies stop there, and the rest of the target goes to the others by weight. lacks is what the source needs beyond
    whole copies.
    """
    heavy = Window.partitionBy("source").orderBy(F.col("weight").desc())
    before, rest = heavy.rowsBetween(Window.unboundedPreceding, -1), heavy.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("target") - most * F.coalesce(F.sum("class_size").over(before), F.lit(0))
    shared = classes.withColumn("left", left).withColumn("weighed", F.sum(F.col("weight") * F.col("class_size")).over(rest))
    shared = shared.withColumn("stops", F.col("left") * F.col("weight") >= most * F.col("weighed"))
    first = F.max_by(F.struct("left", "weighed"), F.when(~F.col("stops"), F.col("weight"))).over(Window.partitionBy("source"))
    level = shared.withColumn("first", first)
    expected = F.when(F.col("stops"), F.lit(float(most))).otherwise(F.col("first.left") * F.col("weight") / F.col("first.weighed"))
    level = level.withColumn("expected", expected)
    lacks = F.col("target") - F.sum(F.floor("expected") * F.col("class_size")).over(Window.partitionBy("source"))
    return level.select("source", "weight", "source_size", "target", "expected", lacks.alias("lacks"))


def weight_of(size: Column) -> Column:
    """The digits of a size in base 2."""
    return F.length(F.bin(size)).cast("long")


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in (0, 1) for each id, from 48 bits of its MD5."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(2**48))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST_COPIES, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) and the columns to keep, one row for each of docs.

    size is the number of words (null: 0). Documents without words, empty tables and sources of size 0 take nothing.
    Repeated rows of one size have one rank, and those at the edge are taken in turn, so equal rows may part; a null
    source is a source of its own; a null doc_id ranks as the empty text.
    """
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = docs.select("doc_id", "source", words.alias("size"), *keep)
    light = stored(sized.select("doc_id", "source", "size"), "sized")
    sums = stored(light.groupBy("source", weight_of(F.col("size")).alias("weight")).agg(F.sum("size").alias("class_size")), "classes")
    aims = targets(sums.groupBy("source").agg(F.sum("class_size").alias("source_size")), weights, share, most)
    aims = stored(aims.withColumnRenamed("source", "_source"), "targets")
    plan = expected_copies(sums.join(small(aims), F.col("source").eqNullSafe(F.col("_source"))).drop("_source"), most)
    plan = small(stored(plan.withColumnsRenamed({"source": "_source", "weight": "_weight"}), "plan"))
    rows = light.count()
    bands = 1
    while bands < min(MOST_BANDS, rows // BAND_ROWS):
        bands *= 2

    def ranked(rows: DataFrame) -> DataFrame:
        u, p = uniform(F.col("doc_id")), F.col("expected") - F.col("whole")
        own = F.col("source").eqNullSafe(F.col("_source")) & (weight_of(F.col("size")) == F.col("_weight"))
        out = rows.join(plan, own, "left").drop("_source", "_weight")
        out = out.withColumn("whole", F.when(F.col("size") > 0, F.floor("expected")).otherwise(0))
        out = out.withColumn("rank", F.when((p > 0) & (F.col("size") > 0), (u / (1 - u)) / (p / (1 - p))))
        return out.withColumn("band", F.floor(F.col("rank") / (1 + F.col("rank")) * bands).cast("long"))

    sums = ranked(light).where("rank is not null").groupBy(F.col("source").alias("s"), F.col("band").alias("b")).agg(F.sum("size").alias("in_band"), F.first("lacks").alias("lack"))
    upto = sums.withColumn("upto", F.sum("in_band").over(Window.partitionBy("s").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)))
    edge = upto.where("upto >= lack").groupBy("s").agg(F.min(F.struct("b", (F.col("upto") - F.col("in_band")).alias("before"))).alias("edge"))
    edge = stored(edge.select("s", "edge.*"), "edge")
    # Documents below the edge band are in, those above it out; in it the order decides, one more than half over the
    # lack being out. Without an edge all ranked documents are in.
    cut = ranked(sized if keep else light).join(small(edge), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    in_edge = F.coalesce(F.col("band") == F.col("b"), F.lit(False))
    place = Window.partitionBy("source").orderBy("rank", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("before") + F.coalesce(F.sum("size").over(place), F.lit(0))
    inside = cut.where(in_edge).withColumn("chosen", ahead + F.col("size") / 2 <= F.col("lacks"))
    below = F.col("band").isNotNull() & F.coalesce(F.col("band") < F.col("b"), F.lit(True))
    outside = cut.where(~in_edge).withColumn("chosen", below & (F.col("lacks") > 0))
    copies = (F.col("whole") + F.col("chosen").cast("int")).cast("long")
    return inside.unionByName(outside).select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), *keep)


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken): the words that the mix takes of each document, repeats counted."""
    return mix(docs).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
