"""Aggregates and report tables: latency summaries, rates, pivots, ratios and verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.sources.checkpoints import cut

SHARES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}


#: Parts of a range, parts of an octave in the first round, and groups up to which their ranges are broadcast.
PARTS, OCTAVE_PARTS, BROADCAST_GROUPS = 4096, 16, 100_000


def _octave(v: Column) -> Column:
    """A whole number that never falls as v grows, OCTAVE_PARTS to an octave: some 70,000 for all doubles."""
    part = lambda x: F.floor((F.log2(x) + 1100) * OCTAVE_PARTS)
    return F.when(v > 0, part(v)).when(v < 0, -part(-v)).otherwise(F.lit(0).cast("long"))


def _part(v: Column, lo: Column, hi: Column) -> Column:
    """The part of lo to hi that v lies in; lo and hi never lie in one part."""
    wide = hi / 2 - lo / 2 > 1e307
    return F.floor(F.when(wide, (v / 4 - lo / 4) / (hi / 4 - lo / 4)).otherwise((v - lo) / (hi - lo)) * PARTS)


def _parts() -> list[Column]:
    v = F.col("_v")
    return [F.count(v).alias("c"), F.min(v).alias("a"), F.max(v).alias("b"), F.sum(v).alias("s")]


def _holding(parts: Column, place: Column) -> Column:
    """Of sorted parts, the one that holds a place: struct(before, a, b)."""
    step = lambda acc, x: F.struct((acc["seen"] + x["c"]).alias("seen"), F.coalesce(acc["got"], F.when(acc["seen"] + x["c"] > place, F.struct(acc["seen"].alias("before"), x["a"].alias("a"), x["b"].alias("b")))).alias("got"))
    none = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("struct<before:bigint,a:double,b:double>").alias("got"))
    return F.aggregate(parts, none, step)["got"]


def exact_quantiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """keys, n, a column for each share, max, mean; a share p is the sample at index min(n - 1, floor(n * p)) in order.

    No group is sorted or held: its samples are counted by parts of their range, with map-side combine, and each round
    goes on with the one part that holds a share's sample, until that part has one value. The first parts are by
    octaves and the later ones of equal width, so there are seven rounds at most, whatever the values; a range has PARTS
    parts at most, and those are all that is ever gathered. Nulls and NaN are no samples: n may be 0.
    """
    own = [f"_k{i}" for i in range(len(keys))]
    raw = F.col(value).cast("double")
    base = df.select(*(F.col(k).alias(o) for k, o in zip(keys, own, strict=True)), F.when(~F.isnan(raw), raw).alias("_v"))
    entry = F.array_sort(F.collect_list(F.when(F.col("c") > 0, F.struct("a", "b", "c")))).alias("parts")
    whole = base.withColumn("_at", _octave(F.col("_v"))).groupBy(*own, "_at").agg(*_parts())
    whole = whole.groupBy(*own).agg(F.sum("c").alias("n"), F.max("b").alias("max"), (F.sum("s") / F.sum(F.when(F.col("c") > 0, F.col("c")))).alias("mean"), entry)
    each = whole.withColumn("share", F.explode(F.array(*(F.struct(F.lit(k).alias("name"), F.lit(p).alias("p")) for k, p in shares.items()))))
    each = each.withColumn("place", F.least(F.col("n") - 1, F.floor(F.col("n") * F.col("share.p")))).withColumn("at", _holding(F.col("parts"), F.col("place")))
    state = cut(each.select(*own, "n", "max", "mean", F.col("share.name").alias("name"), (F.col("place") - F.col("at.before")).alias("place"), F.col("at.a").alias("lo"), F.col("at.b").alias("hi")))
    many = state.count() > BROADCAST_GROUPS
    named = [F.col(k).alias(f"_of{k}") for k in own]
    alike = F.lit(True)
    for k in own:
        alike = alike & F.col(k).eqNullSafe(F.col(f"_of{k}"))
    while not state.where("lo < hi").isEmpty():
        ranges = state.where("lo < hi").select(*named, "lo", "hi").distinct()
        inside = base.join(ranges if many else F.broadcast(ranges), alike & (F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))
        counted = inside.withColumn("_at", _part(F.col("_v"), F.col("lo"), F.col("hi"))).groupBy(*own, "lo", "hi", "_at").agg(*_parts()).groupBy(*named, F.col("lo").alias("_lo"), F.col("hi").alias("_hi")).agg(entry)
        on = state.join(counted, alike & (F.col("lo") == F.col("_lo")) & (F.col("hi") == F.col("_hi")), "left").withColumn("at", _holding(F.col("parts"), F.col("place")))
        found = F.col("at").isNotNull()
        state = cut(on.select(*own, "n", "max", "mean", "name", F.when(found, F.col("place") - F.col("at.before")).otherwise(F.col("place")).alias("place"), *(F.when(found, F.col(f"at.{x}")).otherwise(F.col(y)).alias(y) for x, y in (("a", "lo"), ("b", "hi")))))
    out = state.groupBy(*own).agg(*(F.first(c).alias(c) for c in ("n", "max", "mean")), *(F.max(F.when(F.col("name") == k, F.col("lo"))).alias(k) for k in shares))
    return out.select(*(F.col(o).alias(k) for o, k in zip(own, keys, strict=True)), "n", *shares, "max", "mean")


def latency_summary(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, n, p50, p95, p99, max, mean by exact_quantiles; a group without samples has n = 0 and zeros."""
    out = exact_quantiles(df, keys, value, SHARES)
    return out.select(*keys, "n", *(F.coalesce(k, F.lit(0.0)).alias(k) for k in (*SHARES, "max", "mean")))


def rate(total: Column, seconds: Column) -> Column:
    """total / seconds rounded to one place; 0 where no time passed."""
    return F.when(seconds > 0, F.round(total / seconds, 1)).otherwise(F.lit(0.0))


def verdict(value: Column, limit: Column, at_most: Column, n: Column | None = None) -> Column:
    """PASS or FAIL of value <= limit (>= unless at_most); "not measured" where n is 0."""
    out = F.when(F.when(at_most, value <= limit).otherwise(value >= limit), "PASS").otherwise("FAIL")
    return out if n is None else F.when(n == 0, "not measured").otherwise(out)


def pivoted(df: DataFrame, keys: list[str], by: str, columns: list, value: str, prefix: str) -> DataFrame:
    """A column for each of the given values of `by`, 0 where there is none."""
    wide = df.groupBy(*keys).pivot(by, columns).agg(F.max(value))
    return wide.select(*keys, *(F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(f"{prefix}_{c}") for c in columns))


def ratio(a: Column, base: Column) -> Column:
    """a / base, 0 where the base is 0."""
    return F.when(base == 0, F.lit(0.0)).otherwise(a / base)


def scales(many: Column, one: Column, factor: float = 1.5) -> Column:
    return F.when(many > F.lit(factor) * one, "yes").otherwise("no")


def notes(df: DataFrame) -> DataFrame:
    """(model, size, note): one row for each note of a run."""
    return df.select("model", "size", F.explode("notes").alias("note"))


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


