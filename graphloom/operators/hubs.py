"""Joins at hubs: keys with many rows are dealt over parts on both sides, all other keys join as they are.

A key's rows on one side are dealt over parts of about `hub_rows`, and the other side's rows of that key go to each of
these parts; with a hub on both sides its rows meet in a grid. Each pair of rows meets once, whatever the counts say, so
counts decide on speed only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.sources.checkpoints import cut

#: Rows of a key that one part holds, about. Keys with more are hubs.
HUB_ROWS = 10_000
#: Hubs that are dealt, the largest first: 16 bytes each, so what is broadcast has a fixed bound. Each key beyond them
#: has less than 1/100,000 of its table.
MOST_HUBS = 100_000


def hubs(df: DataFrame, key: str, hub_rows: int = HUB_ROWS) -> DataFrame:
    """(_hub, _parts) of the keys of df with more than hub_rows rows, by a hash of the key; two keys of one hash count as
    one. Null keys are none. Counted with map-side combine, so a hub sends a row a task."""
    counts = df.where(F.col(key).isNotNull()).groupBy(F.xxhash64(key).alias("_hub")).agg(F.count("*").alias("_n"))
    most = counts.where(F.col("_n") > hub_rows).orderBy(F.desc("_n"), "_hub").limit(MOST_HUBS)
    return most.select("_hub", F.ceil(F.col("_n") / hub_rows).cast("int").alias("_parts"))


def known_hubs(df: DataFrame, key: str, hub_rows: int = HUB_ROWS) -> DataFrame | None:
    """hubs, counted now; None if there is none, so that the join is a plain one."""
    found = cut(hubs(df, key, hub_rows))
    return None if found.isEmpty() else found


def hub_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str, left_hubs: DataFrame | None = None, right_hubs: DataFrame | None = None) -> DataFrame:
    """The inner join of left and right where left_key equals right_key, with all columns of both.

    left_hubs and right_hubs are the hubs of either side's own rows (None: it has none that matter). Both sides' columns
    must differ in name. Null keys match nothing. Where hubs are given, both keys must have one type, and not a floating
    one, as they are hashed; repeated rows of a hub share a part.
    """
    grid = [(known, own) for known, own in ((left_hubs, "_lp"), (right_hubs, "_rp")) if known is not None]
    kinds = {left.schema[left_key].dataType.simpleString(), right.schema[right_key].dataType.simpleString()}
    if grid and (len(kinds) > 1 or kinds & {"float", "double"}):
        raise ValueError("both keys must have one type, and not a floating one")

    def dealt(df: DataFrame, key: str, side: str) -> DataFrame:
        out = df.where(F.col(key).isNotNull())
        # by the row itself, so a task that runs again deals as before; maps can't be hashed
        of_row = F.xxhash64(*(f.name for f in df.schema if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))))
        for known, part in grid:
            out = out.join(F.broadcast(known.select(F.col("_hub").alias("_h"), "_parts")), F.xxhash64(key) == F.col("_h"), "left")
            parts = F.coalesce("_parts", F.lit(1))
            places = F.pmod(of_row, parts).cast("int") if part == side else F.explode(F.sequence(F.lit(0), parts - 1))
            out = out.select(*df.columns, *(p for p in ("_lp", "_rp") if p in out.columns), places.alias(part))
        return out

    a, b = dealt(left, left_key, "_lp"), dealt(right, right_key, "_rp")
    met = F.col(left_key) == F.col(right_key)
    for _, part in grid:
        b = b.withColumnRenamed(part, f"{part}_")
        met = met & (F.col(part) == F.col(f"{part}_"))
    return a.join(b, met).select(*left.columns, *right.columns)
