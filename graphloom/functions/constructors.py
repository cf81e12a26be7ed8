"""Constructors and small functions of the graph's query language, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.sources.graph import internal_ids

_UNITS = {"year": 12, "month": 1, "week": 7, "day": 1, "hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000, "millisecond": 1_000, "microsecond": 1}
_MONTHS, _DAYS = ("year", "month"), ("week", "day")


def date(text: Column) -> Column:
    return F.to_date(text)


def timestamp(text: Column) -> Column:
    return F.to_timestamp(text)


def interval(text: Column) -> Column:
    """struct(months, days, micros) of a text such as '1 year 3 days 2 hours'; null if no unit is named."""
    named = F.lit(rf"(?i)(-?[0-9]+)\s*({'|'.join(_UNITS)})s?\b")
    # two searches find all amounts and their units; the one-element array binds them
    found = F.array(F.struct(F.regexp_extract_all(text, named, F.lit(1)).alias("n"), F.transform(F.regexp_extract_all(text, named, F.lit(2)), F.lower).alias("unit")))

    def sums(x: Column) -> Column:
        def total(*own: str) -> Column:
            # the first amount of each unit counts
            return sum((F.coalesce(F.get(x["n"], (F.array_position(x["unit"], u) - 1).cast("int")).cast("bigint"), F.lit(0).cast("bigint")) * _UNITS[u] for u in own), F.lit(0).cast("bigint"))

        micros = total(*(u for u in _UNITS if u not in _MONTHS + _DAYS))
        return F.when(F.size(x["unit"]) > 0, F.struct(total(*_MONTHS).cast("int").alias("months"), total(*_DAYS).cast("int").alias("days"), micros.alias("micros")))

    return F.get(F.transform(found, sums), F.lit(0))


def blob(text: Column) -> Column:
    r"""Bytes of a text of \xHH pairs."""
    return F.unhex(F.regexp_replace(text, r"\\x", ""))


def map_of(keys: Column, values: Column) -> Column:
    return F.map_from_arrays(keys, values)


def element(items: Column, place: int) -> Column:
    """The item at a place counted from 0; null beyond the end."""
    return F.get(items, F.lit(place))


def entry(m: Column, place: int) -> Column:
    """struct(key, value) of a map at a place counted from 0."""
    return F.get(F.map_entries(m), F.lit(place))


def escaped(text: Column) -> Column:
    """Backslashes doubled, then apostrophes escaped: what a quoted literal needs."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))


def map_to_rows(df: DataFrame, key: str, column: str, names: tuple[str, str] = ("name", "value")) -> DataFrame:
    """One row for each entry of a map: narrow, so a reader of one attribute prunes the rest."""
    return df.select(key, F.explode(column).alias(*names))


def rows_to_map(df: DataFrame, key: str, name: str, value: str, column: str) -> DataFrame:
    """The inverse: one map for each key, entries by name."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(name).alias("key"), F.col(value).alias("value"))))
    return df.groupBy(key).agg(F.map_from_entries(entries).alias(column))


def reencoded(df: DataFrame, column: str, separator: str = "/") -> tuple[DataFrame, DataFrame]:
    """(df with owner and name_id for a key such as "42/DESC", dictionary(name_id, name)).

    The dictionary numbers distinct names in their order, over ranges of them; it is as long as there are names, not
    rows.
    """
    parts = F.split(F.col(column), separator, 2)
    split = df.withColumn("owner", F.get(parts, F.lit(0)).cast("bigint")).withColumn("_name", F.get(parts, F.lit(1)))
    names = split.select(F.col("_name").alias("name")).distinct()
    dictionary = internal_ids(names.where("name is not null"), "name", 0).select("name", F.col("offset").cast("int").alias("name_id"))
    return split.join(dictionary, F.col("_name") == F.col("name")).drop("_name", "name"), dictionary
