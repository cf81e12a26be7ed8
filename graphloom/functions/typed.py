"""Typed loading: column expressions that convert a whole table, and strict and quarantine ways to use them.

Each conversion gives null where a value doesn't convert. `strict` turns such a row into an error, `quarantine` puts
it into a second DataFrame with the reason.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Widths of the integer types, as (least, most, Spark type).
INTEGERS = {
    "int8": (-(2**7), 2**7 - 1, "tinyint"),
    "int16": (-(2**15), 2**15 - 1, "smallint"),
    "int32": (-(2**31), 2**31 - 1, "int"),
    "int64": (-(2**63), 2**63 - 1, "bigint"),
    "uint8": (0, 2**8 - 1, "smallint"),
    "uint16": (0, 2**16 - 1, "int"),
    "uint32": (0, 2**32 - 1, "bigint"),
    "uint64": (0, 2**64 - 1, "decimal(20,0)"),
}
#: Days of 0001-01-01 and 9999-12-31, and the microseconds of the first and last instant between them.
DAYS = (-719162, 2932896)
MICROS = (-62135596800000000, 253402300799999999)
#: The most seconds of an interval either way, and the days of a month in it.
INTERVAL_SECONDS, MONTH_DAYS = 922337203685, 30
#: The greatest magnitude of a narrow decimal.
NARROW_DECIMAL = "79228162514264337593543950335"
MOST_DIGITS, MOST_DEPTH = 38, 64
UUID = "^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"


def quarantine(df: DataFrame, source: str, target: str, converted: Column, reason: str) -> tuple[DataFrame, DataFrame]:
    """(rows with target, rows that don't convert with their reason). A null source converts to null."""
    tried = df.withColumn(target, converted)
    bad = F.col(source).isNotNull() & F.col(target).isNull()
    return tried.where(~bad), tried.where(bad).drop(target).withColumn("reason", F.lit(reason))


def first_refusal(rules: dict[str, tuple[Column, Column]]) -> Column:
    """The first reason, of rules {reason: (source, converted)}, why a row is refused; null if every source that isn't
    null converts."""
    return F.coalesce(*(F.when(source.isNotNull() & converted.isNull(), F.lit(reason)) for reason, (source, converted) in rules.items()))


def strict(source: Column, converted: Column, reason: str) -> Column:
    """The converted value, or an error that names the reason and the value."""
    failed = F.raise_error(F.concat(F.lit(f"{reason}: "), source.cast("string")))
    return F.when(source.isNotNull() & converted.isNull(), failed).otherwise(converted)


def integer(text: Column, kind: str) -> Column:
    """An integer of exactly this width from its digits; null beyond it."""
    least, most, spark_type = INTEGERS[kind]
    wide = text.try_cast("decimal(38,0)")
    whole = text.rlike(r"^[+-]?[0-9]+$")
    return F.when(whole & (wide >= F.lit(str(least)).cast("decimal(38,0)")) & (wide <= F.lit(str(most)).cast("decimal(38,0)")), wide).try_cast(spark_type)


@F.pandas_udf(T.StringType())
def _int128(high: pd.Series, low: pd.Series) -> pd.Series:
    return pd.Series([None if h is None or w is None else str(int(h) * 2**64 + int(w)) for h, w in zip(high, low, strict=True)], dtype=object)


def int128(high: Column, low: Column) -> Column:
    """Canonical digits of high * 2^64 + low, low as an unsigned decimal: 39 digits don't fit a decimal."""
    return _int128(high.cast("string"), low.cast("string"))


def int128_text(text: Column) -> Column:
    """Canonical digits of a 128-bit integer; null if it isn't one."""
    bare = F.regexp_replace(F.regexp_replace(text, r"^\+", ""), r"^(-?)0+(?=[0-9])", "$1")
    bare = F.when(bare == "-0", "0").otherwise(bare)
    negative = bare.startswith("-")
    digits = F.when(negative, F.substring(bare, 2, 64)).otherwise(bare)
    bound = F.when(negative, F.lit(str(2**127))).otherwise(F.lit(str(2**127 - 1)))
    fits = (F.length(digits) < 39) | ((F.length(digits) == 39) & (digits <= bound))
    return F.when(text.rlike(r"^[+-]?[0-9]+$") & fits, bare)


def decimal(text: Column, precision: int, scale: int) -> Column:
    """An exact decimal; digits beyond the scale round half away from zero; null if the integer part doesn't fit."""
    return text.try_cast(T.DecimalType(precision, scale).simpleString())


def decimal_size(text: Column) -> Column:
    """struct(precision, scale) of a plain decimal text; trailing zeros count; null beyond 38 digits."""
    whole = F.regexp_replace(F.regexp_extract(text, r"^[+-]?([0-9]*)", 1), r"^0+", "")
    scale = F.length(F.regexp_extract(text, r"\.([0-9]*)$", 1))
    precision = F.greatest(F.length(whole) + scale, F.lit(1), scale)
    ok = text.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$") & (precision <= MOST_DIGITS)
    return F.when(ok, F.struct(precision.alias("precision"), scale.alias("scale")))


def narrow_decimal(value: Column) -> Column:
    """The value if a narrow decimal holds its magnitude, else null."""
    return F.when(F.abs(value) <= F.lit(NARROW_DECIMAL).cast("decimal(38,0)"), value)


def decimal_literal(value: Column, precision: int, scale: int) -> Column:
    """What a decimal literal that passes through a double becomes: scaled and rounded as a double first. Opt-in."""
    unit = F.lit(float(10**scale))
    return (F.round(value.cast("double") * unit) / unit).cast(T.DecimalType(precision, scale))


def instant(value: Column, unit: str) -> Column:
    """A UTC timestamp from an epoch count in s, ms, us or ns (ns truncate toward zero); null outside years 1 to 9999."""
    per = {"s": 10**6, "ms": 10**3, "us": 1}
    if unit == "ns":
        n = value.cast("bigint")
        micros = F.call_function("div", n, F.lit(1000)).cast("decimal(38,0)")
    else:
        micros = value.cast("decimal(27,0)") * F.lit(per[unit]).cast("decimal(10,0)")
    inside = (micros >= F.lit(MICROS[0])) & (micros <= F.lit(MICROS[1]))
    return F.timestamp_micros(F.when(inside, micros).cast("bigint"))


def day(value: Column) -> Column:
    """A date from days since 1970; null outside years 1 to 9999."""
    return F.when((value >= DAYS[0]) & (value <= DAYS[1]), F.date_from_unix_date(value.cast("int")))


def utc(ts: Column, zone: str | None) -> Column:
    """The UTC instant of a local time in zone; a time without a zone is taken as UTC."""
    return ts if zone is None else F.to_utc_timestamp(ts, zone)


def interval_seconds(months: Column, days: Column, micros: Column) -> Column:
    """Seconds of an interval with months of 30 days; null beyond the bound."""
    seconds = months.cast("double") * (MONTH_DAYS * 86400) + days.cast("double") * 86400 + micros.cast("double") / 1e6
    return F.when(F.abs(seconds) <= INTERVAL_SECONDS, seconds)


def interval_of(seconds: Column) -> Column:
    """struct(months, days, micros) of whole seconds: no months, whole days, and the rest."""
    s = seconds.cast("bigint")
    days = F.when(s >= 0, F.floor(s / 86400)).otherwise(F.ceil(s / 86400)).cast("int")
    return F.struct(F.lit(0).alias("months"), days.alias("days"), ((s - days * F.lit(86400).cast("bigint")) * 1_000_000).alias("micros"))


def uuid(text: Column) -> Column:
    """Canonical lower-case text of a UUID, hyphens and braces optional; null if it isn't one."""
    bare = F.lower(F.regexp_replace(text, r"^\{(.*)\}$", "$1"))
    whole = F.regexp_replace(bare, "^([0-9a-f]{8})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{4})([0-9a-f]{12})$", "$1-$2-$3-$4-$5")
    return F.when(whole.rlike(UUID), whole)


def union_of(text: Column, members: list[tuple[str, str]]) -> Column:
    """A union value from a bare literal: the first declared member that accepts it, as struct(tag, member…)."""
    tries = [(name, text.try_cast(kind)) for name, kind in members]
    tag = F.coalesce(*(F.when(v.isNotNull(), F.lit(name)) for name, v in tries))
    return F.when(text.isNotNull(), F.struct(tag.alias("tag"), *(F.when(tag == name, v).alias(name) for name, v in tries)))


def union_value(tag: str, value: Column, members: list[tuple[str, str]]) -> Column:
    """A union value with an explicit member, without coercion."""
    if tag not in dict(members):
        raise ValueError(f"no member {tag}")
    return F.struct(F.lit(tag).alias("tag"), *((value if name == tag else F.lit(None)).cast(kind).alias(name) for name, kind in members))


def union_member(value: Column, tag: str) -> Column:
    """The member if it is the active one, else null."""
    return F.when(value.getField("tag") == tag, value.getField(tag))


def type_tag(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def require_type(df: DataFrame, column: str, kind: str) -> DataFrame:
    """df, or an error: a column is never coerced silently."""
    if type_tag(df, column) != kind:
        raise TypeError(f"{column} is {type_tag(df, column)}, not {kind}")
    return df


def depth(kind: T.DataType) -> int:
    if isinstance(kind, T.StructType):
        return 1 + max((depth(f.dataType) for f in kind.fields), default=0)
    if isinstance(kind, T.ArrayType):
        return 1 + depth(kind.elementType)
    if isinstance(kind, T.MapType):
        return 1 + max(depth(kind.keyType), depth(kind.valueType))
    return 0


def require_depth(df: DataFrame, most: int = MOST_DEPTH) -> DataFrame:
    for f in df.schema.fields:
        if depth(f.dataType) > most:
            raise ValueError(f"{f.name} nests deeper than {most}")
    return df


def nested_within(text: Column, most: int = MOST_DEPTH) -> Column:
    """The text of a nested list or map if its brackets open no deeper than `most`, else null."""
    step = lambda acc, c: F.struct((acc["now"] + F.when(c.isin("[", "{"), 1).when(c.isin("]", "}"), -1).otherwise(0)).alias("now"), F.greatest(acc["most"], acc["now"] + F.when(c.isin("[", "{"), 1).otherwise(0)).alias("most"))
    deepest = F.aggregate(F.split(text, ""), F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step)["most"]
    return F.when(deepest <= most, text)


def null_of(kind: str) -> Column:
    return F.lit(None).cast(kind)
