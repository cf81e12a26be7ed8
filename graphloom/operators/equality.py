"""Structural equality, hashes and text of nested values, as column expressions.

Types must agree, lists compare in order, structs by field name whatever the order, maps in entry order, bytes by
content, and null equals null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical(c: Column, kind: T.DataType) -> Column:
    """c in a form that Spark compares as the rules above say: struct fields by name, maps as lists of entries."""
    if isinstance(kind, T.StructType):
        fields = [canonical(c.getField(f.name), f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: canonical(x, kind.elementType)) if _nested(kind.elementType) else c
    if isinstance(kind, T.MapType):
        return F.transform(F.map_entries(c), lambda e: F.struct(canonical(e["key"], kind.keyType).alias("key"), canonical(e["value"], kind.valueType).alias("value")))
    return c


def _nested(kind: T.DataType) -> bool:
    return isinstance(kind, (T.StructType, T.ArrayType, T.MapType))


def shape(kind: T.DataType) -> str:
    """A type's name with struct fields sorted; values of different shapes are never equal."""
    if isinstance(kind, T.StructType):
        return "struct<" + ",".join(f"{f.name}:{shape(f.dataType)}" for f in sorted(kind.fields, key=lambda f: f.name)) + ">"
    if isinstance(kind, T.ArrayType):
        return f"array<{shape(kind.elementType)}>"
    if isinstance(kind, T.MapType):
        return f"map<{shape(kind.keyType)},{shape(kind.valueType)}>"
    return kind.simpleString()


def equal(df: DataFrame, a: str, b: str) -> Column:
    """Whether columns a and b of df are structurally equal."""
    ka, kb = df.schema[a].dataType, df.schema[b].dataType
    if shape(ka) != shape(kb):
        return F.lit(False)
    return canonical(F.col(a), ka).eqNullSafe(canonical(F.col(b), kb))


def distinct(df: DataFrame, *columns: str) -> DataFrame:
    """One row of those that are structurally equal in the columns, as canonical values."""
    return df.select(*(canonical(F.col(c), df.schema[c].dataType).alias(c) for c in columns or df.columns)).distinct()


def structural_hash(df: DataFrame, *columns: str) -> Column:
    """64 bits that agree for structurally equal values. Nulls have their own mark at each place."""
    parts = []
    for c in columns or df.columns:
        parts += [F.lit(shape(df.schema[c].dataType)), F.col(c).isNull(), canonical(F.col(c), df.schema[c].dataType)]
    return F.xxhash64(*parts)


def rendered(c: Column, kind: T.DataType) -> Column:
    """[a, b] for lists, {k: v} for structs and maps, Blob[n] for bytes, null for null."""
    if isinstance(kind, T.ArrayType):
        out = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: rendered(x, kind.elementType)), ", "), F.lit("]"))
    elif isinstance(kind, T.StructType):
        parts = [F.concat(F.lit(f"{f.name}: "), rendered(c.getField(f.name), f.dataType)) for f in kind.fields]
        out = F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))
    elif isinstance(kind, T.MapType):
        out = F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(rendered(e["key"], kind.keyType), F.lit(": "), rendered(e["value"], kind.valueType))), ", "), F.lit("}"))
    elif isinstance(kind, T.BinaryType):
        out = F.concat(F.lit("Blob["), F.length(c), F.lit("]"))
    else:
        out = c.cast("string")
    return F.when(c.isNull(), F.lit("null")).otherwise(out)


def rendered_node(label: str, properties: Column, kind: T.StructType) -> Column:
    return F.concat(F.lit(f"(:{label} "), rendered(properties, kind), F.lit(")"))


def rendered_rel(label: str, properties: Column, kind: T.StructType) -> Column:
    return F.concat(F.lit(f"[:{label} "), rendered(properties, kind), F.lit("]"))


def rendered_path(nodes: Column, rels: Column) -> Column:
    """<n, …, r, …>: the rendered nodes of an array, then the rendered relationships."""
    return F.concat(F.lit("<"), F.array_join(F.concat(nodes, rels), ", "), F.lit(">"))
