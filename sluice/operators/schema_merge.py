"""One set of typed columns from frames that type the same fields unlike each other.

Files of one load may have been written by several versions of a schema.  Each
version is read by its own schema; this module finds, field by field, the
narrowest type that takes the values of all versions without loss, and brings
every frame to it:

* ``int`` to ``long``; whole numbers to ``double`` beside ``float`` or ``double``;
  ``float`` to ``double``; decimals to one that holds the digits of both
  (whole numbers count as decimals without a fraction)
* a field that some versions lack is NULL there
* records field by field, arrays and maps by their items
* anything else that differs (a number beside text, a text beside bytes, a
  decimal of more than 38 digits) becomes text: as printed for plain values,
  UTF-8 for bytes, JSON for records, arrays and maps
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
"""Whole number types, narrowest first, with the decimal digits that hold their values."""
NESTED = (T.StructType, T.ArrayType, T.MapType)


def _decimal(t: T.DataType) -> tuple[int, int] | None:
    """Digits before and behind the point."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return (WHOLE[type(t)], 0) if type(t) in WHOLE else None


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that takes the values of both without loss; text if there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in WHOLE and type(b) in WHOLE:
        return a if WHOLE[type(a)] >= WHOLE[type(b)] else b
    real = (T.FloatType, T.DoubleType)
    if isinstance(a, (*real, T.DecimalType, *WHOLE)) and isinstance(b, (*real, T.DecimalType, *WHOLE)):
        if isinstance(a, real) or isinstance(b, real):
            # A decimal beside a binary fraction cannot be held by either.
            return T.StringType() if T.DecimalType in (type(a), type(b)) else T.DoubleType()
        (i, f), (j, g) = _decimal(a), _decimal(b)
        before, behind = max(i, j), max(f, g)
        return T.DecimalType(before + behind, behind) if before + behind <= 38 else T.StringType()
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged_struct([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, common_type(a.valueType, b.valueType))
    return T.StringType()


def merged_struct(schemas: list[T.StructType]) -> T.StructType:
    """The fields of all schemas, in order of first appearance, each with a type that all its versions fit."""
    fields: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            fields[f.name] = common_type(fields.get(f.name, T.NullType()), f.dataType)
    return T.StructType([T.StructField(name, t) for name, t in fields.items()])


def as_type(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """``col`` of type ``have`` as ``want``, which ``common_type`` made of it and others."""
    if have == want:
        return col
    if isinstance(have, T.NullType):
        return F.lit(None).cast(want)
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name: f.dataType for f in have.fields}
        parts = [as_type(col.getField(f.name), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType) for f in want.fields]
        return F.when(col.isNotNull(), F.struct(*[p.alias(f.name) for p, f in zip(parts, want.fields)]))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(col, lambda x: as_type(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        return F.transform_values(col, lambda _, v: as_type(v, have.valueType, want.valueType))
    if isinstance(want, T.StringType) and isinstance(have, NESTED):
        return F.to_json(col)
    return col.cast(want)


def union_of(frames: list[DataFrame], defaults: dict[str, Column] | None = None) -> DataFrame:
    """All rows of ``frames`` with the fields of all, by name; ``defaults`` fill fields that a frame lacks (else NULL)."""
    want = merged_struct([df.schema for df in frames])
    defaults = defaults or {}
    out = []
    for df in frames:
        own = {f.name: f.dataType for f in df.schema.fields}
        out.append(df.select(*[
            (as_type(F.col(f"`{f.name}`"), own[f.name], f.dataType) if f.name in own
             else defaults.get(f.name, F.lit(None)).cast(f.dataType)).alias(f.name) for f in want.fields]))
    return reduce(DataFrame.unionByName, out)
