"""Avro records -> rows in the ingestion's text conventions.

Input: a frame whose columns are an Avro record's fields, either as Spark's
Avro reader types them (logical types already converted) or in their
physical form (``int`` days, ``long`` millis, decimals as Spark decimals).
Output: names lower-cased; dates as ``yyyy-MM-dd``; ``time-millis`` as
``HH:mm:ss.SSS``; ``timestamp-millis`` as ``yyyy-MM-dd'T'HH:mm:ss.SSS'Z'``
(UTC); other longs (``timestamp-micros`` too) as raw longs; decimals with the
declared precision and scale; unions as nullable columns whatever the branch
order.  Booleans, records, arrays, maps and fixed pass through natively.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.fieldops import utc_wall_clock

INSTANT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def load_schema(schema: str | dict) -> dict:
    return json.loads(schema) if isinstance(schema, str) else schema


def non_null_branch(avro_type: Any) -> Any:
    """The one non-null branch of a union (any order), or the type itself."""
    if isinstance(avro_type, list):
        branches = [b for b in avro_type if b != "null"]
        if len(branches) == 1:
            return branches[0]
        return {"type": "union", "branches": branches}
    return avro_type


def logical(avro_type: Any) -> tuple[str, str | None, dict]:
    t = non_null_branch(avro_type)
    if isinstance(t, dict):
        return t.get("type"), t.get("logicalType"), t
    return t, None, {}


def time_of_day_text(millis: Column) -> Column:
    """Millis of day -> ``HH:mm:ss.SSS`` (fixed width, independent of the session zone)."""
    return F.format_string(
        "%02d:%02d:%02d.%03d",
        (millis / 3_600_000).cast("int"), ((millis / 60_000) % 60).cast("int"),
        ((millis / 1000) % 60).cast("int"), (millis % 1000).cast("int"),
    )


def normalise_field(col: Column, spark_type: T.DataType, avro_type: Any) -> Column:
    base, logical_type, info = logical(avro_type)
    if base == "enum":
        return col.cast("string")
    if base == "int" and logical_type == "date":
        if isinstance(spark_type, T.DateType):
            return col.cast("string")
        return F.date_from_unix_date(col).cast("string")
    if base == "int" and logical_type == "time-millis":
        return time_of_day_text(col.cast("bigint"))
    if base == "long" and logical_type == "timestamp-millis":
        instant = col if isinstance(spark_type, T.TimestampType) else F.timestamp_millis(col)
        return F.date_format(utc_wall_clock(instant), INSTANT_FORMAT)
    if base == "long" and isinstance(spark_type, (T.TimestampType, T.TimestampNTZType)):
        # Other timestamp logical types stay raw longs in their own unit.
        # A local timestamp (no zone) counts from the epoch as if it were UTC.
        instant = col if isinstance(spark_type, T.TimestampType) else \
            F.convert_timezone(F.lit("UTC"), F.current_timezone(), col).cast("timestamp")
        return F.unix_millis(instant) if (logical_type or "").endswith("millis") else F.unix_micros(instant)
    if base in ("bytes", "fixed") and logical_type == "decimal":
        return col.cast(f"decimal({int(info['precision'])},{int(info.get('scale', 0))})")
    return col


def normalise_records(df: DataFrame, schema: str | dict, keep: list[str] | None = None) -> DataFrame:
    """Lower-case names and apply the per-type text rules to every field."""
    avro = load_schema(schema)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in avro["fields"]:
        name = field["name"]
        if name not in types:
            out.append(F.lit(None).alias(name.lower()))
            continue
        out.append(normalise_field(F.col(f"`{name}`"), types[name], field["type"]).alias(name.lower()))
    extra = [F.col(c) for c in (keep or [])]
    return df.select(*out, *extra)


# ---------------------------------------------------------------- physical decoding

def spark_type_of(avro_type: Any) -> T.DataType:
    """Spark type of an Avro type in its physical (un-converted) form."""
    base, logical_type, info = logical(avro_type)
    if isinstance(base, dict) or base == "union":
        return T.StringType()
    if base in ("bytes", "fixed") and logical_type == "decimal":
        return T.DecimalType(int(info["precision"]), int(info.get("scale", 0)))
    simple = {
        "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(),
        "string": T.StringType(), "enum": T.StringType(), "boolean": T.BooleanType(),
        "bytes": T.BinaryType(), "fixed": T.BinaryType(), "null": T.NullType(),
    }
    if base in simple:
        return simple[base]
    if base == "record":
        return T.StructType([T.StructField(f["name"], spark_type_of(f["type"])) for f in info["fields"]])
    if base == "array":
        return T.ArrayType(spark_type_of(info["items"]))
    if base == "map":
        return T.MapType(T.StringType(), spark_type_of(info["values"]))
    return T.StringType()


def json_text_schema(schema: str | dict) -> T.StructType:
    """Schema to read a datum's JSON text: bytes (and decimals) arrive as ISO-8859-1 text."""
    avro = load_schema(schema)
    fields = []
    for f in avro["fields"]:
        base, logical_type, _ = logical(f["type"])
        if base in ("bytes", "fixed"):
            fields.append(T.StructField(f["name"], T.StringType()))
        else:
            fields.append(T.StructField(f["name"], spark_type_of(f["type"])))
    return T.StructType(fields)


def _unsigned(hexed: Column) -> Column:
    """Unsigned value of up to 32 hex digits, exactly (two 64-bit halves)."""
    n = F.length(hexed)
    lo_len = F.least(n, F.lit(16))
    hi_len = n - lo_len
    lo = F.conv(F.substring(hexed, hi_len + 1, 16), 16, 10).cast("decimal(38,0)")
    hi = F.conv(F.substring(hexed, 1, hi_len), 16, 10).cast("decimal(38,0)")
    two64 = F.lit("18446744073709551616").cast("decimal(38,0)")
    return F.when(hi_len > 0, hi * two64 + lo).otherwise(lo)


def twos_complement_decimal(raw: Column, precision: int, scale: int) -> Column:
    """Big-endian two's-complement bytes (as ISO-8859-1 text) -> decimal(p, s).

    A negative value is -(~x + 1), with ~x taken digit by digit on the hex
    text, so no floating point is involved; the scale is applied by shifting
    the decimal point in text.
    """
    hexed = F.hex(F.encode(raw, "ISO-8859-1"))
    negative = F.substring(hexed, 1, 1).isin("8", "9", "A", "B", "C", "D", "E", "F")
    flipped = F.translate(hexed, "0123456789ABCDEF", "FEDCBA9876543210")
    whole = F.when(negative, -(_unsigned(flipped) + 1)).otherwise(_unsigned(hexed))
    shifted = F.concat(whole.cast("decimal(38,0)").cast("string"), F.lit(f"E-{scale}"))
    return F.when(raw.isNotNull() & (F.length(hexed) > 0), shifted.try_cast(f"decimal({precision},{scale})"))


def decode_json_datums(df: DataFrame, json_col: str, schema: str | dict, keep: list[str] | None = None) -> DataFrame:
    """Datum JSON text -> physical columns (decimals decoded from their bytes)."""
    avro = load_schema(schema)
    parsed = df.select(F.from_json(F.col(json_col), json_text_schema(avro)).alias("__d"), *(keep or []))
    out = []
    for f in avro["fields"]:
        name = f["name"]
        base, logical_type, info = logical(f["type"])
        c = F.col("__d").getField(name)
        if base in ("bytes", "fixed"):
            if logical_type == "decimal":
                c = twos_complement_decimal(c, int(info["precision"]), int(info.get("scale", 0)))
            else:
                c = F.encode(c, "ISO-8859-1")
        out.append(c.alias(name))
    return parsed.select(*out, *(keep or []))
