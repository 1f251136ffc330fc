"""Avro container files written by Spark's text sink.

Each task encodes its rows into blocks of an object container file and hands
them to the text sink as raw bytes, a row per block.  Every block of such a
file ends with the file's sync marker, whose last byte is chosen to be a line
feed: it is the one the sink adds.  So commits, retries and partition folders
are Spark's own, and no file passes through the driver.

Columns carry Avro's physical values: days for ``date``, milliseconds for
``time-millis`` and ``timestamp-millis``, Spark decimals for ``decimal``.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from decimal import Decimal
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAGIC = b"Obj\x01"


def number(n: int) -> bytes:
    """A zigzag variable-length integer."""
    z, out = (n << 1) ^ (n >> 63), bytearray()
    while z > 127:
        out.append(z & 127 | 128)
        z >>= 7
    out.append(z)
    return bytes(out)


def sized(raw: bytes) -> bytes:
    return number(len(raw)) + raw


def _decimal(kind: dict):
    scale = int(kind.get("scale", 0))

    def encode(x: Decimal) -> bytes:
        n = int(x.scaleb(scale))
        return sized(n.to_bytes(max(1, (n.bit_length() + 8) // 8), "big", signed=True))

    return encode


def encoder(kind: Any):
    """A function from a Python value to the bytes of Avro type ``kind`` (its parsed JSON)."""
    if isinstance(kind, list):
        null = kind.index("null") if "null" in kind else None
        others = [(k, encoder(x)) for k, x in enumerate(kind) if x != "null"]
        if len(others) != 1:
            raise ValueError(f"unions of several types are not written: {kind}")
        (at, encode), = others
        prefix = number(at)
        return lambda x: number(null) if x is None and null is not None else prefix + encode(x)
    base = kind["type"] if isinstance(kind, dict) else kind
    if isinstance(base, (dict, list)):
        return encoder(base)
    if base == "record":
        parts = [(f["name"], encoder(f["type"])) for f in kind["fields"]]
        return lambda x: b"".join(encode(x[name]) for name, encode in parts)
    if base == "enum":
        places = {symbol: number(k) for k, symbol in enumerate(kind["symbols"])}
        return places.__getitem__
    if base == "array":
        item = encoder(kind["items"])
        return lambda x: (number(len(x)) + b"".join(map(item, x)) if x else b"") + b"\x00"
    if base == "map":
        value = encoder(kind["values"])
        return lambda x: (number(len(x)) + b"".join(sized(k.encode()) + value(v) for k, v in dict(x).items()) if x else b"") + b"\x00"
    if base == "bytes" and isinstance(kind, dict) and kind.get("logicalType") == "decimal":
        return _decimal(kind)
    plain = {
        "null": lambda _: b"", "boolean": lambda x: b"\x01" if x else b"\x00", "int": number, "long": number,
        "float": struct.Struct("<f").pack, "double": struct.Struct("<d").pack, "bytes": lambda x: sized(bytes(x)), "string": lambda x: sized(x.encode()),
    }
    if base not in plain:
        raise ValueError(f"type {base!r} is not written")
    return plain[base]


def header(schema: dict, sync: bytes, codec: str) -> bytes:
    meta = {"avro.schema": json.dumps(schema).encode(), "avro.codec": codec.encode()}
    return MAGIC + encoder({"type": "map", "values": "bytes"})(meta) + sync


def write_avro(df: DataFrame, path: str, schema: dict, partition_cols: list[str] | None = None, codec: str = "deflate",
               block_rows: int = 4000) -> None:
    """Write rows of ``df`` (a column per field of ``schema``) as Avro files, one per task and partition folder.

    ``codec`` is ``null`` or ``deflate``.  The files are named as text files; an empty
    frame writes none.
    """
    if codec not in ("null", "deflate"):
        raise ValueError(f"codec {codec!r} is not written")
    parts = list(partition_cols or [])
    fields = [f["name"] for f in schema["fields"]]

    def blocks(batches):
        import pyarrow as pa

        encode, now, sync, held, out, seq = encoder(schema), None, b"", [], [], 0

        def flush():
            nonlocal held, seq
            if held:
                body = b"".join(held)
                if codec == "deflate":
                    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
                    body = squeeze.compress(body) + squeeze.flush()
                out.append((*now, seq, number(len(held)) + sized(body) + sync[:-1]))
                held, seq = [], seq + 1

        def ready():
            columns = list(zip(*out)) or [[]] * (len(parts) + 2)
            arrays = [pa.array(c, pa.string()) for c in columns[:len(parts)]]
            out.clear()
            return pa.RecordBatch.from_arrays([*arrays, pa.array(columns[-2], pa.int64()), pa.array(columns[-1], pa.binary())], [*parts, "_seq", "_block"])

        for b in batches:
            for row in b.to_pylist():
                key = tuple(row[p] for p in parts)
                if key != now:
                    flush()
                    now, sync = key, uuid.uuid4().bytes[:15] + b"\n"
                    out.append((*now, seq, header(schema, sync, codec)[:-1]))
                    seq += 1
                held.append(encode(row))
                if len(held) == block_rows:
                    flush()
            yield ready()
        flush()
        yield ready()

    kinds = T.StructType([T.StructField(p, T.StringType()) for p in parts]).add("_seq", T.LongType()).add("_block", T.BinaryType())
    rows = df.select(*[F.col(p).cast("string").alias(p) for p in parts], *fields)
    rows = rows.sortWithinPartitions(*parts) if parts else rows
    made = rows.mapInArrow(blocks, kinds).sortWithinPartitions(*parts, "_seq")
    writer = made.select(*parts, F.col("_block").cast("string").alias("value")).write.option("lineSep", "\n")
    (writer.partitionBy(*parts) if parts else writer).text(path)
