"""Message sources (S12) and payload decoding.

An envelope is ``payload STRING, attributes MAP<STRING,STRING>,
publish_time TIMESTAMP`` and ``malformed STRING``: the whole line of an
envelope that cannot be read as such, or ``base64:`` and the bytes of a payload
that is no UTF-8; NULL for a sound envelope.  Messages come from a folder of JSON-lines
envelopes (batch or stream), from Kafka where Spark's Kafka module is deployed
(value -> payload, headers -> attributes, timestamp -> publish time), or from
Parquet files that hold such rows, say a topic's backup.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENVELOPE = T.StructType([
    T.StructField("payload", T.StringType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
    T.StructField("publish_time", T.TimestampType()),
    T.StructField("malformed", T.StringType()),
])
_READ = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed"}


def decode_payload(payload: Column) -> Column:
    """Bytes -> UTF-8 text; invalid UTF-8 gives NULL, which binds as malformed."""
    text = payload.cast("string")
    return F.when(F.is_valid_utf8(text), text)


def kafka_envelopes(df: DataFrame) -> DataFrame:
    """Kafka rows -> envelopes: value -> payload, headers -> attributes, timestamp -> publish time.

    A header key may repeat in Kafka; the last value wins (a map cannot hold
    the key twice).  A value that is no UTF-8 keeps its bytes in ``malformed``, on
    one line (Spark breaks long base64 text, which an archive of lines must not).
    """
    headers = F.coalesce(F.col("headers"), F.array().cast("array<struct<key:string,value:binary>>"))
    keys = F.transform(headers, lambda h: h["key"])
    last = F.filter(headers, lambda h, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), h["key"]))
    attributes = F.map_from_entries(F.transform(last, lambda h: F.struct(h["key"], decode_payload(h["value"]))))
    value = F.col("value")
    lost = F.when(value.isNotNull() & ~F.is_valid_utf8(value.cast("string")), F.concat(F.lit("base64:"), F.translate(F.base64(value), "\r\n", "")))
    return df.select(decode_payload(value).alias("payload"), attributes.alias("attributes"),
                     F.col("timestamp").alias("publish_time"), lost.alias("malformed"))


RAW = T.StructType([
    T.StructField("value", T.BinaryType()),
    T.StructField("headers", T.ArrayType(T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())]))),
    T.StructField("timestamp", T.TimestampType()),
])
"""A broker's rows as they are kept in files: bytes, headers that may repeat, the broker's time."""


def read_raw_messages(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a broker's rows from Parquet files, as envelopes."""
    return kafka_envelopes(spark.read.schema(RAW).parquet(path))


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of JSON-lines envelopes."""
    return spark.read.schema(ENVELOPE).options(**_READ).json(path)


def read_message_stream(
    spark: SparkSession,
    subscription: str,
    kafka_options: Mapping[str, str] | None = None,
    max_files_per_trigger: int | None = None,
    raw: bool = False,
) -> DataFrame:
    """Streaming read: Kafka topic(s) when ``kafka_options`` is given, else a folder of envelopes, or with ``raw`` of a broker's rows in Parquet files."""
    if kafka_options:
        reader = spark.readStream.format("kafka").option("subscribe", subscription).option("includeHeaders", "true")
        for k, v in kafka_options.items():
            reader = reader.option(k, v)
        return kafka_envelopes(reader.load())
    reader = spark.readStream.schema(RAW if raw else ENVELOPE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return kafka_envelopes(reader.parquet(subscription)) if raw else reader.options(**_READ).json(subscription)
