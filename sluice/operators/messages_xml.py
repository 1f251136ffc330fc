"""XML messages -> records (X1-X6) and message attribute helpers (M6).

The payload is bound with ``from_xml`` (namespaces ignored, unknown children
ignored, a repeated single element keeps the last one).  ``from_xml`` does
not check the root element's name, so a regex on the first element's local
name does (after an XML declaration, comments or a DOCTYPE).  Malformed XML,
a wrong root or a missing attribute sends the message to the dead-letter
store as ``payload,TopicName,MessageId,LogicalDate``.  Document type
declarations are not processed (no entity expansion, nothing fetched), so a
payload that carries one is dead-lettered as malformed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.messages_json import ATTRIBUTE_KEYS
from sluice.operators.results import ERROR_COL, RAW_COL, SRC_COL, first_error, stage_barrier

# Possessive loops run in constant stack, however many comments come before the root.
ROOT_RX = r"(?s)^\uFEFF?\s*+(?:<\?.*?\?>\s*+|<!--.*?-->\s*+|<!DOCTYPE[^>]*+>\s*+)*+<(?:[\w.-]++:)?([\w.-]++)"
NO_TIME_WINDOW = "unknown"
_CORRUPT = "_corrupt_record"

XML_APPOINTMENT = T.StructType([
    T.StructField("Type", T.StringType()),
    T.StructField("Data", T.StructType([
        T.StructField("AppointmentId", T.StringType()),
        T.StructField("TimestampUtc", T.StringType()),
        T.StructField("Discipline", T.ArrayType(T.StringType())),
    ])),
])


def minute_window(time: Column) -> Column:
    """Start of the 1-minute event-time window as text; a message without a time goes to ``unknown``."""
    return F.coalesce(F.date_format(F.date_trunc("minute", time), "yyyy-MM-dd'T'HH:mm"), F.lit(NO_TIME_WINDOW))


def attribute_triple(attrs: Column, keys: tuple[str, ...] = ATTRIBUTE_KEYS) -> Column:
    """``TopicName,MessageId,LogicalDate``; a missing key leaves an empty slot."""
    return F.concat_ws(",", *[F.coalesce(F.element_at(attrs, F.lit(k)), F.lit("")) for k in keys])


def appointments_row(parsed: Column, attrs: Column) -> list[Column]:
    """XML appointment -> the stream table's row (``Data`` repeated, ``Disciplines``)."""
    data = parsed.getField("Data")
    detail = F.struct(
        data.getField("AppointmentId").alias("AppointmentId"),
        data.getField("TimestampUtc").alias("TimestampUtc"),
        # A bound list is never NULL: no <Discipline> gives an empty list.
        F.coalesce(data.getField("Discipline"), F.array().cast("array<string>")).alias("Disciplines"),
    )
    return [
        parsed.getField("Type").alias("Type"),
        F.when(data.isNotNull(), F.array(detail)).alias("Data"),
        *[F.element_at(attrs, F.lit(k)).alias(k) for k in ("TopicName", "MessageId", "LogicalDate")],
    ]


def bind_xml_messages(
    df: DataFrame,
    schema: T.StructType = XML_APPOINTMENT,
    row_tag: str = "Appointments",
    to_row: Callable[[Column, Column], list[Column]] = appointments_row,
    payload_col: str = "payload",
    attributes_col: str = "attributes",
    required_attributes: tuple[str, ...] = ATTRIBUTE_KEYS,
    parse_partitions: int | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Bind each XML payload; adds ``_error``/``_raw``/``_src``.

    ``parse_partitions`` spreads the parse over that many tasks first (one
    shuffle), for sources that deliver few, large partitions.
    """
    keep = list(keep or [])
    if parse_partitions:
        df = df.repartition(parse_partitions)
    payload = F.col(payload_col)
    attrs = F.coalesce(F.col(attributes_col), F.create_map().cast("map<string,string>"))
    full = T.StructType(list(schema.fields) + [T.StructField(_CORRUPT, T.StringType())])
    # Text keeps its surrounding blanks, as an XML binder keeps them.
    opts = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": _CORRUPT}
    base = df.select(
        *keep,
        payload.alias("__payload"),
        attrs.alias("__attrs"),
        F.regexp_extract(payload, ROOT_RX, 1).alias("__root"),
        F.from_xml(payload, full, opts).alias("__x"),
    )
    p, a, root, x = (F.col(c) for c in ("__payload", "__attrs", "__root", "__x"))
    errors = [
        F.when(p.isNull() | x.isNull() | x.getField(_CORRUPT).isNotNull(), F.lit("malformed XML payload")),
        F.when(root != row_tag, F.concat(F.lit(f"unexpected element (expected <{row_tag}>): <"), root, F.lit(">"))),
    ]
    for k in required_attributes:
        errors.append(F.when(~F.map_contains_key(a, F.lit(k)), F.lit(f"missing attribute {k}")))
    raw = F.concat_ws(",", F.coalesce(p, F.lit("")), attribute_triple(a, required_attributes))
    return base.select(*keep, *to_row(x, a), first_error(errors).alias(ERROR_COL), raw.alias(RAW_COL),
                       F.element_at(a, F.lit("MessageId")).alias(SRC_COL), stage_barrier())


def archive_lines(
    df: DataFrame,
    payload_col: str = "payload",
    attributes_col: str = "attributes",
    time_col: str = "publish_time",
    keys: tuple[str, ...] = ATTRIBUTE_KEYS,
) -> DataFrame:
    """Every message as ``payload,TopicName,MessageId,LogicalDate`` with its minute.

    ``window`` is the start of the message's 1-minute event-time window
    (``unknown`` without a time); the archive is written partitioned by it.  An
    envelope that could not be read is archived as it came.
    """
    attrs = F.coalesce(F.col(attributes_col), F.create_map().cast("map<string,string>"))
    value = F.concat_ws(",", F.coalesce(F.col(payload_col), F.lit("")), attribute_triple(attrs, keys))
    if "malformed" in df.columns:
        value = F.coalesce(F.col("malformed"), value)
    return df.select(minute_window(F.col(time_col)).alias("window"), value.alias("value"))
