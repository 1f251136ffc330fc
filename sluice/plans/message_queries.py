"""Registered queries for message operators: events rendered as JSON/XML envelopes.

Every event becomes one message with attributes ``TopicName``, ``MessageId``,
``LogicalDate`` and ``publish_time = ts``.  ``event_id`` picks the damage
(one kind per message), so the oracle can predict each message's fate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.messages_json import bind_json_messages
from sluice.operators.messages_xml import archive_lines, bind_xml_messages
from sluice.operators.results import bad_rows, good_rows
from sluice.plans.table_queries import pin_utc, read

SQL: dict[str, str] = {}

TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
DATA_TYPE = "array<struct<AppointmentId:string,TimestampUtc:string,Disciplines:array<string>>>"


def _s(c: Column) -> Column:
    return c.cast("string")


def attributes(drop_logical_date: Column | None = None) -> Column:
    day = F.date_format("ts", "yyyy-MM-dd")
    if drop_logical_date is not None:
        day = F.when(~drop_logical_date, day)
    m = F.create_map(
        F.lit("TopicName"), F.lit("events"),
        F.lit("MessageId"), F.concat(F.lit("msg-"), _s(F.col("event_id"))),
        F.lit("LogicalDate"), day,
    )
    return F.map_filter(m, lambda k, v: v.isNotNull())


def json_envelopes(e: DataFrame) -> DataFrame:
    k = F.col("event_id") % 10
    et, eid = F.col("event_type"), _s(F.col("event_id"))
    ts_text = F.date_format("ts", TS_TEXT)
    kval = F.get_json_object("props", "$.k")
    type_json = (F.when(k == 5, F.concat(F.lit('{"name":"'), et, F.lit('"}')))
                 .when(k == 6, _s(F.col("user_id")))
                 .when(k == 8, F.concat(F.lit('"'), et, F.lit('é"')))
                 .otherwise(F.concat(F.lit('"'), et, F.lit('"'))))
    detail = F.concat(
        F.lit('{"AppointmentId":"evt-'), eid, F.lit('","TimestampUtc":"'), ts_text,
        F.lit('","Disciplines":["'), et, F.lit('","k'), kval, F.lit('"]'),
        F.when(k == 3, F.lit(',"Note":"x"')).otherwise(F.lit("")), F.lit("}"),
    )
    data_json = F.when(k == 4, detail).otherwise(F.concat(F.lit("["), detail, F.lit("]")))
    extra = (F.when(k == 2, F.concat(F.lit(',"Extra":'), _s(F.col("user_id"))))
             .when(k == 7, F.concat(F.lit(',"MessageId":"payload-'), eid, F.lit('"')))
             .otherwise(F.lit("")))
    full = F.concat(F.lit('{"Type":'), type_json, F.lit(',"Data":'), data_json, extra, F.lit("}"))
    payload = F.when(k == 1, F.expr("substring(__full, 1, length(__full) - 1)")).otherwise(F.col("__full"))
    return (e.withColumn("__full", full)
            .select("event_id", payload.alias("payload"), attributes(k == 9).alias("attributes"), F.col("ts").alias("publish_time")))


_JSON_CTE = """
WITH e AS (
  SELECT *, event_id % 10 AS k, CAST(event_id AS VARCHAR) AS eid,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_text, json_extract_string(props, '$.k') AS kval
  FROM events),
p AS (
  SELECT *,
    '{"Type":' ||
    CASE k WHEN 5 THEN '{"name":"' || event_type || '"}' WHEN 6 THEN CAST(user_id AS VARCHAR)
           WHEN 8 THEN '"' || event_type || 'é"' ELSE '"' || event_type || '"' END ||
    ',"Data":' ||
    CASE k WHEN 4 THEN '' ELSE '[' END ||
    '{"AppointmentId":"evt-' || eid || '","TimestampUtc":"' || ts_text || '","Disciplines":["' || event_type ||
    '","k' || kval || '"]' || CASE k WHEN 3 THEN ',"Note":"x"' ELSE '' END || '}' ||
    CASE k WHEN 4 THEN '' ELSE ']' END ||
    CASE k WHEN 2 THEN ',"Extra":' || CAST(user_id AS VARCHAR) WHEN 7 THEN ',"MessageId":"payload-' || eid || '"' ELSE '' END ||
    '}' AS body
  FROM e)
"""


def json_bind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON messages bound to the appointment record (M1-M4)."""
    pin_utc(spark)
    good = good_rows(bind_json_messages(json_envelopes(read(spark, sf_dir, "events"))))
    detail = F.col("Data")[0]
    return good.select(
        "Type", detail["AppointmentId"].alias("AppointmentId"), detail["TimestampUtc"].alias("TimestampUtc"),
        F.array_join(detail["Disciplines"], "|").alias("disciplines"), F.size("Data").alias("n_data"),
        "TopicName", "MessageId", "LogicalDate",
    )


SQL["json_bind"] = _JSON_CTE + """
SELECT CASE k WHEN 6 THEN CAST(user_id AS VARCHAR) WHEN 8 THEN event_type || 'é' ELSE event_type END AS "Type",
       'evt-' || eid AS "AppointmentId", ts_text AS "TimestampUtc", event_type || '|k' || kval AS disciplines,
       1 AS n_data, 'events' AS "TopicName", 'msg-' || eid AS "MessageId", strftime(ts, '%Y-%m-%d') AS "LogicalDate"
FROM p WHERE k IN (0, 6, 7, 8)
"""


def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Malformed, unknown-field, wrongly shaped and attribute-less messages (M3a M3c M3d M5 Q7 Q8)."""
    pin_utc(spark)
    return bad_rows(bind_json_messages(json_envelopes(read(spark, sf_dir, "events")))).select("value", "error")


JSON_ERROR = f"""
  CASE k WHEN 1 THEN 'malformed JSON payload'
         WHEN 2 THEN 'Unrecognized field "Extra"'
         WHEN 3 THEN 'Cannot bind field "Data" to {DATA_TYPE}'
         WHEN 4 THEN 'Cannot bind field "Data" to {DATA_TYPE}'
         WHEN 5 THEN 'Cannot bind field "Type" to string'
         WHEN 9 THEN 'missing attribute LogicalDate' END"""
SQL["json_rejects"] = _JSON_CTE + f"""
SELECT CASE k WHEN 1 THEN substring(body, 1, length(body) - 1) ELSE body END AS value, {JSON_ERROR} AS error
FROM p WHERE k IN (1, 2, 3, 4, 5, 9)
"""


def json_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A repeated key: the last value counts and is bound as strictly as any other (M1 M3 Q20)."""
    pin_utc(spark)
    e = read(spark, sf_dir, "events")
    kind = F.col("event_id") % 4
    last = (F.when(kind == 0, F.lit('"last"')).when(kind == 1, F.lit('{"o":1}')).when(kind == 2, F.lit("null")).otherwise(F.lit("7")))
    payload = F.concat(F.lit('{"Type":"first","Type":'), last, F.lit(',"Data":[{"AppointmentId":"a","AppointmentId":"'),
                       F.col("event_type"), F.when(F.col("event_id") % 5 == 0, F.lit('","Bogus":1,"Bogus":"2"}]}')).otherwise(F.lit('"}]}')))
    bound = bind_json_messages(e.select(payload.alias("payload"), attributes().alias("attributes")))
    return bound.select("MessageId", F.when(F.col("_error").isNull(), F.col("Type")).alias("type"),
                        F.when(F.col("_error").isNull(), F.col("Data")[0]["AppointmentId"]).alias("id"), F.col("_error").alias("error"))


SQL["json_repeated_keys"] = f"""
WITH e AS (SELECT *, event_id % 4 AS k, event_id % 5 = 0 AS bogus FROM events)
SELECT 'msg-' || CAST(event_id AS VARCHAR) AS "MessageId",
       CASE WHEN k = 1 OR bogus THEN NULL WHEN k = 0 THEN 'last' WHEN k = 3 THEN '7' END AS type,
       CASE WHEN k = 1 OR bogus THEN NULL ELSE event_type END AS id,
       CASE WHEN k = 1 THEN 'Cannot bind field "Type" to string'
            WHEN bogus THEN 'Cannot bind field "Data" to {DATA_TYPE}' END AS error
FROM e
"""


def attr_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attributes overlay payload keys and win (M2 M6)."""
    pin_utc(spark)
    e = read(spark, sf_dir, "events")
    payload = F.concat(F.lit('{"Type":"'), F.col("event_type"), F.lit('","MessageId":"payload-'),
                       _s(F.col("event_id")), F.lit('","LogicalDate":"1999-01-01","TopicName":"other"}'))
    env = e.select(payload.alias("payload"), attributes().alias("attributes"))
    return good_rows(bind_json_messages(env)).select("Type", "TopicName", "MessageId", "LogicalDate")


SQL["attr_override"] = """
SELECT event_type AS "Type", 'events' AS "TopicName", 'msg-' || CAST(event_id AS VARCHAR) AS "MessageId",
       strftime(ts, '%Y-%m-%d') AS "LogicalDate" FROM events
"""


def xml_envelopes(e: DataFrame) -> DataFrame:
    k = F.col("event_id") % 8
    et, eid = F.col("event_type"), _s(F.col("event_id"))
    ts_text = F.date_format("ts", TS_TEXT)
    kval = F.get_json_object("props", "$.k")
    inner = F.concat(
        F.lit("<Type>"), et, F.lit("</Type><Data><AppointmentId>evt-"), eid,
        F.lit("</AppointmentId><TimestampUtc>"), ts_text, F.lit("</TimestampUtc><Discipline>"), et,
        F.lit("</Discipline><Discipline>k"), kval, F.lit("</Discipline></Data>"),
    )
    namespaced = F.concat(
        F.lit('<ns:Appointments xmlns:ns="urn:appt"><ns:Type>'), et, F.lit("</ns:Type><ns:Data><ns:AppointmentId>evt-"),
        eid, F.lit("</ns:AppointmentId><ns:TimestampUtc>"), ts_text, F.lit("</ns:TimestampUtc><ns:Discipline>"), et,
        F.lit("</ns:Discipline></ns:Data></ns:Appointments>"),
    )
    payload = (
        F.when(k == 1, namespaced)
        .when(k == 2, F.concat(F.lit("<Appointment>"), inner, F.lit("</Appointment>")))
        .when(k == 3, F.concat(F.lit("<appointments>"), inner, F.lit("</appointments>")))
        .when(k == 4, F.concat(F.lit("<Appointments>"), inner, F.lit("<Data><AppointmentId>evt-"), eid,
                               F.lit("-b</AppointmentId></Data></Appointments>")))
        .when(k == 5, F.concat(F.lit("<Appointments>"), inner, F.lit("<Extra>"), _s(F.col("user_id")),
                               F.lit("</Extra></Appointments>")))
        .when(k == 6, F.concat(F.lit('<?xml version="1.0" encoding="utf-8"?><!-- event '), eid,
                               F.lit(" --><Appointments>"), inner, F.lit("</Appointments>")))
        .when(k == 7, F.concat(F.lit("<Appointments>"), inner))
        .otherwise(F.concat(F.lit("<Appointments>"), inner, F.lit("</Appointments>")))
    )
    return e.select("event_id", payload.alias("payload"), attributes().alias("attributes"), F.col("ts").alias("publish_time"))


def raw_messages(e: DataFrame) -> DataFrame:
    """Events as a broker's rows: the JSON messages of ``json_envelopes`` as bytes, attributes as headers.

    Every third message repeats a header (the last one counts), every seventeenth
    holds a byte that is no UTF-8, every nineteenth has a header that is none.
    """
    env = json_envelopes(e)
    damaged = F.when(F.col("event_id") % 17 == 0, F.concat(F.unhex(F.lit("FF")), F.col("payload").cast("binary"))).otherwise(F.col("payload").cast("binary"))

    def header(key: str, value: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), value.cast("binary").alias("value"))

    day = F.element_at("attributes", "LogicalDate")
    first = F.when(F.col("event_id") % 3 == 0, F.array(header("MessageId", F.lit("first")))).otherwise(F.array().cast("array<struct<key:string,value:binary>>"))
    topic = F.when(F.col("event_id") % 19 == 0, F.unhex(F.lit("C328"))).otherwise(F.lit("events").cast("binary"))
    headers = F.concat(first, F.array(header("TopicName", topic), header("MessageId", F.element_at("attributes", "MessageId"))),
                       F.when(day.isNotNull(), F.array(header("LogicalDate", day))).otherwise(F.array().cast("array<struct<key:string,value:binary>>")))
    return env.select("event_id", damaged.alias("value"), headers.alias("headers"), F.col("publish_time").cast("timestamp").alias("timestamp"))


def xml_bind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML messages bound and mapped to the stream table's row."""
    pin_utc(spark)
    good = good_rows(bind_xml_messages(xml_envelopes(read(spark, sf_dir, "events"))))
    detail = F.col("Data")[0]
    return good.select(
        "Type", detail["AppointmentId"].alias("AppointmentId"), detail["TimestampUtc"].alias("TimestampUtc"),
        F.array_join(detail["Disciplines"], "|").alias("disciplines"), "TopicName", "MessageId", "LogicalDate",
    )


_XML_CTE = """
WITH e AS (
  SELECT *, event_id % 8 AS k, CAST(event_id AS VARCHAR) AS eid,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_text, json_extract_string(props, '$.k') AS kval
  FROM events)
"""

SQL["xml_bind"] = _XML_CTE + """
SELECT event_type AS "Type",
       'evt-' || eid || CASE k WHEN 4 THEN '-b' ELSE '' END AS "AppointmentId",
       CASE k WHEN 4 THEN NULL ELSE ts_text END AS "TimestampUtc",
       CASE k WHEN 4 THEN '' WHEN 1 THEN event_type ELSE event_type || '|k' || kval END AS disciplines,
       'events' AS "TopicName", 'msg-' || eid AS "MessageId", strftime(ts, '%Y-%m-%d') AS "LogicalDate"
FROM e WHERE k IN (0, 1, 4, 5, 6)
"""


def xml_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same messages spread over a fixed number of tasks before the parse."""
    pin_utc(spark)
    good = good_rows(bind_xml_messages(xml_envelopes(read(spark, sf_dir, "events")), parse_partitions=12))
    detail = F.col("Data")[0]
    return good.select("Type", detail["AppointmentId"].alias("AppointmentId"), detail["TimestampUtc"].alias("TimestampUtc"),
                       F.array_join(detail["Disciplines"], "|").alias("disciplines"), "TopicName", "MessageId", "LogicalDate")


SQL["xml_reshard"] = SQL["xml_bind"]


def xml_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrong root, lower-case root and malformed XML, with the attribute triple (X2a X2d X5)."""
    pin_utc(spark)
    return bad_rows(bind_xml_messages(xml_envelopes(read(spark, sf_dir, "events")))).select("value", "error")


SQL["xml_rejects"] = _XML_CTE + """
, x AS (
  SELECT *, '<Type>' || event_type || '</Type><Data><AppointmentId>evt-' || eid || '</AppointmentId><TimestampUtc>' ||
         ts_text || '</TimestampUtc><Discipline>' || event_type || '</Discipline><Discipline>k' || kval ||
         '</Discipline></Data>' AS core FROM e)
SELECT CASE k WHEN 2 THEN '<Appointment>' || core || '</Appointment>'
              WHEN 3 THEN '<appointments>' || core || '</appointments>'
              ELSE '<Appointments>' || core END
       || ',events,msg-' || eid || ',' || strftime(ts, '%Y-%m-%d') AS value,
       CASE k WHEN 2 THEN 'unexpected element (expected <Appointments>): <Appointment>'
              WHEN 3 THEN 'unexpected element (expected <Appointments>): <appointments>'
              ELSE 'malformed XML payload' END AS error
FROM x WHERE k IN (2, 3, 7)
"""


def raw_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message as archive text with its 1-minute window; missing attribute -> empty slot."""
    pin_utc(spark)
    e = read(spark, sf_dir, "events")
    payload = F.concat(F.lit('{"event_id":'), _s(F.col("event_id")), F.lit(',"type":"'), F.col("event_type"), F.lit('"}'))
    env = e.select(payload.alias("payload"), attributes(F.col("event_id") % 10 == 9).alias("attributes"),
                   F.col("ts").alias("publish_time"))
    return archive_lines(env)


SQL["raw_archive"] = """
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%dT%H:%M') AS "window",
       '{"event_id":' || CAST(event_id AS VARCHAR) || ',"type":"' || event_type || '"},events,msg-' ||
       CAST(event_id AS VARCHAR) || ',' || CASE WHEN event_id % 10 = 9 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS value
FROM events
"""

QUERIES = {
    "json_bind": json_bind,
    "json_rejects": json_rejects,
    "json_repeated_keys": json_repeated_keys,
    "attr_override": attr_override,
    "xml_bind": xml_bind,
    "xml_reshard": xml_reshard,
    "xml_rejects": xml_rejects,
    "raw_archive": raw_archive,
}
