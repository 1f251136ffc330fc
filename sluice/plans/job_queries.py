"""Registered end-to-end queries: whole jobs over files written from the tables.

Each query writes its input files (rendered from a table by Spark) into a
fresh folder under the shared checkpoint root, runs the job, and returns the
table the job wrote, read back.  Lineage ids and load times are left out of
the comparison because they are random or time-dependent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.plans.jobs import csv_batch, run
from sluice.plans.message_queries import SQL as MESSAGE_SQL
from sluice.plans.message_queries import _JSON_CTE, _XML_CTE, JSON_ERROR, json_envelopes, raw_messages, xml_envelopes
from sluice.plans.table_queries import SQL as TABLE_SQL
from sluice.plans.table_queries import csv_line, pin_utc, read
from sluice.session import scratch_path
from sluice.sinks.avro_files import write_avro
from sluice.sinks.publish import AT_ONCE, Files
from sluice.sinks.table import write_table, write_text
from sluice.streaming.stream import start_message_stream

SQL: dict[str, str] = {}


def _mkdir(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def csv_batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 through J5 end to end: dated CSV files with header/trailer lines -> table.

    One folder and file per ship day.  The configured path is a decoy: the
    runtime path wins (S2).  The folder's name holds a space and a plus sign,
    which the lineage column must show.
    """
    pin_utc(spark)
    root = scratch_path(spark, "csv-batch")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")  # shuffled by day below anyway
    data = csv_line(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_returnflag"))
    header = F.when(F.col("l_linenumber") == 1, F.lit("l_orderkey,l_linenumber,l_quantity,l_extendedprice,l_returnflag"))
    trailer = F.when(F.col("l_linenumber") == 1, F.lit("Tr,1"))
    lines = li.select(
        F.date_format("l_shipdate", "yyyyMMdd").alias("day"),
        F.explode(F.filter(F.array(header, data, trailer), lambda x: x.isNotNull())).alias("value"),
    )
    lines.repartition("day").write.options(**AT_ONCE).partitionBy("day").text(f"{root}/in files+1")
    _mkdir(spark, f"{root}/table")
    config = {
        "FileSource": {
            "location": {"path": f"{root}/nowhere/*.txt", "extractDateRegex": r"files\+1/day=(\d{8})"},
            "headerRegex": "^l_orderkey.*", "trailerRegex": "^Tr.*", "splitter": ",",
        },
        "CsvToTableRowTransform": {"headers": "l_orderkey:LONG,l_linenumber:INTEGER,l_quantity:DOUBLE,l_extendedprice:DOUBLE,l_returnflag:STRING,ship_day:DATE(yyyyMMdd)"},
        "BigQuerySinkDynamic": {"table": f"{root}/table", "loadTimeField": "bq_load_dttm", "pField": ""},
        "errorPath": f"{root}/errors",
    }
    run(spark, "csv_batch", config, file_path=f"{root}/in files+1/*/*.txt")
    return spark.read.parquet(f"{root}/table").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "ship_day",
        F.col("bq_row_src").contains("/in files+1/day=").alias("has_source"),
        F.col("bq_load_dttm").isNotNull().alias("has_load_time"), F.length("bq_row_id").alias("id_length"))


SQL["csv_batch_files"] = """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS ship_day,
       TRUE AS has_source, TRUE AS has_load_time, 36 AS id_length FROM lineitem
"""


def csv_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 dead-letter path end to end: damaged order files -> dead-letter store."""
    from sluice.plans.table_queries import ORDERS_HEADERS, damaged_order_lines

    pin_utc(spark)
    root = scratch_path(spark, "csv-dead")
    lines = damaged_order_lines(read(spark, sf_dir, "orders")).withColumnRenamed("line", "value")
    lines.write.text(f"{root}/in")
    _mkdir(spark, f"{root}/table")
    config = {
        "FileSource": {"location": {"path": f"{root}/in/*.txt", "extractDateRegex": ""},
                       "headerRegex": None, "trailerRegex": None, "splitter": ","},
        "CsvToTableRowTransform": {"headers": ORDERS_HEADERS},
        "BigQuerySinkDynamic": {"table": f"{root}/table", "loadTimeField": "", "pField": ""},
        "errorPath": f"{root}/errors",
    }
    csv_batch(spark, config)
    schema = "value string, error string, source string"
    return spark.read.schema(schema).json(f"{root}/errors").select("value", "error")


_KIND = {"type": "enum", "name": "Kind", "symbols": ["view", "click", "purchase", "error", "signup"]}
_FIXED = [
    {"name": "EventId", "type": "long"}, {"name": "Kind", "type": _KIND},
    {"name": "Ts", "type": {"type": "long", "logicalType": "timestamp-millis"}},
    {"name": "Day", "type": {"type": "int", "logicalType": "date"}},
    {"name": "AtMillis", "type": {"type": "int", "logicalType": "time-millis"}},
    {"name": "Amount", "type": {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 2}},
    {"name": "Score", "type": "double"},
]
EVENTS_V1 = {"type": "record", "name": "Event", "fields": _FIXED + [
    {"name": "Minute", "type": "int"}, {"name": "UserId", "type": "int"}, {"name": "Ratio", "type": "float"}, {"name": "Props", "type": "string"}]}
"""The schema of files up to the 15th of a month ..."""
EVENTS_V2 = {"type": "record", "name": "Event", "fields": _FIXED + [
    {"name": "Minute", "type": ["null", "int"]}, {"name": "UserId", "type": "long"}, {"name": "Ratio", "type": ["double", "null"]},
    {"name": "Props", "type": ["string", "null"]}, {"name": "Late", "type": "boolean"}]}
"""... and of those after: nullable, wider and new fields."""


def avro_batch_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 through J5 end to end: Avro files of two schemas in day folders -> table.

    The files are read by Avro's own library; fields that the schemas type
    unlike each other take a type that holds both.  Amounts are negative for odd ids.
    """
    pin_utc(spark)
    root = scratch_path(spark, "avro-batch")
    ts = F.col("ts").cast("timestamp")
    late = F.dayofmonth("ts") > 15
    sign = F.when(F.col("event_id") % 2 == 1, -1).otherwise(1)
    e = read(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("folder"), late.alias("Late"),
        F.col("event_id").cast("long").alias("EventId"), F.col("event_type").alias("Kind"), F.unix_millis(ts).alias("Ts"),
        F.unix_date(F.to_date(ts)).alias("Day"), (F.unix_millis(ts) % 86_400_000).cast("int").alias("AtMillis"),
        (F.round(F.col("value") * 100).cast("decimal(12,0)") * sign / 100).cast("decimal(12,2)").alias("Amount"), F.col("value").alias("Score"),
        F.when(~late | (F.col("event_id") % 4 != 0), F.minute("ts")).alias("Minute"), F.col("user_id").alias("UserId"),
        F.when(late, F.when(F.col("event_id") % 3 != 0, F.col("value"))).otherwise(F.col("value").cast("float").cast("double")).alias("Ratio"),
        F.when(~late | (F.col("event_id") % 5 != 0), F.coalesce("props", F.lit(""))).alias("Props"))
    e = e.repartition("folder")  # a file a day
    write_avro(e.where(~F.col("Late")), f"{root}/in/v1", EVENTS_V1, ["folder"])
    write_avro(e.where("Late"), f"{root}/in/v2", EVENTS_V2, ["folder"], codec="null")
    _mkdir(spark, f"{root}/table")
    config = {
        "AvroSource": {"rowText": True, "path": f"{root}/nowhere/*.avro", "partition": {"extractDateRegex": r"folder=(\d{8})", "pFieldName": "pdate"}},
        "JsonStrategyTransform": {"jsonStrategy": [
            {"location": "/pdate", "operation": "DATE(yyyyMMdd)"}, {"location": "/eventid", "operation": "STRING"}]},
        "BigQuerySinkDynamic": {"table": f"{root}/table", "loadTimeField": "bq_load_dttm", "pField": ""},
        "errorPath": f"{root}/errors",
    }
    run(spark, "avro_batch", config, file_path=f"{root}/in/*/folder=*/*.txt")
    table = spark.read.parquet(f"{root}/table")
    return table.select(
        F.col("eventid").cast("string").alias("eventid"), "kind", "ts", "day", "atmillis", F.col("amount").cast("string").alias("amount"), "score",
        F.col("minute").cast("long").alias("minute"), F.col("userid").cast("long").alias("userid"), F.col("ratio").cast("double").alias("ratio"),
        "props", "late", "pdate", F.col("bq_row_src").contains("/folder=").alias("has_source"), F.col("bq_load_dttm").isNotNull().alias("has_load_time"),
        F.length("bq_row_id").alias("id_length"))


SQL["avro_batch_files"] = """
WITH e AS (SELECT *, date_trunc('millisecond', ts) AS tm, day(ts) > 15 AS late FROM events)
SELECT CAST(event_id AS VARCHAR) AS eventid, event_type AS kind, strftime(tm, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS ts,
       strftime(ts, '%Y-%m-%d') AS day, strftime(tm, '%H:%M:%S.%g') AS atmillis,
       CAST(CAST(round(value * 100) * (CASE WHEN event_id % 2 = 1 THEN -1 ELSE 1 END) / 100 AS DECIMAL(12,2)) AS VARCHAR) AS amount,
       value AS score, CASE WHEN NOT late OR event_id % 4 <> 0 THEN CAST(minute(ts) AS BIGINT) END AS minute, CAST(user_id AS BIGINT) AS userid,
       CASE WHEN NOT late THEN CAST(CAST(value AS FLOAT) AS DOUBLE) WHEN event_id % 3 <> 0 THEN value END AS ratio,
       CASE WHEN NOT late OR event_id % 5 <> 0 THEN coalesce(props, '') END AS props, CASE WHEN late THEN TRUE END AS late,
       strftime(ts, '%Y-%m-%d') AS pdate, TRUE AS has_source, TRUE AS has_load_time, 36 AS id_length
FROM e
"""


SINK_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_orderdate", T.StringType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_orderdate_day", T.StringType()),
])


def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-partitioned table writes and read-back, a partition per order day (K1 K3 K4 K5 K6)."""
    pin_utc(spark)
    root = scratch_path(spark, "sink")
    _mkdir(spark, root)
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderstatus")
    write_table(o, root, disposition="WRITE_EMPTY", partition_field="o_orderdate", load_time_field="bq_load_dttm")
    return spark.read.schema(SINK_SCHEMA).parquet(root)


SQL["sink_partitioned"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderstatus, strftime(o_orderdate, '%Y%m%d') AS o_orderdate_day FROM orders
"""


def sink_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a sink refuses, and what a load that dies leaves (K5 K6).

    A target that is not there and one that is not empty are refused; a
    replacing load that dies on its last rows leaves every old row.
    """
    pin_utc(spark)
    root = scratch_path(spark, "failures")
    _mkdir(spark, root)
    e = read(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.lit("first").alias("load"))
    write_table(e, root, partition_field="day")
    poison = F.when(F.rand(1) >= 0, F.raise_error(F.concat(F.lit("poison "), F.col("day"))).cast("string"))
    again = e.withColumn("load", F.when(F.col("day") < "2024-01-20", F.lit("second")).otherwise(poison))
    outcomes = {}
    for name, df, target, disposition in (("missing", e, f"{root}-missing", "WRITE_APPEND"), ("not_empty", e, root, "WRITE_EMPTY"), ("died", again, root, "WRITE_TRUNCATE")):
        try:
            write_table(df, target, disposition=disposition, partition_field="day")
            outcomes[name] = "written"
        except FileNotFoundError:
            outcomes[name] = "no table"
        except ValueError:
            outcomes[name] = "refused"
        except Exception as exc:  # noqa: BLE001 - the load's own failure
            outcomes[name] = "poison" if "poison" in str(exc) else repr(exc)
    table = spark.read.schema("event_id long, day string, load string").parquet(root)
    return table.select("event_id", "day", "load", *[F.lit(v).alias(k) for k, v in outcomes.items()])


SQL["sink_failures"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, 'first' AS load, 'no table' AS missing, 'refused' AS not_empty, 'poison' AS died FROM events
"""


def sink_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load that truncates replaces its own days and leaves the others (K4 K5)."""
    pin_utc(spark)
    root = scratch_path(spark, "truncate")
    _mkdir(spark, root)
    e = read(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), F.lit("first").alias("load"))
    write_table(e, root, partition_field="day")
    again = e.where(F.dayofmonth("day") % 2 == 0).withColumn("load", F.lit("second"))
    write_table(again, root, disposition="WRITE_TRUNCATE", partition_field="day")
    return spark.read.schema("event_id long, day string, load string").parquet(root).select("event_id", "day", "load")


SQL["sink_truncate"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, CASE WHEN day(ts) % 2 = 0 THEN 'second' ELSE 'first' END AS load FROM events
"""


def text_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text lines written in one folder per window and read back (K7)."""
    root = scratch_path(spark, "text")
    e = read(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("window"), F.concat_ws("|", F.col("event_id").cast("string"), "event_type").alias("value"))
    write_text(e, root, partition_cols=["window"], num_files=4)
    return spark.read.schema("value string, window string").text(root)


SQL["text_sink"] = """
SELECT CAST(event_id AS VARCHAR) || '|' || event_type AS value, strftime(ts, '%Y-%m-%d') AS "window" FROM events
"""


BATCHES = 4
FILE_EVENTS = 200_000
"""Events for which each arrival gets a file more: a file stays at some ten MB of lines, however many events there are."""


def _arrivals(env: DataFrame, clock: str) -> DataFrame:
    """Messages with the micro-batch they come in: by the third of the two hours, but every thirteenth comes late, in the last one."""
    third = F.floor((F.hour(clock) % 2 * 60 + F.minute(clock)) / 40).cast("int")
    return env.withColumn("arrival", F.when(F.col("event_id") % 13 == 0, BATCHES - 1).otherwise(third))


def _two_hours(time: str):
    """A time of the events' month in the same minute of two hours of one day."""
    return F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), F.lit(9) + F.hour(time) % 2, F.minute(time), F.second(time).cast("decimal(8,6)"))


def _files_per_arrival(events: DataFrame) -> int:
    """Files that each arrival's messages are written to; the stream takes as many at a time, so an arrival is a micro-batch."""
    return max(2, -(-events.count() // FILE_EVENTS))


def _run_stream(spark: SparkSession, sf_dir: str, kind: str, odd: bool = False, compact_every: int | None = None) -> tuple[str, bool]:
    """A stream of all events in four micro-batches, the last one with late messages, each in its minute of two hours.

    With ``odd`` every seventh message has no publish time and every eleventh is a
    broken line.  Returns the folder of the outputs, and whether the stream did
    take several batches.
    """
    pin_utc(spark)
    root = scratch_path(spark, f"stream-{kind}")
    events = _arrivals(spark.read.parquet(f"{sf_dir}/events.parquet"), "ts")  # dealt to the writers below anyway
    render = json_envelopes if kind == "json" else xml_envelopes
    time = _two_hours("publish_time").cast("timestamp")
    time = F.when(F.col("event_id") % 7 != 0, time) if odd else time
    line = F.to_json(F.struct("payload", "attributes", time.alias("publish_time")))
    if odd:
        broken = F.concat(F.lit('{"payload":"cut-'), F.col("event_id").cast("string"))
        line = F.when(F.col("event_id") % 11 == 0, broken).otherwise(line)
    files = _files_per_arrival(events)
    for k in range(BATCHES):  # one after the other: the stream takes files in the order they came
        arrived = events.where(F.col("arrival") == k).repartition(files)
        render(arrived).select(line.alias("value")).write.mode("append").text(f"{root}/in")
    _mkdir(spark, f"{root}/table")
    config = {
        "errorPath": f"{root}/errors", "messages-bucket": f"{root}/archive",
        "BigQuerySinkDynamicStream": {"table": f"{root}/table", "loadTimeField": "bq_load_dttm", "pField": "",
                                      "customGcsTempLocation": f"{root}/checkpoint"},
    }
    start_message_stream(spark, kind, config, f"{root}/in", available_now=True, max_files_per_trigger=files, files_per_window=1,
                         compact_every=compact_every).awaitTermination()
    commits = [n for n in Files(spark, root).children(f"{root}/checkpoint/commits") if n.isdigit()]
    return root, len(commits) >= 3


def _stream_table(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    root, several = _run_stream(spark, sf_dir, kind, compact_every=2)
    table = spark.read.parquet(f"{root}/table")
    detail = F.col("Data")[0]
    cols = ["Type", detail["AppointmentId"].alias("AppointmentId"), detail["TimestampUtc"].alias("TimestampUtc"),
            F.array_join(detail["Disciplines"], "|").alias("disciplines")]
    if kind == "json":
        cols.append(F.size("Data").alias("n_data"))
    return table.select(*cols, "TopicName", "MessageId", "LogicalDate", F.lit(several).alias("several_batches"))


def stream_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON envelopes streamed in several batches, late ones too, into a table that is compacted meanwhile."""
    return _stream_table(spark, sf_dir, "json")


def stream_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XML envelopes streamed in several batches, late ones too, into a table that is compacted meanwhile."""
    return _stream_table(spark, sf_dir, "xml")


def _archive(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("value string, window string, batch string").text(f"{root}/archive").select("window", "value")


def _dead_letters(spark: SparkSession, root: str) -> DataFrame:
    schema = "value string, error string, source string, window string, batch string"
    return spark.read.schema(schema).json(f"{root}/errors").select("window", "value", "error", "source")


def stream_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw archive a JSON stream wrote: a line per message that came in, under its minute."""
    return _archive(spark, _run_stream(spark, sf_dir, "json", odd=True)[0])


def stream_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dead letters a JSON stream wrote, broken envelopes and messages without a time too."""
    return _dead_letters(spark, _run_stream(spark, sf_dir, "json", odd=True)[0])


def stream_xml_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw archive an XML stream wrote."""
    return _archive(spark, _run_stream(spark, sf_dir, "xml", odd=True)[0])


def stream_xml_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dead letters an XML stream wrote."""
    return _dead_letters(spark, _run_stream(spark, sf_dir, "xml", odd=True)[0])


_ODD = """
  CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN 'unknown' ELSE '2024-01-01T' || CASE WHEN hour(ts) % 2 = 0 THEN '09' ELSE '10' END || strftime(ts, ':%M') END AS minute,
  '{"payload":"cut-' || eid AS cut"""
_ODD_CTE = _JSON_CTE + f"""
, m AS (SELECT *, CASE k WHEN 1 THEN substring(body, 1, length(body) - 1) ELSE body END AS payload, {_ODD} FROM p)
"""
_XML_ODD_CTE = _XML_CTE + f"""
, x AS (
  SELECT *, '<Type>' || event_type || '</Type><Data><AppointmentId>evt-' || eid || '</AppointmentId><TimestampUtc>' ||
         ts_text || '</TimestampUtc><Discipline>' || event_type || '</Discipline><Discipline>k' || kval || '</Discipline></Data>' AS core FROM e),
m AS (
  SELECT *, {_ODD},
    CASE k WHEN 1 THEN '<ns:Appointments xmlns:ns="urn:appt"><ns:Type>' || event_type || '</ns:Type><ns:Data><ns:AppointmentId>evt-' || eid ||
                       '</ns:AppointmentId><ns:TimestampUtc>' || ts_text || '</ns:TimestampUtc><ns:Discipline>' || event_type ||
                       '</ns:Discipline></ns:Data></ns:Appointments>'
           WHEN 2 THEN '<Appointment>' || core || '</Appointment>' WHEN 3 THEN '<appointments>' || core || '</appointments>'
           WHEN 4 THEN '<Appointments>' || core || '<Data><AppointmentId>evt-' || eid || '-b</AppointmentId></Data></Appointments>'
           WHEN 5 THEN '<Appointments>' || core || '<Extra>' || CAST(user_id AS VARCHAR) || '</Extra></Appointments>'
           WHEN 6 THEN '<?xml version="1.0" encoding="utf-8"?><!-- event ' || eid || ' --><Appointments>' || core || '</Appointments>'
           WHEN 7 THEN '<Appointments>' || core ELSE '<Appointments>' || core || '</Appointments>' END
    || ',events,msg-' || eid || ',' || strftime(ts, '%Y-%m-%d') AS line
  FROM x)
"""
SQL["stream_archive"] = _ODD_CTE + """
SELECT minute AS "window", CASE WHEN event_id % 11 = 0 THEN cut ELSE
  payload || ',events,msg-' || eid || ',' || CASE k WHEN 9 THEN '' ELSE strftime(ts, '%Y-%m-%d') END END AS value FROM m
"""
SQL["stream_dead_letters"] = _ODD_CTE + f"""
SELECT minute AS "window", CASE WHEN event_id % 11 = 0 THEN cut ELSE payload END AS value,
  CASE WHEN event_id % 11 = 0 THEN 'malformed message envelope' ELSE {JSON_ERROR} END AS error,
  CASE WHEN event_id % 11 <> 0 THEN 'msg-' || eid END AS source
FROM m WHERE event_id % 11 = 0 OR k IN (1, 2, 3, 4, 5, 9)
"""
SQL["stream_xml_archive"] = _XML_ODD_CTE + """
SELECT minute AS "window", CASE WHEN event_id % 11 = 0 THEN cut ELSE line END AS value FROM m
"""
SQL["stream_xml_dead_letters"] = _XML_ODD_CTE + """
SELECT minute AS "window", CASE WHEN event_id % 11 = 0 THEN cut ELSE line END AS value,
  CASE WHEN event_id % 11 = 0 THEN 'malformed message envelope'
       WHEN k = 2 THEN 'unexpected element (expected <Appointments>): <Appointment>'
       WHEN k = 3 THEN 'unexpected element (expected <Appointments>): <appointments>' ELSE 'malformed XML payload' END AS error,
  CASE WHEN event_id % 11 <> 0 THEN 'msg-' || eid END AS source
FROM m WHERE event_id % 11 = 0 OR k IN (2, 3, 7)
"""


def stream_raw_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A broker's rows streamed from files: bytes, repeated headers, text that is no UTF-8."""
    pin_utc(spark)
    root = scratch_path(spark, "stream-raw")
    raw = raw_messages(read(spark, sf_dir, "events")).withColumn("timestamp", _two_hours("timestamp").cast("timestamp"))
    raw.drop("event_id").write.parquet(f"{root}/in")
    for name in ("table", "errors"):
        _mkdir(spark, f"{root}/{name}")
    config = {"errorPath": f"{root}/errors", "BigQuerySinkDynamicStream": {
        "table": f"{root}/table", "loadTimeField": "", "pField": "", "customGcsTempLocation": f"{root}/checkpoint"}}
    start_message_stream(spark, "json", config, f"{root}/in", available_now=True, files_per_window=1, raw=True,
                         bind_options={"required_attributes": ("MessageId", "LogicalDate")}).awaitTermination()
    table = spark.read.parquet(f"{root}/table").select("MessageId", "Type", "TopicName", F.lit(None).cast("string").alias("value"), F.lit(None).cast("string").alias("error"))
    dead = spark.read.schema("value string, error string, source string").json(f"{root}/errors")
    none = F.lit(None).cast("string")
    return table.unionByName(dead.select(F.col("source").alias("MessageId"), none.alias("Type"), none.alias("TopicName"), "value", "error"))


SQL["stream_raw_messages"] = _JSON_CTE + f"""
, m AS (SELECT *, CASE k WHEN 1 THEN substring(body, 1, length(body) - 1) ELSE body END AS payload, event_id % 17 = 0 AS bytes FROM p)
SELECT CASE WHEN NOT bytes THEN 'msg-' || eid END AS "MessageId",
       CASE WHEN NOT bytes AND k IN (0, 6, 7, 8) THEN CASE k WHEN 6 THEN CAST(user_id AS VARCHAR) WHEN 8 THEN event_type || 'é' ELSE event_type END END AS "Type",
       CASE WHEN NOT bytes AND k IN (0, 6, 7, 8) AND event_id % 19 <> 0 THEN 'events' END AS "TopicName",
       CASE WHEN bytes THEN 'base64:' || to_base64(unhex('FF') || encode(payload)) WHEN k NOT IN (0, 6, 7, 8) THEN payload END AS value,
       CASE WHEN bytes THEN 'malformed message envelope' ELSE {JSON_ERROR} END AS error
FROM m
"""

SQL["csv_dead_letters"] = TABLE_SQL["csv_rejects"]
SQL["stream_json"] = f"SELECT *, TRUE AS several_batches FROM ({MESSAGE_SQL['json_bind']})"
SQL["stream_xml"] = f"SELECT *, TRUE AS several_batches FROM ({MESSAGE_SQL['xml_bind']})"

QUERIES = {
    "csv_batch_files": csv_batch_files,
    "csv_dead_letters": csv_dead_letters,
    "avro_batch_files": avro_batch_files,
    "sink_partitioned": sink_partitioned,
    "sink_truncate": sink_truncate,
    "sink_failures": sink_failures,
    "text_sink": text_sink,
    "stream_json": stream_json,
    "stream_xml": stream_xml,
    "stream_archive": stream_archive,
    "stream_dead_letters": stream_dead_letters,
    "stream_xml_archive": stream_xml_archive,
    "stream_xml_dead_letters": stream_xml_dead_letters,
    "stream_raw_messages": stream_raw_messages,
}
