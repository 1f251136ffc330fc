"""Inputs that must neither be lost nor stop a job, and the sink's contract."""

import base64
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from sluice.functions.spec import parse_field_spec
from sluice.operators.delimited import ARITY_ERROR, parse_delimited
from sluice.operators.messages_json import bind_json_messages
from sluice.operators.messages_xml import bind_xml_messages
from sluice.operators.results import bad_rows, good_rows
from sluice.session import ensure_checkpoint_dir
from sluice.sinks.table import write_table
from sluice.sources.files import read_lines
from sluice.sources.messages import kafka_envelopes, read_messages
from sluice.streaming.stream import process_batch

ATTRS = {"TopicName": "t", "MessageId": "m", "LogicalDate": "2031-01-01"}
ENVELOPE = "payload string, attributes map<string,string>, publish_time timestamp"


def folders(scratch):
    for name in ("table", "errors", "archive"):
        os.makedirs(f"{scratch}/{name}")
    return {"errorPath": f"{scratch}/errors", "messages-bucket": f"{scratch}/archive",
            "BigQuerySinkDynamicStream": {"table": f"{scratch}/table", "pField": "", "loadTimeField": ""}}


def test_no_message_is_lost(spark, scratch):
    os.makedirs(f"{scratch}/in")
    good = {"payload": json.dumps({"Type": "x"}), "attributes": ATTRS}
    lines = [json.dumps(good | {"publish_time": "2031-01-01T10:00:30Z"}), json.dumps(good),
             json.dumps(good | {"payload": "{"}), "{broken", json.dumps(good | {"publish_time": "no time"}), "[1,2]"]
    open(f"{scratch}/in/a.json", "w").write("\n".join(lines))
    batch = read_messages(spark, f"{scratch}/in")
    process_batch(batch, 0, "json", folders(scratch))
    archive = spark.read.schema("value string, window string, batch string").text(f"{scratch}/archive").collect()
    assert len(archive) == len(lines)
    assert sorted(r["window"] for r in archive) == ["2031-01-01T10:00"] + ["unknown"] * 5
    assert {lines[3], lines[4], lines[5]} <= {r["value"] for r in archive}
    assert spark.read.parquet(f"{scratch}/table").count() == 2
    dead = spark.read.schema("value string, error string").json(f"{scratch}/errors").collect()
    assert sorted((r["value"], r["error"]) for r in dead) == sorted(
        [("{", "malformed JSON payload")] + [(x, "malformed message envelope") for x in (lines[3], lines[4], lines[5])])


def test_undecodable_bytes_are_kept(spark, scratch):
    raw = b"\xff\xfe{}"
    rows = spark.createDataFrame([(bytearray(raw), None, dt.datetime(2031, 1, 1))],
                                 "value binary, headers array<struct<key:string,value:binary>>, timestamp timestamp")
    process_batch(kafka_envelopes(rows), 0, "json", folders(scratch))
    want = "base64:" + base64.b64encode(raw).decode()
    assert [r["value"] for r in spark.read.text(f"{scratch}/archive").collect()] == [want]
    assert [r["value"] for r in spark.read.json(f"{scratch}/errors").collect()] == [want]


def envelopes(spark, payloads):
    return spark.createDataFrame([(p, ATTRS, None) for p in payloads], ENVELOPE)


def test_xml_poison(spark):
    body = "<Appointments><Type>x</Type></Appointments>"
    deep = "<a>" * 3000 + "</a>" * 3000
    payloads = ["<!-- c -->" * 100_000 + body, "<?p x?>\n" * 50_000 + body, body + "<!-- c -->" * 1000, "<" * 100_000, deep, "<!--" * 50_000, " " * 200_000 + body]
    out = bind_xml_messages(envelopes(spark, payloads))
    assert good_rows(out).count() >= 3 and good_rows(out).count() + bad_rows(out).count() == len(payloads)


def test_json_poison(spark):
    payloads = ["[" * 5000 + "]" * 5000, '{"Type":' * 3000 + "1" + "}" * 3000, '{"Type":"' + "x" * 2_000_000 + '"}', '{"Type":"a"' + ',"Type":"b"' * 5000 + "}"]
    out = bind_json_messages(envelopes(spark, payloads))
    got = {len(r["Type"]): r["Type"][:1] for r in good_rows(out).collect()}
    assert got == {2_000_000: "x", 1: "b"} and bad_rows(out).count() == 2


def test_csv_poison(spark):
    lines = ["," * 25_000, "," * 600, "," * 100_000, '"' * 50_001, "x" * 3_000_000 + ",b", '"' + "," * 30_000 + '",b']
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    out = parse_delimited(df, "a:STRING,b:STRING")
    bad = bad_rows(out).collect()
    assert {r["error"] for r in bad} == {ARITY_ERROR} and len(bad) + good_rows(out).count() == len(lines)
    assert {len(r["a"]) for r in good_rows(out).collect()} >= {3_000_000, 30_000}


def test_repeated_keys_are_bound_strictly(spark):
    payloads = ['{"Type":"a","Type":"b","Data":[{"Bogus":1}]}', '{"Type":"a","Type":{"o":1}}', '{"Type":"a","Type":"b"}']
    out = bind_json_messages(envelopes(spark, payloads))
    assert [r["Type"] for r in good_rows(out).collect()] == ["b"]


def days(spark, *rows):
    return spark.createDataFrame(rows, "day string, v long")


def test_truncate_replaces_only_its_days(spark, scratch):
    path = f"{scratch}/t"
    os.makedirs(path)
    write_table(days(spark, ("2031-01-01", 1), ("2031-01-02", 2)), path, partition_field="day")
    write_table(days(spark, ("2031-01-02", 3)), path, disposition="WRITE_TRUNCATE", partition_field="day")
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 3]
    write_table(days(spark, ("2031-01-03", 4)), f"{path}-plain", create=True)
    write_table(days(spark, ("2031-01-04", 5)), f"{path}-plain", disposition="WRITE_TRUNCATE")
    assert [r["v"] for r in spark.read.parquet(f"{path}-plain").collect()] == [5]


def test_catalog_tables_route_days_and_refuse_what_they_lack(spark, scratch):
    name = "t_" + os.path.basename(scratch)
    spark.sql(f"CREATE TABLE {name} (v BIGINT, day STRING, day_day STRING, ingest_run STRING) USING parquet "
              f"PARTITIONED BY (day_day, ingest_run) LOCATION '{scratch}/catalog'")
    try:
        for _ in range(2):
            write_table(days(spark, ("2031-01-01", 1), ("2031-01-02", 2)), name, partition_field="day", run_id="r1")
        write_table(days(spark, ("2031-01-02", 3)), name, partition_field="day", run_id="r2")
        got = sorted((r["v"], r["day_day"], r["ingest_run"]) for r in spark.table(name).collect())
        assert got == [(1, "20310101", "r1"), (2, "20310102", "r1"), (3, "20310102", "r2")]
        with pytest.raises(ValueError, match="no column x"):
            write_table(days(spark, ("2031-01-01", 1)).withColumn("x", F.lit(1)), name, partition_field="day", run_id="r3")
    finally:
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE TABLE {name} (day STRING, v BIGINT) USING parquet LOCATION '{scratch}/flat'")
    try:
        with pytest.raises(ValueError, match="no column day_day"):
            write_table(days(spark, ("2031-01-01", 1)), name, partition_field="day")
        write_table(days(spark, ("2031-01-01", 1)), name)
        with pytest.raises(ValueError, match="not empty"):
            write_table(days(spark, ("2031-01-01", 1)), name, disposition="WRITE_EMPTY")
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_stream_into_a_catalog_table(spark, scratch):
    name = "s_" + os.path.basename(scratch)
    config = folders(scratch)
    config["BigQuerySinkDynamicStream"]["table"] = name
    detail = "ARRAY<STRUCT<AppointmentId: STRING, TimestampUtc: STRING, Disciplines: ARRAY<STRING>>>"
    spark.sql(f"CREATE TABLE {name} (Type STRING, Data {detail}, TopicName STRING, MessageId STRING, LogicalDate STRING, batch STRING) "
              f"USING parquet PARTITIONED BY (batch) LOCATION '{scratch}/stream'")
    try:
        for batch_id in (0, 0, 1):
            process_batch(envelopes(spark, ['{"Type":"x"}']), batch_id, "json", config)
        assert spark.table(name).count() == 2
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_paths_read_as_they_are_named(spark, scratch):
    os.makedirs(f"{scratch}/my dir")
    open(f"{scratch}/my dir/f 20310101 50%+é.csv", "w").write("a\n")
    path = read_lines(spark, f"{scratch}/my dir/*.csv").first()["path"]
    assert path.endswith("/my dir/f 20310101 50%+é.csv")


@pytest.mark.parametrize("text,parts", [
    ("a:DATE(HH:mm)", ("a", "DATE(HH:mm)")), ("a:  STRING", ("a", "STRING")), ("a:TIME(HH:mm:ss)", ("a", "TIME(HH:mm:ss)")),
    ("a", None), ("a:b:c", None), ("a:", None), ("a:x)y:z", ("a:x)y", "z")), ("a::", None)])
def test_field_spec_separator(text, parts):
    spec = parse_field_spec(text)
    assert (spec.name, spec.op) == parts if parts else spec.problem


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_wide_numbers_and_nanoseconds(spark):
    specs = ("a:BIGDECIMAL,b:PRECISION(-1),c:PRECISION(45),d:int2bigDecimal,e:TIME(HH:mm:ss.SSSSSSSSS),f:BIGINT")
    rows = {
        "0.123456789012345678,4.9999999999999999999,1,1E-100001,03:04:05.000000001,1": None,
        "0.1234567890123456789,,,,,": "a", "1E-20,,,,,": "a", "1E-18,,,,,": None, "1.50000000000000000000000,,,,,": None,
        "100000000000000000000,,,,,": "a", ",,,,," + "9" * 39: "f", ",,,1E999999999,,": "d", ",,,1E99999999999999,,": "d"}
    out = parse_delimited(spark.createDataFrame([(x,) for x in rows], "line string"), specs)
    got = {(r["_raw"]): r for r in out.collect()}
    for line, field in rows.items():
        error = got[line]["_error"]
        assert (error is None) if field is None else error.startswith(f"failed at field: {field},"), (line, error)
    first = got[next(iter(rows))]
    assert (first["b"], first["c"], first["e"]) == ("0", "1." + "0" * 45, "03:04:05.000000001")
    assert len(first["d"]) == 100003 and first["d"].endswith("01")
