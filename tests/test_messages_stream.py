import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from sluice.operators.messages_json import bind_json_messages
from sluice.operators.messages_xml import archive_lines, bind_xml_messages
from sluice.operators.results import bad_rows, good_rows
from sluice.streaming.stream import process_batch, start_message_stream

ATTRS = {"TopicName": "appointments", "MessageId": "m-77", "LogicalDate": "2031-05-17"}
JSON_PAYLOAD = json.dumps({"Type": "VisitPlanned", "Data": [{
    "AppointmentId": "visit-0042-b", "TimestampUtc": "2031-03-04:05:06Z",
    "Disciplines": ["Dermatology", "Radiology"]}]})
XML_PAYLOAD = """<?xml version="1.0" encoding="utf-8"?>
<Appointments>
    <Type>VisitPlanned</Type>
    <Data>
        <AppointmentId>visit-0042-b</AppointmentId>
        <TimestampUtc>at-noon</TimestampUtc>
        <Discipline>dermatology</Discipline>
    </Data>
</Appointments>"""


def envelopes(spark, items):
    return spark.createDataFrame(
        [(p, a, t or dt.datetime(2031, 5, 17, 10, 0, 5)) for p, a, t in items],
        "payload string, attributes map<string,string>, publish_time timestamp",
    )


def test_reference_case_json(spark):
    out = good_rows(bind_json_messages(envelopes(spark, [(JSON_PAYLOAD, ATTRS, None)]))).first()
    assert out.Type == "VisitPlanned"
    assert out.Data[0].AppointmentId == "visit-0042-b"
    assert out.Data[0].Disciplines == ["Dermatology", "Radiology"]
    assert (out.TopicName, out.MessageId, out.LogicalDate) == ("appointments", "m-77", "2031-05-17")


def test_reference_case_xml_with_sent_id(spark):
    out = good_rows(bind_xml_messages(envelopes(spark, [(XML_PAYLOAD, ATTRS, None)]))).first()
    assert out.Type == "VisitPlanned"
    assert (out.TopicName, out.MessageId, out.LogicalDate) == ("appointments", "m-77", "2031-05-17")
    assert out.Data[0].Disciplines == ["dermatology"]


def test_json_edge_messages(spark):
    items = [
        ('{"Type":"VisitPlanned","Data":{"AppointmentId":"1"}', ATTRS),      # truncated + object for array
        ('{"Type":"X","Data":{"AppointmentId":"1"}}', ATTRS),                      # object where array expected
        ('{"Type":"X","Unknown":1}', ATTRS),                                        # unknown top-level field
        ('{"Type":"X","Data":[{"AppointmentId":"1","Room":2}]}', ATTRS),           # unknown nested field
        ('{"Type":{"a":1}}', ATTRS),                                                # object where text expected
        ('{"Type":5}', ATTRS),                                                      # number where text: accepted
        ('{"Type":"X","MessageId":"from-payload"}', ATTRS),                         # attribute wins
        ('{"Type":"Ärzte"}', ATTRS),                                                # non-ASCII
        ('{"Type":"X"}', {"TopicName": "t", "MessageId": "m"}),                    # missing attribute
    ]
    out = bind_json_messages(envelopes(spark, [(p, a, None) for p, a in items]))
    good = {r.Type: r.MessageId for r in good_rows(out).collect()}
    assert good == {"5": "m-77", "X": "m-77", "Ärzte": "m-77"}
    bad = {r.value: r.error for r in bad_rows(out).collect()}
    assert len(bad) == 6
    assert bad['{"Type":"X","Unknown":1}'] == 'Unrecognized field "Unknown"'
    assert bad['{"Type":"X"}'] == "missing attribute LogicalDate"


def test_xml_edge_messages(spark):
    body = "<Type>T</Type><Data><AppointmentId>1</AppointmentId></Data>"
    items = [
        f'<a:Appointments xmlns:a="urn:x"><a:Type>T</a:Type></a:Appointments>',   # namespaced: ok
        f"<Appointment>{body}</Appointment>",                                          # wrong root
        f"<appointments>{body}</appointments>",                                        # lower-case root
        f"<Appointments>{body}<Data><AppointmentId>2</AppointmentId></Data><Foo/></Appointments>",  # last Data wins
        f"<!-- c --><Appointments>{body}</Appointments>",                              # comment first
        f"<Appointments>{body}",                                                       # malformed
    ]
    out = bind_xml_messages(envelopes(spark, [(p, ATTRS, None) for p in items]))
    good = good_rows(out).collect()
    assert sorted((r.Data[0].AppointmentId if r.Data else "") for r in good) == ["", "1", "2"]
    bad = bad_rows(out).collect()
    assert len(bad) == 3
    assert all(b.value.endswith(",appointments,m-77,2031-05-17") for b in bad)


def test_archive_keeps_every_message_with_empty_slot(spark):
    df = envelopes(spark, [("p1", ATTRS, None), ("p2", {"TopicName": "t"}, dt.datetime(2031, 5, 17, 10, 1, 59))])
    got = sorted((r.window, r.value) for r in archive_lines(df).collect())
    assert got == [("2031-05-17T10:00", "p1,appointments,m-77,2031-05-17"),
                   ("2031-05-17T10:01", "p2,t,,")]


def batch_runs(table):
    """Run ids of the ``batch=<run>-<id>`` folders anywhere under a table."""
    runs = set()
    for _, dirs, _ in os.walk(table):
        runs |= {d.split("=", 1)[1].rsplit("-", 1)[0] for d in dirs if d.startswith("batch=")}
    return runs


def stream_config(root):
    os.makedirs(f"{root}/table", exist_ok=True)
    return {"errorPath": f"{root}/errors", "messages-bucket": f"{root}/archive",
            "BigQuerySinkDynamicStream": {"table": f"{root}/table", "loadTimeField": "bq_load_dttm", "pField": "LogicalDate",
                                          "customGcsTempLocation": f"{root}/checkpoint"}}


def write_envelopes(spark, df, path):
    df.coalesce(1).write.mode("append").json(path)


def test_stream_equals_batch_and_restarts_without_duplicates(spark, scratch):
    t0 = dt.datetime(2031, 5, 17, 10, 0, 5)
    first = [(JSON_PAYLOAD, ATTRS, t0), (JSON_PAYLOAD, dict(ATTRS, MessageId="m2"), t0 + dt.timedelta(minutes=1)),
             ('{"Type":', ATTRS, t0)]
    cfg = stream_config(scratch)
    write_envelopes(spark, envelopes(spark, first), f"{scratch}/in")
    start_message_stream(spark, "json", cfg, f"{scratch}/in", available_now=True).awaitTermination()
    table = spark.read.parquet(f"{scratch}/table")
    batch_good = good_rows(bind_json_messages(envelopes(spark, first)))
    assert sorted(r.MessageId for r in table.collect()) == sorted(r.MessageId for r in batch_good.collect())
    # Two minutes in one batch: two archive windows; the malformed message is dead-lettered.
    assert sorted(os.listdir(f"{scratch}/archive"))[:2] == ["window=2031-05-17T10%3A00", "window=2031-05-17T10%3A01"]
    assert spark.read.json(f"{scratch}/errors").count() == 1

    # A late message arrives in a later batch; restart from the same checkpoint:
    # the run id stored in the checkpoint keeps the batch folders apart.
    runs = batch_runs(f"{scratch}/table")
    assert len(runs) == 1
    late = [(JSON_PAYLOAD, dict(ATTRS, MessageId="late"), t0 - dt.timedelta(hours=1))]
    write_envelopes(spark, envelopes(spark, late), f"{scratch}/in")
    start_message_stream(spark, "json", cfg, f"{scratch}/in", available_now=True).awaitTermination()
    ids = sorted(r.MessageId for r in spark.read.parquet(f"{scratch}/table").collect())
    assert ids == ["late", "m-77", "m2"]
    assert batch_runs(f"{scratch}/table") == runs
    assert "window=2031-05-17T09%3A00" in os.listdir(f"{scratch}/archive")


def test_new_checkpoint_does_not_overwrite_earlier_batches(spark, scratch):
    cfg = stream_config(scratch)
    write_envelopes(spark, envelopes(spark, [(JSON_PAYLOAD, ATTRS, None)]), f"{scratch}/in")
    for ckpt in ("c1", "c2"):
        start_message_stream(spark, "json", cfg, f"{scratch}/in", available_now=True,
                             checkpoint=f"{scratch}/{ckpt}").awaitTermination()
    # Both runs started at batch 0, yet each kept its own output.
    assert spark.read.parquet(f"{scratch}/table").count() == 2


def test_replayed_batch_is_idempotent(spark, scratch):
    cfg = stream_config(scratch)
    batch = envelopes(spark, [(XML_PAYLOAD, ATTRS, None), ("<bad", ATTRS, None)])
    process_batch(batch, 7, "xml", cfg)
    process_batch(batch, 7, "xml", cfg)
    assert spark.read.parquet(f"{scratch}/table").count() == 1
    assert spark.read.json(f"{scratch}/errors").count() == 1
    # Payloads are archived verbatim, so the multi-line XML counts as several lines.
    assert spark.read.text(f"{scratch}/archive").count() == XML_PAYLOAD.count("\n") + 2


def test_topic_sink_round_trip_and_payload_decoding(spark, scratch):
    from sluice.sinks.table import write_topic
    from sluice.sources.messages import decode_payload, read_messages

    write_topic(spark.createDataFrame([("a",), ("b",)], "value string"), f"{scratch}/topic")
    assert sorted(r.payload for r in read_messages(spark, f"{scratch}/topic").collect()) == ["a", "b"]
    raw = spark.createDataFrame([(bytearray(b"ok"),), (bytearray(b"\xff\xfe"),)], "b binary")
    assert [r[0] for r in raw.select(decode_payload(F.col("b"))).collect()] == ["ok", None]


def test_run_dispatches_streams(spark, scratch):
    from sluice.plans.jobs import run

    cfg = stream_config(scratch)
    write_envelopes(spark, envelopes(spark, [(XML_PAYLOAD, ATTRS, None)]), f"{scratch}/in")
    run(spark, "xml_stream", cfg, subscription=f"{scratch}/in", available_now=True).awaitTermination()
    assert spark.read.parquet(f"{scratch}/table").first().MessageId == "m-77"


def test_files_per_window_bounds_archive_files(spark, scratch):
    cfg = stream_config(scratch)
    t0 = dt.datetime(2031, 5, 17, 10, 0, 5)
    items = [(JSON_PAYLOAD, dict(ATTRS, MessageId=f"m{i}"), t0 + dt.timedelta(seconds=7 * i)) for i in range(40)]
    batch = envelopes(spark, items).repartition(4)
    process_batch(batch, 0, "json", cfg, files_per_window=1)
    for window in os.listdir(f"{scratch}/archive"):
        files = [f for f in os.listdir(f"{scratch}/archive/{window}/batch=0") if f.endswith(".txt")]
        assert len(files) == 1
    assert spark.read.text(f"{scratch}/archive").count() == 40


def test_a_large_window_is_dealt_to_several_writers(spark, scratch):
    cfg = stream_config(scratch)
    batch = spark.range(0, 20_000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 512).alias("payload"), F.lit(None).cast("map<string,string>").alias("attributes"),
        F.lit(None).cast("timestamp").alias("publish_time"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256KB")
    try:
        process_batch(batch, 0, "json", cfg, files_per_window=1)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    for out in ("archive", "errors"):
        folder = f"{scratch}/{out}/window=unknown/batch=0"
        sizes = [os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.startswith("part-")]
        assert len(sizes) > 1 and max(sizes) < sum(sizes) / 2
        assert spark.read.text(folder).distinct().count() == 20_000


@pytest.mark.parametrize("kind", ["json", "xml"])
def test_files_of_a_streams_messages_grow_in_number(spark, scratch, monkeypatch, kind):
    from sluice.plans import job_queries

    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 61)
    (spark.range(4000).select(F.col("id").alias("event_id"), at.alias("ts"), F.lit(7).cast("bigint").alias("user_id"),
                              F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 5}').alias("props"))
     .coalesce(1).write.parquet(f"{scratch}/events.parquet"))
    monkeypatch.setattr(job_queries, "FILE_EVENTS", 500)
    root, several = job_queries._run_stream(spark, scratch, kind, odd=True)
    files = [f for f in os.listdir(f"{root}/in") if f.startswith("part-")]
    lines = [sum(1 for _ in open(f"{root}/in/{f}")) for f in files]
    assert len(files) == 8 * job_queries.BATCHES and max(lines) <= 500 and sum(lines) == 4000
    assert several and sorted(n for n in os.listdir(f"{root}/checkpoint/commits") if n.isdigit()) == list("0123")
    assert job_queries._archive(spark, root).distinct().count() == 4000


def test_xml_text_keeps_surrounding_blanks(spark):
    payload = "<Appointments><Type>  x y  </Type><Data><AppointmentId> 1 </AppointmentId></Data></Appointments>"
    out = good_rows(bind_xml_messages(envelopes(spark, [(payload, ATTRS, None)]))).first()
    assert out.Type == "  x y  " and out.Data[0].AppointmentId == " 1 "


def test_xml_parse_partitions_spreads_the_parse(spark):
    items = [(XML_PAYLOAD, dict(ATTRS, MessageId=f"m{i}"), None) for i in range(50)]
    out = bind_xml_messages(envelopes(spark, items).coalesce(1), parse_partitions=5)
    assert out.rdd.getNumPartitions() == 5 and good_rows(out).count() == 50


def test_kafka_rows_become_envelopes(spark):
    from sluice.sources.messages import kafka_envelopes

    rows = [(bytearray(JSON_PAYLOAD.encode()), [("MessageId", bytearray(b"a")), ("TopicName", bytearray(b"t")),
                                                ("MessageId", bytearray(b"b")), ("LogicalDate", bytearray(b"d"))],
             dt.datetime(2031, 5, 17, 10, 0)),
            (bytearray(b"\xff"), None, dt.datetime(2031, 5, 17, 10, 0))]
    df = spark.createDataFrame(rows, "value binary, headers array<struct<key:string,value:binary>>, timestamp timestamp")
    env = kafka_envelopes(df).collect()
    assert env[0].attributes == {"MessageId": "b", "TopicName": "t", "LogicalDate": "d"}
    assert env[0].payload == JSON_PAYLOAD and env[1].payload is None and env[1].attributes == {}
    bound = bind_json_messages(kafka_envelopes(df))
    assert good_rows(bound).count() == 1 and bad_rows(bound).count() == 1


def test_numbers_bound_to_text_read_as_doubles(spark):
    payload = ('{"Type": 1.50, "Data": [{"AppointmentId": 12345678.9, "TimestampUtc": 0.00001, '
               '"Disciplines": [5, 1e2, 123456789012345678901234567890]}]}')
    out = good_rows(bind_json_messages(envelopes(spark, [(payload, ATTRS, None)]))).first()
    assert out.Type == "1.5"
    d = out.Data[0]
    assert (d.AppointmentId, d.TimestampUtc) == ("1.23456789E7", "1.0E-5")
    assert d.Disciplines == ["5", "100.0", "123456789012345678901234567890"]


def test_xml_bom_and_doctype(spark):
    items = ["﻿<Appointments><Type>bom</Type></Appointments>",
             '<!DOCTYPE Appointments [<!ENTITY x SYSTEM "file:///etc/hostname">]><Appointments><Type>&x;</Type></Appointments>']
    out = bind_xml_messages(envelopes(spark, [(p, ATTRS, None) for p in items]))
    assert [r.Type for r in good_rows(out).collect()] == ["bom"]
    assert [r.error for r in bad_rows(out).collect()] == ["malformed XML payload"]


def test_table_files_bounds_table_writers(spark, scratch):
    cfg = stream_config(scratch)
    cfg["BigQuerySinkDynamicStream"]["pField"] = ""
    items = [(JSON_PAYLOAD, dict(ATTRS, MessageId=f"m{i}"), None) for i in range(60)]
    process_batch(envelopes(spark, items).repartition(6), 0, "json", cfg, table_files=2)
    files = [f for f in os.listdir(f"{scratch}/table/batch=0") if f.endswith(".parquet")]
    assert len(files) <= 2 and spark.read.parquet(f"{scratch}/table").count() == 60
