"""Avro files of several schemas: written in tasks, read through Avro's own library."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from avro_fixture import decimal_bytes, write_avro as write_by_jvm
from sluice.operators.schema_merge import common_type, union_of
from sluice.plans.jobs import run
from sluice.sinks.avro_files import number, write_avro
from sluice.sources.avro import read_avro, schema_groups

I, L, Fl, D, S, B = T.IntegerType(), T.LongType(), T.FloatType(), T.DoubleType(), T.StringType(), T.BooleanType()


@pytest.mark.parametrize("a, b, want", [
    (I, L, L), (I, I, I), (T.NullType(), I, I), (L, Fl, D), (I, D, D), (Fl, D, D), (I, Fl, D), (S, I, S), (B, I, S), (T.BinaryType(), S, S),
    (T.DecimalType(10, 2), I, T.DecimalType(12, 2)), (T.DecimalType(10, 2), L, T.DecimalType(22, 2)),
    (T.DecimalType(10, 2), T.DecimalType(8, 6), T.DecimalType(14, 6)), (T.DecimalType(38, 0), T.DecimalType(10, 5), S), (T.DecimalType(10, 2), D, S),
    (T.ArrayType(I), T.ArrayType(L), T.ArrayType(L)), (T.MapType(S, I), T.MapType(S, D), T.MapType(S, D)), (T.ArrayType(I), I, S),
])
def test_common_types(a, b, want):
    assert common_type(a, b) == want
    assert common_type(b, a) == want


def test_union_of_unlike_frames(spark):
    one = spark.sql("select 1 a, named_struct('x', 1, 'y', 'p') r, array(1, 2) v, cast('q' as binary) b, 1 only")
    two = spark.sql("select 5000000000 a, named_struct('x', 2.5D, 'z', true) r, array(3L) v, 'text' b, map('k', 1) m")
    three = spark.sql("select 'x' a, cast(null as struct<x:int>) r, cast(null as array<int>) v, null b, named_struct('k', 2) m")
    got = {r["a"]: r for r in union_of([one, two, three]).collect()}
    assert set(got) == {"1", "5000000000", "x"}
    assert tuple(got["1"]["r"]) == (1.0, "p", None) and tuple(got["5000000000"]["r"]) == (2.5, None, True) and got["x"]["r"] is None
    assert got["1"]["v"] == [1, 2] and got["1"]["b"] == "q" and got["5000000000"]["b"] == "text" and got["x"]["v"] is None
    assert got["5000000000"]["m"] == '{"k":1}' and got["x"]["m"] == '{"k":2}' and got["1"]["m"] is None
    assert [got[k]["only"] for k in ("1", "x")] == [1, None]


def test_zigzag_numbers():
    assert [number(n) for n in (0, -1, 1, -64, 64, 2**63 - 1, -2**63)] == [
        b"\x00", b"\x01", b"\x02", b"\x7f", b"\x80\x01", b"\xfe" + b"\xff" * 8 + b"\x01", b"\xff" * 9 + b"\x01"]


SCHEMA = {"type": "record", "name": "R", "fields": [
    {"name": "Id", "type": "long"}, {"name": "Small", "type": "int"}, {"name": "Kind", "type": {"type": "enum", "name": "K", "symbols": ["a", "b"]}},
    {"name": "Price", "type": {"type": "bytes", "logicalType": "decimal", "precision": 20, "scale": 3}},
    {"name": "Ratio", "type": "float"}, {"name": "Score", "type": ["double", "null"]}, {"name": "Text", "type": ["null", "string"]},
    {"name": "Tags", "type": {"type": "array", "items": "string"}}, {"name": "Counts", "type": {"type": "map", "values": "long"}},
    {"name": "Flag", "type": "boolean"}, {"name": "Inner", "type": {"type": "record", "name": "I", "fields": [{"name": "x", "type": "int"}]}},
    {"name": "Day", "type": {"type": "int", "logicalType": "date"}},
]}
COLUMNS = ("Id long, Small int, Kind string, Price decimal(20,3), Ratio float, Score double, Text string, Tags array<string>, "
           "Counts map<string,long>, Flag boolean, Inner struct<x:int>, Day int, part string")


def row(k, part="p"):
    return (k * 10**15 - 5, -k, "ab"[k % 2], Decimal(k) * Decimal("-123456789.125"), k / 4, k / 3 if k % 3 else None, f"é\n{k}" if k % 4 else None,
            [str(x) for x in range(k % 3)], {"n": k} if k % 2 else {}, k % 2 == 0, (k,), 18000 + k, part)


@pytest.mark.parametrize("codec", ["null", "deflate"])
@pytest.mark.parametrize("block_rows", [1, 7, 4000])
def test_written_files_read_back_by_avros_library(spark, scratch, codec, block_rows):
    rows = [row(k, f"d{k % 3}") for k in range(50)]
    write_avro(spark.createDataFrame(rows, COLUMNS).repartition(4), f"{scratch}/in", SCHEMA, ["part"], codec, block_rows)
    got = {r["id"]: r for r in read_avro(spark, f"{scratch}/in/part=*/*.txt", r"part=(\w+)/", "p", row_text=True).collect()}
    assert len(got) == 50
    for r in rows:
        back = got[r[0]]
        assert [back[c] for c in ("small", "kind", "price", "ratio", "score", "text", "tags", "counts", "flag", "p")] == [*r[1:10], r[12]]
        assert back["inner"]["x"] == r[10][0]
        assert back["day"] == (dt.date(1970, 1, 1) + dt.timedelta(r[11])).isoformat()
    (schema, globs), = schema_groups(spark, f"{scratch}/in/part=*/*.txt")
    assert [f["name"] for f in schema["fields"]] == [f["name"] for f in SCHEMA["fields"]] and globs == [f"{scratch}/in/part=*/*.txt"]


def test_empty_frame_and_codecs(spark, scratch):
    write_avro(spark.createDataFrame([], COLUMNS), f"{scratch}/none", SCHEMA)
    assert not [f for f in os.listdir(f"{scratch}/none") if f.startswith("part") and os.path.getsize(f"{scratch}/none/{f}")]
    with pytest.raises(ValueError, match="codec"):
        write_avro(spark.createDataFrame([], COLUMNS), f"{scratch}/no", SCHEMA, codec="snappy")


def rec(fields):
    return {"type": "record", "name": "r", "fields": [{"name": n, "type": t, **more} for n, t, more in fields]}


def test_promotions_nullable_and_new_fields(spark, scratch):
    os.makedirs(f"{scratch}/in, [a] {{b}}")
    at = f"{scratch}/in, [a] {{b}}"
    write_by_jvm(spark, f"{at}/1.avro", rec([("a", "int", {}), ("n", "int", {}), ("p", {"type": "bytes", "logicalType": "decimal", "precision": 4, "scale": 1}, {})]),
                 [{"a": 1, "n": 7, "p": decimal_bytes(-15)}])
    write_by_jvm(spark, f"{at}/2.avro", rec([("a", ["null", "int"], {}), ("n", "long", {}), ("new", "string", {"default": "d"})]),
                 [{"a": {"int": 2}, "n": 2**40, "new": "x"}, {"a": None, "n": 1, "new": "y"}])
    write_by_jvm(spark, f"{at}/3.avro", rec([("a", "long", {}), ("n", "double", {}), ("p", {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 4}, {})]),
                 [{"a": 2**50, "n": 0.5, "p": decimal_bytes(123456789)}])
    glob = f"{scratch}/in?*/*.avro"
    got = read_avro(spark, glob, row_text=True)
    assert {f.name: f.dataType.simpleString() for f in got.schema.fields if len(f.name) < 4} == {"a": "bigint", "n": "double", "p": "decimal(12,4)", "new": "string"}
    rows = sorted((r["n"], r["a"], r["p"], r["new"]) for r in got.collect())
    assert rows == [(0.5, 2**50, Decimal("12345.6789"), None), (1.0, None, None, "y"), (7.0, 1, Decimal("-1.5000"), None), (float(2**40), 2, None, "x")]
    filled = {r["n"]: r["new"] for r in read_avro(spark, glob, row_text=True, fill_defaults=True).collect()}
    assert filled == {0.5: "d", 1.0: "y", 7.0: "d", float(2**40): "x"}
    sources = {r["bq_row_src"] for r in got.select("bq_row_src").collect()}
    assert len(sources) == 3 and all(s.endswith(".avro") for s in sources)


def job(root, table):
    return {"AvroSource": {"rowText": True, "path": f"{root}/in/*.avro"}, "errorPath": f"{root}/errors-{table}",
            "JsonStrategyTransform": {"jsonStrategy": [{"location": "/text", "operation": "LONG"}]},
            "BigQuerySinkDynamic": {"table": f"{root}/{table}", "loadTimeField": "", "pField": ""}}


def test_two_runs_give_equal_row_ids(spark, scratch):
    os.makedirs(f"{scratch}/in")
    for k in range(3):
        write_by_jvm(spark, f"{scratch}/in/{k}.avro", rec([("text", "string", {})]), [{"text": x} for x in ("1", "x", "3", "1")])
    ids = []
    for table in ("one", "two"):
        os.makedirs(f"{scratch}/{table}")
        run(spark, "avro_batch", job(scratch, table))
        ids.append(sorted((r["bq_row_src"], r["text"], r["bq_row_id"]) for r in spark.read.parquet(f"{scratch}/{table}").collect()))
        dead = spark.read.json(f"{scratch}/errors-{table}").select(F.get_json_object("value", "$.bq_row_id").alias("i")).collect()
        assert len(ids[-1]) == 9 and len({r["i"] for r in dead} | {i for _, _, i in ids[-1]}) == 12
    assert ids[0] == ids[1]


def test_csv_rows_keep_their_ids(spark, scratch):
    os.makedirs(f"{scratch}/in")
    for k in range(3):
        open(f"{scratch}/in/{k}.csv", "w").write("".join(f"{i},{k}\n" for i in range(40)))
    config = {"FileSource": {"location": {"path": f"{scratch}/in/*.csv", "extractDateRegex": ""}, "headerRegex": None, "trailerRegex": None, "splitter": ","},
              "CsvToTableRowTransform": {"headers": "a:LONG,b:LONG"}}
    from sluice.plans.jobs import csv_outputs

    one, two = ({(r["a"], r["b"]): r["bq_row_id"] for r in csv_outputs(spark, config).good.collect()} for _ in range(2))
    assert one == two and len(set(one.values())) == 120
    assert all(len(i) == 36 and i.count("-") == 4 for i in one.values())
