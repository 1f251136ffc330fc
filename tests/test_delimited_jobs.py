import gzip
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from sluice.operators.delimited import ARITY_ERROR, drop_header_trailer, parse_delimited
from sluice.operators.results import bad_rows, good_rows
from sluice.plans.jobs import csv_batch, run

APPOINTMENT_LINE = "VisitPlanned,visit-0042-b,2031-03-04:05:06Z,dermatology"
PLAIN_HEADERS = "Type:STRING,AppointmentId:STRING,TimestampUTC:STRING,Discipline:STRING"


def lines_df(spark, lines, path="/in/f.csv"):
    return spark.createDataFrame([(line, path) for line in lines], "line string, path string")


def test_edge_lines(spark):
    lines = ["A,1,x", "A,1", "A,1,x,extra", "", '"a,b",2,"He said ""hi"""', " padded , 3 ,z", "#c,4,w", "A,q,x"]
    out = parse_delimited(lines_df(spark, lines), "a:STRING,b:INTEGER,c:STRING", src_col="path")
    got = {r._raw: (r.a, r.b, r.c, r._error) for r in out.collect()}
    assert got["A,1,x"] == ("A", 1, "x", None)
    assert got["A,1"][3] == ARITY_ERROR and got["A,1,x,extra"][3] == ARITY_ERROR
    assert got[""][3] == ARITY_ERROR                       # a blank line has no cells
    assert got['a,b,2,He said "hi"'][:3] == ("a,b", 2, 'He said "hi"')
    assert got["padded,3,z"][:3] == ("padded", 3, "z")   # unquoted cells are trimmed
    assert got["#c,4,w"][:3] == ("#c", 4, "w")           # '#' is data, not a comment
    assert got["A,q,x"][3] == 'failed at field: b, trace:For input string: "q"'


def test_header_trailer_full_match_only(spark):
    df = lines_df(spark, ["Type,a", "xType,a", "Tr,1", "Trailer", "data", ""])
    kept = [r.line for r in drop_header_trailer(df, "^Type.*", "^Tr.*").collect()]
    assert kept == ["xType,a", "data", ""]
    # Empty regexes fully match only the blank line.
    kept = [r.line for r in drop_header_trailer(df, "", "").collect()]
    assert kept == ["Type,a", "xType,a", "Tr,1", "Trailer", "data"]


def test_file_date_is_the_last_cell(spark):
    df = lines_df(spark, ["A,1", "A,1,2"]).withColumn("d", F.lit("20310517"))
    out = parse_delimited(df, "a:STRING,b:LONG,Day:DATE(yyyyMMdd)", date_col="d")
    got = {r._raw: (r.Day, r._error) for r in out.collect()}
    assert got["A,1,20310517"] == ("2031-05-17", None)
    assert got["A,1,2,20310517"][1] == ARITY_ERROR


def write(path, text, gz=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        with open(path, "w") as f:
            f.write(text)


def csv_config(scratch, path, headers=PLAIN_HEADERS, regex="", header="", trailer="", pfield=""):
    os.makedirs(f"{scratch}/table", exist_ok=True)
    return {
        "FileSource": {"location": {"path": path, "extractDateRegex": regex},
                       "headerRegex": header, "trailerRegex": trailer, "splitter": ","},
        "CsvToTableRowTransform": {"headers": headers},
        "BigQuerySinkDynamic": {"table": f"{scratch}/table", "loadTimeField": "bq_load_dttm", "pField": pfield},
        "errorPath": f"{scratch}/errors",
    }


def test_reference_case_plain_csv(spark, scratch):
    write(f"{scratch}/in/appointments.csv", APPOINTMENT_LINE)
    out = csv_batch(spark, csv_config(scratch, f"{scratch}/in/appointments.csv"))
    table = spark.read.parquet(f"{scratch}/table")
    assert table.count() == 1
    r = table.first()
    assert (r.Type, r.AppointmentId, r.TimestampUTC, r.Discipline) == tuple(APPOINTMENT_LINE.split(","))
    assert r.bq_row_id and "appointments.csv" in r.bq_row_src and r.bq_load_dttm is not None
    assert len([c for c in table.columns if c != "bq_load_dttm"]) == 6
    assert out.bad.count() == 0


def test_reference_case_header_trailer_dated_path(spark, scratch):
    path = f"{scratch}/in/20310517/appointments_20310517.csv"
    write(path, "Type,AppointmentId,TimestampUTC,Discipline\n" + APPOINTMENT_LINE + "\nTr,1")
    headers = PLAIN_HEADERS + ",Transactional_Date:DATE(yyyyMMdd)"
    csv_batch(spark, csv_config(scratch, path, headers, r"(\d{8})", "^Type.*", "^Tr.*", pfield="Transactional_Date"))
    table = spark.read.parquet(f"{scratch}/table")
    assert table.count() == 1
    r = table.first()
    assert r.Transactional_Date == "2031-05-17"
    assert os.path.isdir(f"{scratch}/table/Transactional_Date_day=20310517")


def test_gzip_input_and_dead_letters(spark, scratch):
    write(f"{scratch}/in/a.csv.gz", APPOINTMENT_LINE + "\nonly,two\n", gz=True)
    csv_batch(spark, csv_config(scratch, f"{scratch}/in/*.gz"))
    assert spark.read.parquet(f"{scratch}/table").count() == 1
    dead = spark.read.json(f"{scratch}/errors").collect()
    assert [(d.value, d.error) for d in dead] == [("only,two", ARITY_ERROR)]


def test_path_without_date_fails_or_dead_letters(spark, scratch):
    write(f"{scratch}/in/nodate.csv", APPOINTMENT_LINE)
    headers = PLAIN_HEADERS + ",D:DATE(yyyyMMdd)"
    cfg = csv_config(scratch, f"{scratch}/in/nodate.csv", headers, r"(\d{8})")
    with pytest.raises(Exception):
        csv_batch(spark, cfg)
    from sluice.plans.jobs import csv_outputs

    out = csv_outputs(spark, cfg, on_no_date="dead_letter")
    assert out.good.count() == 0
    (bad,) = out.bad.collect()
    assert bad.error.startswith("no date in path: ") and bad.error.endswith("nodate.csv")


def test_runtime_path_wins_and_unknown_mode(spark, scratch):
    write(f"{scratch}/in/x.csv", APPOINTMENT_LINE)
    run(spark, "csv_batch", csv_config(scratch, "/does/not/exist"), file_path=f"{scratch}/in/x.csv")
    assert spark.read.parquet(f"{scratch}/table").count() == 1
    with pytest.raises(ValueError):
        run(spark, "parquet_batch", {})


def test_sink_never_creates_and_write_empty(spark, scratch):
    from sluice.sinks.table import write_table

    df = spark.createDataFrame([(1, "2020-01-02")], "k long, d string")
    with pytest.raises(FileNotFoundError):
        write_table(df, f"{scratch}/missing")
    os.makedirs(f"{scratch}/t")
    write_table(df, f"{scratch}/t", disposition="WRITE_EMPTY", partition_field="d")
    with pytest.raises(ValueError):
        write_table(df, f"{scratch}/t", disposition="WRITE_EMPTY", partition_field="d")
    write_table(df, f"{scratch}/t", disposition="WRITE_TRUNCATE", partition_field="d")
    assert rows(spark.read.parquet(f"{scratch}/t"), "k", "d", "d_day") == [(1, "2020-01-02", 20200102)]


def test_null_partition_value_goes_to_default_partition(spark, scratch):
    from sluice.sinks.table import write_table

    os.makedirs(f"{scratch}/t")
    df = spark.createDataFrame([(1, None)], "k long, d string")
    write_table(df, f"{scratch}/t", partition_field="d")
    assert any("__HIVE_DEFAULT_PARTITION__" in p for p in os.listdir(f"{scratch}/t"))


def test_good_bad_split_counts(spark):
    df = lines_df(spark, ["a,1", "b,x", "c"])
    parsed = parse_delimited(df, "n:STRING,v:INTEGER")
    assert good_rows(parsed).count() == 1 and bad_rows(parsed).count() == 2


def test_single_scan_gives_the_same_outputs(spark, scratch):
    write(f"{scratch}/in/a.csv", APPOINTMENT_LINE + "\nonly,two\n")
    csv_batch(spark, csv_config(scratch, f"{scratch}/in/a.csv"), single_scan=True)
    assert spark.read.parquet(f"{scratch}/table").count() == 1
    assert spark.read.json(f"{scratch}/errors").count() == 1


def test_rerun_with_run_id_does_not_duplicate(spark, scratch):
    write(f"{scratch}/in/a.csv", APPOINTMENT_LINE + "\nonly,two\n")
    cfg = csv_config(scratch, f"{scratch}/in/a.csv")
    for _ in range(2):
        csv_batch(spark, cfg, run_id="load-20310517")
    csv_batch(spark, cfg, run_id="load-20320101")
    table = spark.read.parquet(f"{scratch}/table")
    assert sorted(r.ingest_run for r in table.collect()) == ["load-20310517", "load-20320101"]
    assert spark.read.json(f"{scratch}/errors").count() == 2
    with pytest.raises(ValueError):
        csv_batch(spark, cfg, disposition="WRITE_TRUNCATE", run_id="x")


def test_spread_splits_a_hot_key_of_identical_rows(spark):
    from sluice.sinks.table import spread

    hot = spark.range(30000).select(F.lit("2031-05-17").alias("day"), F.lit("same").alias("v"))
    cold = spark.range(60000).select(F.date_format(F.date_add(F.lit("2019-01-01"), (F.col("id") % 50).cast("int")),
                                                   "yyyy-MM-dd").alias("day"), F.lit("x").alias("v"))
    # At this size AQE would merge all shuffle partitions into one; at scale the
    # salted pieces of a hot key are large and stay apart.
    # Likewise a cluster uses many shuffle partitions, so salted pieces rarely collide.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        spread_df = spread(hot.union(cold), "day", 4)
        per_task = (spread_df.filter("day = '2031-05-17'").groupBy(F.spark_partition_id().alias("p")).count()
                    .collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(per_task) >= 3 and max(r["count"] for r in per_task) <= 30000 // 2
