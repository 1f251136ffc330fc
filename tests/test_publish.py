"""Writes that appear as a whole: replaced tables, both outputs of a job, compacted streams."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.operators.results import ROW_ID_COL
from sluice.plans.jobs import csv_batch, csv_outputs
from sluice.sinks.publish import Files, Publication, recover
from sluice.sinks.routed import routed_rows
from sluice.sinks.table import write_table
from sluice.streaming.compaction import compact, compacted_upto, split_batch_id
from sluice.streaming.stream import process_batch

ATTRS = {"TopicName": "t", "MessageId": "m", "LogicalDate": "2031-01-01"}


def data_files(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names
                  if f.startswith("part-") and not any(x.startswith("_") and "=" not in x for x in os.path.relpath(d, root).split("/")))


def hidden(root):
    return [n for n in os.listdir(root) if n.startswith(("_stage", "_publish", "._stage", "._publish"))]


def days(spark, n, load, bad=None):
    """``n`` rows over four days, every second on the first; row ``bad`` stops the job."""
    i = F.col("id")
    value = F.when(i == bad, F.raise_error(F.lit("poison")).cast("string")).otherwise(F.lit(load)) if bad is not None else F.lit(load)
    day = F.when(i % 2 == 0, "2031-01-01").otherwise(F.concat(F.lit("2031-01-0"), (i % 3 + 2).cast("string")))
    return spark.range(n, numPartitions=4).select("id", day.alias("day"), value.alias("load"))


def loads(spark, root):
    return {(r["day"], r["load"]): r["n"] for r in spark.read.schema("id long, day string, load string").parquet(root)
            .groupBy("day", "load").agg(F.count("*").alias("n")).collect()}


@pytest.mark.parametrize("field", ["", "day"])
def test_failed_truncate_leaves_the_old_rows(spark, scratch, field):
    write_table(days(spark, 100, "one"), scratch, partition_field=field)
    before, files = loads(spark, scratch), data_files(scratch)
    with pytest.raises(Exception, match="poison"):
        write_table(days(spark, 100, "two", bad=99), scratch, "WRITE_TRUNCATE", partition_field=field)
    assert loads(spark, scratch) == before and data_files(scratch) == files and not hidden(scratch)
    write_table(days(spark, 40, "two").where("day > '2031-01-01'"), scratch, "WRITE_TRUNCATE", partition_field=field)
    after = loads(spark, scratch)
    assert ("2031-01-02", "one") not in after and after["2031-01-02", "two"] > 0
    assert (("2031-01-01", "one") in after) == bool(field)


def test_publication_that_dies_is_finished_by_the_next_writer(spark, scratch, monkeypatch):
    write_table(days(spark, 100, "one"), scratch, partition_field="day")
    move, calls = Files.move, []

    def dies(self, source, target):
        calls.append(source)
        if len(calls) > 2:
            raise KeyboardInterrupt
        move(self, source, target)

    monkeypatch.setattr(Files, "move", dies)
    with pytest.raises(KeyboardInterrupt):
        write_table(days(spark, 100, "two"), scratch, "WRITE_TRUNCATE", partition_field="day")
    monkeypatch.undo()
    assert hidden(scratch)
    write_table(days(spark, 10, "three"), scratch, partition_field="day")
    got = loads(spark, scratch)
    assert {load for _, load in got} == {"two", "three"} and sum(n for (_, load), n in got.items() if load == "two") == 100
    assert not hidden(scratch) and recover(spark, scratch) == 0


def test_two_writers_may_finish_the_same_manifest(spark, scratch, monkeypatch):
    from concurrent.futures import ThreadPoolExecutor

    from sluice.sinks import publish

    done = publish.carry_out
    monkeypatch.setattr(publish, "carry_out", lambda *a: None)  # dies right after the manifest
    write_table(days(spark, 200, "one"), scratch, partition_field="day")
    monkeypatch.undo()
    assert hidden(scratch) and loads(spark, scratch) == {}
    name, = (n for n in os.listdir(scratch) if n.startswith("_publish"))
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda _: done(spark, scratch, f"{scratch}/{name}"), range(2)))
    done(spark, scratch, f"{scratch}/{name}")
    assert sum(loads(spark, scratch).values()) == 200 and not hidden(scratch)


def test_file_taken_away_between_look_and_move(spark, scratch):
    from sluice.sinks.publish import Files

    class Late(Files):
        """Sees the source once after another writer has moved it."""

        late = True

        def exists(self, path):
            if path.endswith("gone") and self.late:
                self.late = False
                return True
            return super().exists(path)

    os.makedirs(f"{scratch}/there")
    Late(spark, scratch).move(f"{scratch}/gone", f"{scratch}/there")
    with pytest.raises(OSError):
        Late(spark, scratch).move(f"{scratch}/gone", f"{scratch}/nowhere")
    with pytest.raises(OSError):
        Late(spark, scratch).move_folder(f"{scratch}/gone", f"{scratch}/nowhere")


def test_stage_that_dies_before_its_manifest_changes_nothing(spark, scratch):
    write_table(days(spark, 20, "one"), scratch)
    change = Publication(spark, scratch)
    days(spark, 5, "two").write.parquet(change.stage(scratch))
    assert recover(spark, scratch) == 0 and {load for _, load in loads(spark, scratch)} == {"one"}
    change.discard()
    assert not hidden(scratch)


def test_days_get_writers_by_their_size(spark, scratch):
    key, before = "spark.sql.adaptive.advisoryPartitionSizeInBytes", spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set(key, "200k")
    try:
        rows = days(spark, 60000, "x").withColumn("load", F.sha2(F.col("id").cast("string"), 256))
        write_table(rows, scratch, partition_field="day")
    finally:
        spark.conf.set(key, before)
    files = [f.split("/")[0] for f in data_files(scratch)]
    assert files.count("day_day=20310101") >= 4
    small = spark.range(100).select("id", F.concat(F.lit("2032-01-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")).alias("day"), F.lit("y").alias("load"))
    write_table(small.repartition(8), scratch, partition_field="day")
    assert len([f for f in data_files(scratch) if f.startswith("day_day=2032")]) == 28


def csv_config(root, day=False):
    return {"FileSource": {"location": {"path": f"{root}/in/*.csv", "extractDateRegex": ""}, "headerRegex": None, "trailerRegex": None, "splitter": ","},
            "CsvToTableRowTransform": {"headers": "a:LONG,d:DATE(yyyyMMdd),t:STRING"},
            "BigQuerySinkDynamic": {"table": f"{root}/table", "loadTimeField": "at", "pField": "d" if day else ""}, "errorPath": f"{root}/errors"}


def write_csv(root, bad=5):
    for name in ("in", "table"):
        os.makedirs(f"{root}/{name}", exist_ok=True)
    with open(f"{root}/in/a.csv", "w") as f:
        f.writelines(f"{'x' if i % bad == 0 else i},2031010{1 + i % 3},t{i}\n" for i in range(60))


def test_one_scan_and_nothing_kept(spark, scratch):
    write_csv(scratch)
    outputs = csv_outputs(spark, csv_config(scratch))
    rows, parts = routed_rows(outputs.rows, "d", "at")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1 and plan.count("from_csv(") == 1 and "InMemoryTableScan" not in plan and parts == ["_status", "d_day"]
    csv_batch(spark, csv_config(scratch, day=True))
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


@pytest.mark.parametrize("day", [False, True])
def test_both_outputs_of_one_write(spark, scratch, day):
    write_csv(scratch)
    csv_batch(spark, csv_config(scratch, day))
    table = spark.read.parquet(f"{scratch}/table")
    assert set(table.columns) == {"a", "d", "t", ROW_ID_COL, "bq_row_src", "at", *(["d_day"] if day else [])}
    assert table.count() == 48 and table.where("at is null or not bq_row_src like '%/a.csv'").count() == 0
    dead = spark.read.schema("value string, error string, source string").json(f"{scratch}/errors").collect()
    assert len(dead) == 12 and {r["error"] for r in dead} == {'failed at field: a, trace:For input string: "x"'}
    assert all(r["value"].startswith("x,2031") and r["source"].endswith("/a.csv") for r in dead)
    assert not hidden(f"{scratch}/table") and not hidden(f"{scratch}/errors")


def test_outputs_without_good_or_bad_rows(spark, scratch):
    write_csv(scratch, bad=100)
    csv_batch(spark, csv_config(scratch))
    assert spark.read.parquet(f"{scratch}/table").count() == 59
    write_csv(f"{scratch}/b", bad=1)
    csv_batch(spark, csv_config(f"{scratch}/b"))
    empty = spark.read.parquet(f"{scratch}/b/table")
    assert empty.count() == 0 and "a" in empty.columns and spark.read.json(f"{scratch}/b/errors").count() == 60


def test_repeatable_runs_and_truncates(spark, scratch):
    write_csv(scratch)
    for _ in range(2):
        csv_batch(spark, csv_config(scratch), run_id="r1", dead_letter_format="text")
    assert spark.read.parquet(f"{scratch}/table").count() == 48 and spark.read.text(f"{scratch}/errors").count() == 12
    csv_batch(spark, csv_config(scratch), run_id="r2", dead_letter_format="text")
    assert spark.read.parquet(f"{scratch}/table").count() == 96 and spark.read.text(f"{scratch}/errors").count() == 24
    write_csv(scratch, bad=100)
    csv_batch(spark, csv_config(scratch), run_id="r2", dead_letter_format="text")
    assert spark.read.parquet(f"{scratch}/table").count() == 48 + 59 and spark.read.text(f"{scratch}/errors").count() == 13
    csv_batch(spark, csv_config(scratch), disposition="WRITE_TRUNCATE")
    assert spark.read.parquet(f"{scratch}/table").count() == 59
    with pytest.raises(ValueError, match="not empty"):
        csv_batch(spark, csv_config(scratch), disposition="WRITE_EMPTY")


def test_a_job_that_dies_leaves_both_targets(spark, scratch, monkeypatch):
    write_csv(scratch)
    csv_batch(spark, csv_config(scratch))
    monkeypatch.setattr(Publication, "publish", lambda self: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        csv_batch(spark, csv_config(scratch))
    monkeypatch.undo()
    assert spark.read.parquet(f"{scratch}/table").count() == 48 and spark.read.json(f"{scratch}/errors").count() == 12


# ---------------------------------------------------------------- streams

def stream_config(root, field=""):
    os.makedirs(f"{root}/table", exist_ok=True)
    return {"BigQuerySinkDynamicStream": {"table": f"{root}/table", "loadTimeField": "", "pField": field}}


def message(spark, i):
    attrs = dict(ATTRS, MessageId=f"m{i}", LogicalDate=f"2031-01-0{1 + i % 2}")
    return spark.createDataFrame([('{"Type":"x"}', attrs, None)], "payload string, attributes map<string,string>, publish_time timestamp").coalesce(1)


def ids(spark, root):
    return sorted(r["MessageId"] for r in spark.read.parquet(f"{root}/table").collect())


@pytest.mark.parametrize("field", ["", "LogicalDate"])
def test_many_batches_leave_few_files_and_replays_change_nothing(spark, scratch, field):
    n, cfg = 60, stream_config(scratch, field)
    for i in range(n):
        process_batch(message(spark, i), f"run-{i}", "json", cfg, compact_every=5)
    want = sorted(f"m{i}" for i in range(n))
    assert ids(spark, scratch) == want
    assert len(data_files(f"{scratch}/table")) <= (16 if not field else 24)
    assert compacted_upto(spark, f"{scratch}/table", "run") >= 50
    for i in (0, 7, 31, n - 2, n - 1):
        process_batch(message(spark, i), f"run-{i}", "json", cfg)
        assert ids(spark, scratch) == want
    process_batch(message(spark, 99), "other-3", "json", cfg)  # another run's batches are its own
    assert len(ids(spark, scratch)) == n + 1 and compacted_upto(spark, f"{scratch}/table", "other") == -1


def test_compaction_that_dies_changes_nothing(spark, scratch, monkeypatch):
    cfg = stream_config(scratch)
    for i in range(6):
        process_batch(message(spark, i), f"run-{i}", "json", cfg)
    monkeypatch.setattr(Publication, "publish", lambda self: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        compact(spark, f"{scratch}/table", "run", 6, fan=2)
    monkeypatch.undo()
    want = [f"m{i}" for i in range(6)]
    assert ids(spark, scratch) == want
    process_batch(message(spark, 2), "run-2", "json", cfg)
    assert ids(spark, scratch) == want
    assert compact(spark, f"{scratch}/table", "run", 5, fan=2) == 5 and ids(spark, scratch) == want
    assert sorted(n for n in os.listdir(f"{scratch}/table") if n.startswith("batch=")) == ["batch=run-0..4", "batch=run-5"]


def test_batch_names():
    assert split_batch_id("a-b-12") == ("a-b", 12) and split_batch_id(3) is None and split_batch_id("x-y") is None
