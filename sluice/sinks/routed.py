"""Both outputs of a batch job in one write.

The job's rows, good and bad, are written once, partitioned by what became of
them.  A bad row travels in the lineage column: the text, reason and source
that its dead letter will hold take the place of the source.  The good part of
the stage then consists of the table's own files, which are moved into place;
the bad part, usually small, is read back and written as dead letters.  Both
targets are published together, so the input is read and parsed once, nothing
is kept on executors, and a job that dies leaves both targets as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.results import BARRIER_COL, ERROR_COL, INTERNAL_COLS, RAW_COL, ROW_SRC_COL, SRC_COL
from sluice.sinks.publish import AT_ONCE, Publication, recover
from sluice.sinks.table import RUN_COL, is_empty, by_day, day_column, outdated, partition_key, path_exists, stamp_load_time

STATUS = "_status"
LETTER = "value string, error string, source string"


def routed_rows(parsed: DataFrame, partition_field: str = "", load_time_field: str = "", run_id: str | None = None,
                files_per_partition: int | None = None) -> tuple[DataFrame, list[str]]:
    """The rows of both outputs, as the single write takes them, and its partition columns.

    ``parsed`` has the table's columns, ``bq_row_src`` among them, and the
    internal ones (``_error`` is NULL for a good row).
    """
    good = F.col(ERROR_COL).isNull()
    if BARRIER_COL in parsed.columns:
        good = good & (F.col(BARRIER_COL) >= 0)
    source = F.col(SRC_COL) if SRC_COL in parsed.columns else F.lit(None).cast("string")
    letter = F.to_json(F.struct(F.col(RAW_COL).alias("value"), F.col(ERROR_COL).alias("error"), source.alias("source")))

    def value(name: str) -> Column:
        column = F.col(f"`{name}`")
        return (F.when(good, column).otherwise(letter) if name == ROW_SRC_COL else F.when(good, column)).alias(name)

    names = [c for c in parsed.columns if c not in INTERNAL_COLS]
    if ROW_SRC_COL not in names:
        raise ValueError(f"rows need the lineage column {ROW_SRC_COL}")
    out = stamp_load_time(parsed.select(*[value(c) for c in names], F.when(good, "good").otherwise("bad").alias(STATUS)), load_time_field)
    parts = [STATUS]
    if partition_field:
        key = day_column(partition_field)
        out = out.withColumn(key, partition_key(F.col(f"`{partition_field}`")))
        parts.append(key)
        out = by_day(out, key, files_per_partition)
    if run_id is not None:
        out = out.withColumn(RUN_COL, F.lit(str(run_id)))
        parts.append(RUN_COL)
    return out, parts


def write_routed(parsed: DataFrame, target: str, error_path: str, disposition: str = "WRITE_APPEND", partition_field: str = "",
                 load_time_field: str = "", run_id: str | None = None, dead_letter_format: str = "json",
                 files_per_partition: int | None = None) -> None:
    """Write good rows to the table at path ``target`` and bad ones to the dead letters at ``error_path``.

    The contract is that of ``write_table`` and ``write_dead_letters``: the table
    must exist, ``WRITE_TRUNCATE`` replaces the days with rows (or all of a table
    without a partition field) and ``run_id`` makes both outputs repeatable.
    """
    spark = parsed.sparkSession
    target, error_path = target.rstrip("/"), error_path.rstrip("/")
    if not path_exists(spark, target):
        raise FileNotFoundError(f"target table {target} does not exist (tables are never created)")
    recover(spark, target)
    if disposition == "WRITE_EMPTY" and not is_empty(spark, target):
        raise ValueError(f"target table {target} is not empty")
    change = Publication(spark, target)
    stage, letters = change.stage(target), change.stage(error_path)
    try:
        rows, parts = routed_rows(parsed, partition_field, load_time_field, run_id, files_per_partition)
        rows.write.options(**AT_ONCE).partitionBy(*parts).parquet(stage)
        change.add(target, f"{stage}/{STATUS}=good")
        good = change.parts[-1]
        if run_id is not None or disposition == "WRITE_TRUNCATE":
            good.gone = outdated(change.files, target, change.files.data_files(good.stage), parts[1:])
        if not good.files and not good.folders and len(good.gone) == len(change.files.data_files(target)):
            # A table without rows still has columns.
            rows.drop(*parts).limit(0).write.parquet(f"{stage}/{STATUS}=none")
            change.add(target, f"{stage}/{STATUS}=none")
        if change.files.exists(f"{stage}/{STATUS}=bad"):
            bad = spark.read.schema(f"{ROW_SRC_COL} string").parquet(f"{stage}/{STATUS}=bad").select(F.from_json(ROW_SRC_COL, LETTER).alias("l")).select("l.*")
            runs = [RUN_COL] if run_id is not None else []
            bad = bad.withColumns({c: F.lit(str(run_id)) for c in runs})
            writer = (bad.select(*runs, "value") if dead_letter_format == "text" else bad).write
            (writer.partitionBy(*runs) if runs else writer).format("text" if dead_letter_format == "text" else "json").save(letters)
            change.add(error_path, letters)
        if run_id is not None:
            folder = f"{RUN_COL}={run_id}"
            gone = [f"{folder}/{f}" for f in change.files.data_files(f"{error_path}/{folder}")]
            if change.parts[-1].target != error_path:
                change.add(error_path, letters)
            change.parts[-1].gone = gone
        change.files.make(error_path)
    except BaseException:
        change.discard()
        change.files.delete(letters)
        raise
    change.publish()
