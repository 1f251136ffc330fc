"""Table sink (K1, K3-K6) and text/topic sinks (K7, K8).

A target is a catalog table name or a path.  Nothing is created implicitly:
a missing target is an error, as is a non-empty one under ``WRITE_EMPTY``.  What a
load writes to a path is staged and then published as a whole
(``sinks/publish.py``): one that dies while it writes leaves the table as it was.
"""

from __future__ import annotations

import threading
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sinks.publish import AT_ONCE, Files, Publication, recover

DISPOSITIONS = ("WRITE_APPEND", "WRITE_TRUNCATE", "WRITE_EMPTY")
RUN_COL = "ingest_run"
SALT_COL = "__writer"
SMALL_LOAD = 8
"""Partitions of the advisory size below which a load is dealt by day alone: the most that one day's task can get."""


def partition_key(day: Column) -> Column:
    """Day-partition key: the field's date text with '-' removed (``yyyymmdd``)."""
    return F.regexp_replace(day.cast("string"), "-", "")


def day_column(partition_field: str) -> str:
    return f"{partition_field}_day"


def stamp_load_time(df: DataFrame, load_time_field: str | None) -> DataFrame:
    """K3: set the load-time field to the write's timestamp when configured."""
    if not load_time_field:
        return df
    return df.withColumn(load_time_field, F.current_timestamp())


def is_path(target: str) -> bool:
    return "/" in target or ":" in target


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def _has_data(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    it = fs.listFiles(hpath, True)
    while it.hasNext():
        name = it.next().getPath().getName()
        if not name.startswith(("_", ".")):
            return True
    return False


def by_day(df: DataFrame, key: str, files_per_key: int | None) -> DataFrame:
    """Deal rows of a day-partitioned write to its writers.

    By default the rows are shuffled by day and Spark rebalances the partitions
    by their measured sizes (the session's advisory partition size): a day with
    half the rows gets its share of the writers, small days share one and get a
    file each.  Loads expected to hold less than ``SMALL_LOAD`` such partitions are
    dealt by day to all cores, so that no single task opens all their files.  A
    number sets the writers of every day, 0 leaves rows where they are, so that
    every task writes a file for each of its days.
    """
    if files_per_key is None:
        spark, column = df.sparkSession, F.col(f"`{key}`")
        advisory = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
            spark._jsparkSession.sessionState().conf().getConfString("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB"))
        expected = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        small = expected < SMALL_LOAD * advisory
        return df.repartition(spark.sparkContext.defaultParallelism, column) if small else df.hint("rebalance", column)
    return spread(df, key, files_per_key) if files_per_key else df


def spread(df: DataFrame, key: str, files_per_key: int) -> DataFrame:
    """Shuffle rows so each key value is written by ``files_per_key`` tasks.

    The salt cycles with the row id, so a hot key -- even one made of
    identical copies -- is split over several writers instead of one.  What a
    task would get beyond the session's advisory partition size Spark gives to
    further ones, so that no task's share grows with the input.
    """
    salted = df.withColumn(SALT_COL, F.pmod(F.monotonically_increasing_id(), F.lit(files_per_key)))
    return salted.hint("rebalance", F.col(f"`{key}`"), F.col(SALT_COL)).drop(SALT_COL)


def write_table(
    df: DataFrame,
    target: str,
    disposition: str = "WRITE_APPEND",
    partition_field: str = "",
    load_time_field: str = "",
    create: bool = False,
    files_per_partition: int | None = None,
    fmt: str = "parquet",
    run_id: str | None = None,
) -> None:
    """K1: write rows to ``target`` (path or catalog table), never creating it by default.

    With ``partition_field`` the rows are routed to day partitions keyed by
    that field's date (``<field>_day=yyyymmdd``); a NULL date goes to the
    default partition.  ``files_per_partition`` is ``by_day``'s.  ``WRITE_TRUNCATE``
    then replaces the days that have rows and leaves the others; without a
    partition field it replaces the table.  With ``run_id`` (append only) the rows land in
    ``ingest_run=<run_id>`` partitions replaced as a whole, so running the
    same load again after a failure does not duplicate rows.  A catalog table
    must have these partition columns, and every column that is written.
    """
    if disposition not in DISPOSITIONS:
        raise ValueError(f"unknown write disposition {disposition!r}")
    spark = df.sparkSession
    if not target_exists(spark, target) and not (create and is_path(target)):
        raise FileNotFoundError(f"target table {target} does not exist (tables are never created)")
    if run_id is not None and disposition != "WRITE_APPEND":
        raise ValueError("run_id makes appends repeatable; use it with WRITE_APPEND")
    if disposition == "WRITE_EMPTY" and not is_empty(spark, target):
        raise ValueError(f"target table {target} is not empty")
    out = stamp_load_time(df, load_time_field)
    parts: list[str] = []
    if partition_field:
        key = day_column(partition_field)
        out = out.withColumn(key, partition_key(F.col(f"`{partition_field}`")))
        out = by_day(out, key, files_per_partition)
        parts = [key]
    if run_id is not None:
        out = out.withColumn(RUN_COL, F.lit(str(run_id)))
        parts.append(RUN_COL)
    replaced = run_id is not None or disposition == "WRITE_TRUNCATE"
    if is_path(target):
        _load(out, target, parts, fmt, replaced)
    elif replaced and parts:
        overwrite_partitions(out, target, parts, fmt)
    else:
        _as_table(out, target, parts).write.insertInto(target, overwrite=disposition == "WRITE_TRUNCATE")


def outdated(files: Files, target: str, staged: list[str], parts: list[str]) -> list[str]:
    """Data files of ``target`` that the staged ones replace: those of the same partitions, or all without partitions."""
    if not parts:
        return files.data_files(target)
    folders = {f.rpartition("/")[0] for f in staged}
    return [f"{folder}/{f}" for folder in sorted(folders) for f in files.data_files(f"{target}/{folder}")]


def _load(df: DataFrame, target: str, parts: list[str], fmt: str, replaced: bool) -> None:
    """Stage the rows, then publish them beside the old ones or in place of the partitions they fill (or of the whole table)."""
    if path_exists(df.sparkSession, target):
        recover(df.sparkSession, target)
    change = Publication(df.sparkSession, target)
    stage = change.stage(target)
    try:
        writer = df.write.format(fmt).options(**AT_ONCE)
        (writer.partitionBy(*parts) if parts else writer).save(stage)
        change.add(target, stage, outdated(change.files, target.rstrip("/"), change.files.data_files(stage), parts) if replaced else ())
    except BaseException:
        change.discard()
        raise
    change.publish()


def target_exists(spark: SparkSession, target: str) -> bool:
    return path_exists(spark, target) if is_path(target) else spark.catalog.tableExists(target)


def is_empty(spark: SparkSession, target: str) -> bool:
    if is_path(target):
        return not path_exists(spark, target) or not _has_data(spark, target)
    return spark.table(target).isEmpty()


def _as_table(df: DataFrame, target: str, parts: list[str]) -> DataFrame:
    """The columns of a catalog table in its order; a column or partition that it lacks is an error."""
    spark = df.sparkSession
    columns = spark.catalog.listColumns(target)
    names = {c.name.lower() for c in columns}
    extra = [c for c in df.columns if c.lower() not in names]
    if extra:
        raise ValueError(f"target table {target} has no column {', '.join(extra)}")
    partitions = {c.name.lower() for c in columns if c.isPartition}
    unrouted = [c for c in parts if c.lower() not in partitions]
    if unrouted:
        raise ValueError(f"target table {target} is not partitioned by {', '.join(unrouted)}")
    return df.select(*[F.col(f"`{c.name}`") for c in columns])


def overwrite_partitions(df: DataFrame, target: str, parts: list[str], fmt: str) -> None:
    """Replace the partitions that ``df`` has rows for, and leave all others as they are."""
    if is_path(target):
        # Spark stages these files itself and moves whole partitions when all are written.
        (df.write.mode("overwrite").options(partitionOverwriteMode="dynamic", **AT_ONCE).partitionBy(*parts).format(fmt).save(target))
        return
    with _dynamic_overwrite(df.sparkSession):
        _as_table(df, target, parts).write.insertInto(target, overwrite=True)


_overwriting: dict[str, list] = {}
_lock = threading.Lock()


@contextmanager
def _dynamic_overwrite(spark: SparkSession):
    """The session's overwrite mode is dynamic while any writer is inside; inserts into catalog tables know no other way to say so."""
    key, session = "spark.sql.sources.partitionOverwriteMode", spark._jsparkSession.sessionUUID()
    with _lock:
        held = _overwriting.setdefault(session, [0, spark.conf.get(key)])
        held[0] += 1
        spark.conf.set(key, "dynamic")
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                spark.conf.set(key, held[1])
                del _overwriting[session]


def write_text(
    df: DataFrame,
    path: str,
    value_col: str = "value",
    partition_cols: list[str] | None = None,
    num_files: int | None = None,
    mode: str = "append",
) -> None:
    """K7: text lines (``.txt`` files) under ``path``, optionally one folder per window.

    ``num_files`` fixes the number of writers (a shuffle); by default each
    input task writes its own files, so a large dead-letter set is not
    funnelled through a few tasks.
    """
    parts = list(partition_cols or [])
    out = df.select(*[F.col(c) for c in parts], F.col(value_col).cast("string").alias("value"))
    if num_files:
        out = out.repartition(num_files)
    writer = out.write.mode(mode)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.text(path)


def write_topic(df: DataFrame, topic: str, value_col: str = "value", bootstrap_servers: str | None = None) -> None:
    """K8: strings to a message topic.

    With ``bootstrap_servers`` the rows go to Kafka (needs Spark's Kafka
    module); otherwise ``topic`` is a folder and each row becomes a JSON-lines
    envelope ``{payload, attributes, publish_time}`` that the message source
    reads back.
    """
    values = df.select(F.col(value_col).cast("string").alias("value"))
    if bootstrap_servers:
        (values.write.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
         .option("topic", topic).save())
        return
    envelope = values.select(
        F.col("value").alias("payload"),
        F.create_map().cast("map<string,string>").alias("attributes"),
        F.current_timestamp().alias("publish_time"),
    )
    envelope.write.mode("append").json(topic)
