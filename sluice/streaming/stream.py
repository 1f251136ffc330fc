"""Message streams (J3, J4): one source, three outputs per micro-batch.

Each micro-batch is processed in ``foreachBatch``:

1. the raw archive gets every message as ``payload,TopicName,MessageId,LogicalDate``
   under its 1-minute event-time window (W1, W2);
2. messages are bound (JSON or XML); good rows are appended to the table,
   routed by day when a partition field is set, with the load time stamped
   (K2, K3, K4);
3. failed messages go to the dead-letter store under their window (W3), and so
   do envelopes that cannot be read, with their whole line.

Writes are idempotent per batch: every output lands in a ``batch=<run>-<id>``
partition written with dynamic partition overwrite, so a batch replayed after
a failure (same offsets, from the checkpoint) replaces its own files instead
of adding duplicates.  ``<run>`` is kept inside the checkpoint, so a new
checkpoint never overwrites the batches of an earlier one.  Late messages keep
their own minute's folder, messages without a time share the folder ``unknown``:
the archive holds a line per message that came in.  With ``compact_every`` the
table's batches are merged as the stream goes on (``streaming/compaction.py``).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Mapping
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sluice.operators.messages_json import bind_json_messages
from sluice.operators.messages_xml import archive_lines, bind_xml_messages, minute_window
from sluice.operators.results import bad_rows, good_rows
from sluice.session import ensure_checkpoint_dir
from sluice.sinks.table import day_column, is_path, overwrite_partitions, partition_key, spread, stamp_load_time, target_exists
from sluice.sources.messages import read_message_stream
from sluice.streaming.compaction import BATCH_COL, compact, compacted_upto, split_batch_id

MALFORMED_ENVELOPE = "malformed message envelope"
DEFAULT_TRIGGER = "1 minute"


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """A random id stored in the checkpoint folder at first start, read back on restarts."""
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/sluice-run-id")
    fs = path.getFileSystem(conf)
    if fs.exists(path):
        stream = fs.open(path)
        try:
            reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
            return reader.readLine().strip()
        finally:
            stream.close()
    run = uuid.uuid4().hex[:12]
    out = fs.create(path, False)
    try:
        out.write(bytearray(run.encode()))
    finally:
        out.close()
    return run


def default_checkpoint(spark: SparkSession, kind: str, subscription: str, table: str) -> str:
    """A stable checkpoint folder for one stream, under the shared checkpoint root."""
    key = hashlib.sha1(f"{kind}|{subscription}|{table}".encode()).hexdigest()[:16]
    return f"{ensure_checkpoint_dir(spark)}/sluice/stream-{kind}-{key}"


def process_batch(batch: DataFrame, batch_id: int | str, kind: str, config: Mapping[str, Any],
                  bind_options: Mapping[str, Any] | None = None, files_per_window: int | None = None,
                  table_files: int | None = None, compact_every: int | None = None) -> None:
    """The body of one micro-batch (also usable on a static frame of envelopes).

    ``files_per_window`` gathers each window's archive and dead-letter lines
    into that many writers (a salted shuffle; more for what is beyond the
    advisory partition size), which bounds the file count when one batch
    spans many minutes, e.g. while catching up on a backlog.
    ``table_files`` spreads the batch's table rows evenly over that many
    writers (the original loads used 200 shards).  By default every task
    writes its own rows.  After every ``compact_every``-th batch the table's
    earlier batches (of a path, not a catalog table) are merged; a batch that
    has been merged before is a replay, and its rows are in the table.
    """
    sink = dict(config.get("BigQuerySinkDynamicStream", {}) or {})
    table = sink.get("table")
    if not table:
        raise ValueError("BigQuerySinkDynamicStream.table is required")
    spark = batch.sparkSession
    if not target_exists(spark, table):
        raise FileNotFoundError(f"target table {table} does not exist (tables are never created)")
    batch = persisted = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        bid = F.lit(str(batch_id))
        archive_root = config.get("messages-bucket")
        if archive_root:
            archive = archive_lines(batch).withColumn(BATCH_COL, bid)
            if files_per_window:
                archive = spread(archive, "window", files_per_window)
            overwrite_partitions(archive, archive_root, ["window", BATCH_COL], "text")

        keep = ["publish_time"]
        if "malformed" not in batch.columns:
            batch = batch.withColumn("malformed", F.lit(None).cast("string"))
        sound = batch.where(F.col("malformed").isNull())
        if kind == "json":
            parsed = bind_json_messages(sound, keep=keep, **(bind_options or {}))
        elif kind == "xml":
            parsed = bind_xml_messages(sound, keep=keep, **(bind_options or {}))
        else:
            raise ValueError(f"unknown message kind {kind!r}")
        parsed = parsed.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            good = good_rows(parsed).drop("publish_time")
            good = stamp_load_time(good, sink.get("loadTimeField", "") or "").withColumn(BATCH_COL, bid)
            parts = [BATCH_COL]
            pfield = sink.get("pField", "") or ""
            if pfield:
                good = good.withColumn(day_column(pfield), partition_key(F.col(pfield)))
                parts = [day_column(pfield), BATCH_COL]
            if table_files:
                good = good.repartition(table_files, F.pmod(F.monotonically_increasing_id(), F.lit(table_files)))
            named = split_batch_id(batch_id) if is_path(table) else None
            if named is None or named[1] > compacted_upto(spark, table, named[0]):
                overwrite_partitions(good, table, parts, "parquet")

            error_root = config.get("errorPath")
            if error_root:
                broken = batch.where(F.col("malformed").isNotNull()).select(
                    F.col("malformed").alias("value"), F.lit(MALFORMED_ENVELOPE).alias("error"),
                    F.lit(None).cast("string").alias("source"), "publish_time")
                bad = bad_rows(parsed, keep=["publish_time"]).unionByName(broken)
                bad = bad.select(minute_window(F.col("publish_time")).alias("window"), "value", "error", "source").withColumn(BATCH_COL, bid)
                if files_per_window:
                    bad = spread(bad, "window", files_per_window)
                overwrite_partitions(bad, error_root, ["window", BATCH_COL], "json")
        finally:
            parsed.unpersist()
    finally:
        persisted.unpersist()
    if compact_every and named and (named[1] + 1) % compact_every == 0:
        compact(spark, table, *named, parents=parts[:-1], fan=max(2, min(16, compact_every - 1)))


def start_message_stream(
    spark: SparkSession,
    kind: str,
    config: Mapping[str, Any],
    subscription: str,
    *,
    trigger: str | None = DEFAULT_TRIGGER,
    available_now: bool = False,
    checkpoint: str | None = None,
    kafka_options: Mapping[str, str] | None = None,
    bind_options: Mapping[str, Any] | None = None,
    max_files_per_trigger: int | None = None,
    files_per_window: int | None = None,
    table_files: int | None = None,
    compact_every: int | None = None,
    raw: bool = False,
) -> StreamingQuery:
    """Start J3 (``kind='json'``) or J4 (``kind='xml'``).

    The checkpoint goes to ``customGcsTempLocation`` when set, else under the
    cluster's shared ``spark.checkpoint.dir``.  ``compact_every`` merges the
    table's committed batches after every so many; ``raw`` reads a folder of a
    broker's rows instead of envelopes.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    sink = config.get("BigQuerySinkDynamicStream", {}) or {}
    location = checkpoint or sink.get("customGcsTempLocation") or default_checkpoint(
        spark, kind, subscription, str(sink.get("table")))
    run = _run_id(spark, location)
    source = read_message_stream(spark, subscription, kafka_options, max_files_per_trigger, raw)
    writer = (source.writeStream
              .foreachBatch(lambda df, bid: process_batch(df, f"{run}-{bid}", kind, config, bind_options,
                                                          files_per_window, table_files, compact_every))
              .option("checkpointLocation", location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif trigger:
        writer = writer.trigger(processingTime=trigger)
    return writer.start()
