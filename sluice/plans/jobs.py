"""The four ingestion jobs (J1-J4) and the mode dispatch.

Config is a plain dict that uses the same keys as the original job configs:

* ``FileSource.location.{path, extractDateRegex}``, ``FileSource.{headerRegex,
  trailerRegex, splitter}``, ``CsvToTableRowTransform.headers``
* ``AvroSource.{path, rowText, fillDefaults, partition.{extractDateRegex, pFieldName}}``,
  ``JsonStrategyTransform.jsonStrategy`` (list of ``{location, operation}``)
* ``BigQuerySinkDynamic.{table, loadTimeField, pField}`` (batch) and
  ``BigQuerySinkDynamicStream.{table, loadTimeField, pField,
  customGcsTempLocation}`` (stream)
* ``errorPath`` (dead letters), ``messages-bucket`` (raw archive)

Batch jobs write both of their outputs at once and publish them together where
the table is a path (``sinks/routed.py``): the input is read and parsed once and
nothing is cached.  A catalog table takes its rows through Spark's own insert;
the job then reads its input once for each output, or with ``single_scan=True``
keeps the parsed rows on executor disk between them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.delimited import drop_header_trailer, parse_delimited
from sluice.operators.results import ROW_ID_COL, ROW_SRC_COL, SRC_COL, bad_rows, good_rows
from sluice.operators.rules import apply_rules
from sluice.sinks.routed import write_routed
from sluice.sinks.table import RUN_COL, is_path, write_table, write_text
from sluice.sources.avro import read_avro
from sluice.sources.files import read_dated_lines, resolve_path

MODES = ("csv_batch", "avro_batch", "json_stream", "xml_stream")


@dataclass
class BatchOutputs:
    good: DataFrame          # rows as written to the table (without the load time)
    bad: DataFrame           # dead letters: value, error, source
    rows: DataFrame          # both, with the internal columns that tell them apart
    cached: DataFrame | None = None

    def release(self) -> None:
        if self.cached is not None:
            self.cached.unpersist()


def _maybe_cache(parsed: DataFrame, single_scan: bool) -> DataFrame:
    """``single_scan`` parses the input once and keeps the result on executor disk.

    Lost cached blocks are recomputed from the source, so executor loss is safe.
    """
    return parsed.persist(StorageLevel.DISK_ONLY) if single_scan else parsed


def _get(conf: Mapping[str, Any], dotted: str, default: Any = None) -> Any:
    cur: Any = conf
    for part in dotted.split("."):
        if not isinstance(cur, Mapping) or part not in cur:
            return default
        cur = cur[part]
    return cur


def prepare_session(spark: SparkSession) -> None:
    """Jobs read and print date/times in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def csv_outputs(spark: SparkSession, config: Mapping[str, Any], file_path: str | None = None,
                on_no_date: str = "fail", single_scan: bool = False) -> BatchOutputs:
    """J1 plan: delimited files -> typed rows + dead letters (nothing written)."""
    prepare_session(spark)
    path = resolve_path(_get(config, "FileSource.location.path"), file_path)
    date_regex = _get(config, "FileSource.location.extractDateRegex", "") or ""
    lines = read_dated_lines(spark, path, date_regex, on_no_date, id_col=ROW_ID_COL)
    lines = drop_header_trailer(lines, _get(config, "FileSource.headerRegex"), _get(config, "FileSource.trailerRegex"))
    parsed = parse_delimited(
        lines,
        _get(config, "CsvToTableRowTransform.headers"),
        splitter=_get(config, "FileSource.splitter", ",") or ",",
        date_col="file_date" if date_regex else None,
        src_col="path",
        keep=[ROW_ID_COL],
    )
    parsed = _maybe_cache(parsed, single_scan)
    fields = [c for c in parsed.columns if c != ROW_ID_COL]
    stamped = parsed.select(*fields, ROW_ID_COL, F.col(SRC_COL).alias(ROW_SRC_COL))
    return BatchOutputs(good_rows(stamped), bad_rows(parsed), stamped, parsed if single_scan else None)


def avro_outputs(spark: SparkSession, config: Mapping[str, Any], file_path: str | None = None,
                 compat: bool = False, single_scan: bool = False) -> BatchOutputs:
    """J2 plan: Avro files -> normalised records -> update rules -> rows + dead letters."""
    prepare_session(spark)
    path = resolve_path(_get(config, "AvroSource.path"), file_path)
    records = read_avro(
        spark, path,
        date_regex=_get(config, "AvroSource.partition.extractDateRegex", "") or "",
        partition_field=_get(config, "AvroSource.partition.pFieldName", "") or "",
        row_text=bool(_get(config, "AvroSource.rowText", False)),
        fill_defaults=bool(_get(config, "AvroSource.fillDefaults", False)),
    )
    ruled = apply_rules(records, _get(config, "JsonStrategyTransform.jsonStrategy", []) or [], compat=compat)
    ruled = _maybe_cache(ruled, single_scan)
    return BatchOutputs(good_rows(ruled), bad_rows(ruled), ruled, ruled if single_scan else None)


def _write_batch(outputs: BatchOutputs, config: Mapping[str, Any], disposition: str,
                 dead_letter_format: str, run_id: str | None = None) -> None:
    sink = _get(config, "BigQuerySinkDynamic", {}) or {}
    if run_id is not None and disposition != "WRITE_APPEND":
        raise ValueError("run_id makes appends repeatable; use it with WRITE_APPEND")
    error_path = _get(config, "errorPath")
    if error_path and outputs.cached is None and is_path(sink["table"]):
        write_routed(outputs.rows, sink["table"], error_path, disposition, sink.get("pField", "") or "",
                     sink.get("loadTimeField", "") or "", run_id, dead_letter_format)
        return
    if error_path:
        write_dead_letters(outputs.bad, error_path, dead_letter_format, run_id=run_id)
    write_table(outputs.good, sink["table"], disposition=disposition,
                partition_field=sink.get("pField", "") or "", load_time_field=sink.get("loadTimeField", "") or "",
                run_id=run_id)


def write_dead_letters(bad: DataFrame, path: str, fmt: str = "json", partition_cols: list[str] | None = None,
                       mode: str = "append", run_id: str | None = None) -> None:
    """Dead letters as JSON lines (value, error, source) or as bare text lines.

    With ``run_id`` they land in an ``ingest_run=<run_id>`` folder replaced as
    a whole, so a rerun of the same load does not duplicate them.
    """
    parts = list(partition_cols or [])
    if run_id is not None:
        bad = bad.withColumn(RUN_COL, F.lit(str(run_id)))
        parts.append(RUN_COL)
        mode = "overwrite"
    if fmt == "text":
        if run_id is None:
            write_text(bad, path, "value", partition_cols=parts, mode=mode)
            return
        bad = bad.select(*[F.col(c) for c in parts], F.col("value"))
        bad.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*parts).text(path)
        return
    writer = bad.write.mode(mode)
    if run_id is not None:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if parts:
        writer = writer.partitionBy(*parts)
    writer.json(path)


def csv_batch(spark: SparkSession, config: Mapping[str, Any], file_path: str | None = None,
              disposition: str = "WRITE_APPEND", dead_letter_format: str = "json",
              on_no_date: str = "fail", single_scan: bool = False, run_id: str | None = None) -> BatchOutputs:
    """Run the delimited job and write both outputs (``run_id``: repeatable appends)."""
    outputs = csv_outputs(spark, config, file_path, on_no_date, single_scan)
    try:
        _write_batch(outputs, config, disposition, dead_letter_format, run_id)
    finally:
        outputs.release()
    return outputs


def avro_batch(spark: SparkSession, config: Mapping[str, Any], file_path: str | None = None,
               disposition: str = "WRITE_APPEND", dead_letter_format: str = "json",
               compat: bool = False, single_scan: bool = False, run_id: str | None = None) -> BatchOutputs:
    """Run the Avro job and write both outputs (``run_id``: repeatable appends)."""
    outputs = avro_outputs(spark, config, file_path, compat, single_scan)
    try:
        _write_batch(outputs, config, disposition, dead_letter_format, run_id)
    finally:
        outputs.release()
    return outputs


def run(spark: SparkSession, mode: str, config: Mapping[str, Any], *, file_path: str | None = None,
        subscription: str | None = None, disposition: str = "WRITE_APPEND", **options: Any):
    """Pick a job by mode; an unknown mode is an error."""
    if mode == "csv_batch":
        return csv_batch(spark, config, file_path, disposition, **options)
    if mode == "avro_batch":
        return avro_batch(spark, config, file_path, disposition, **options)
    if mode in ("json_stream", "xml_stream"):
        from sluice.streaming.stream import start_message_stream

        if not subscription:
            raise ValueError(f"{mode} needs a subscription")
        return start_message_stream(spark, mode.split("_")[0], config, subscription, **options)
    raise ValueError(f"unknown ingestion mode {mode!r}; expected one of {', '.join(MODES)}")
