"""Avro container files -> records (S7), with path date (S9) and lineage.

Files are grouped by the schema they were written with.  Each group is read by
its own schema and normalised by it; the groups' rows are then united by name,
with a type for each field that takes the values of all groups
(``operators/schema_merge.py``).

Spark's own Avro reader (``format("avro")``) is used when its module is on
the classpath: it splits files, converts logical types and keeps the work in
the JVM.  Without it, and only on request (``row_text=True``), each datum comes
through Avro's text input format as JSON (still one task per split, in
parallel) and is typed with ``from_json``; that is the only step where rows pass
through a Python worker, as plain strings.
"""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.avro_records import decode_json_datums, logical, normalise_records
from sluice.operators.results import ROW_ID_COL, ROW_SRC_COL, SRC_COL
from sluice.operators.schema_merge import union_of
from sluice.sources.files import extract_path_date, file_path, row_id

_GLOB = re.compile(r"([\\{}\[\]*?])")


def schema_groups(spark: SparkSession, path: str) -> list[tuple[dict, list[str]]]:
    """The distinct writer schemas of all files matching ``path``, in path order, with globs for the files of each.

    A folder stands for its ``.avro`` files.  Schemas come from the file headers
    (a few KB each, 16 at a time).
    """
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(conf)
    files, folders = [], []
    for st in fs.globStatus(hpath) or []:
        if st.isDirectory():
            folders.append(st)
            files += [s.getPath() for s in fs.listStatus(st.getPath()) if s.getPath().getName().endswith(".avro")]
        else:
            files.append(st.getPath())
    if not files:
        raise FileNotFoundError(f"no Avro file under {path}")

    def header(file) -> str:
        reader = jvm.org.apache.avro.file.DataFileReader(
            jvm.org.apache.avro.mapred.FsInput(file, conf), jvm.org.apache.avro.generic.GenericDatumReader())
        try:
            return reader.getSchema().toString()
        finally:
            reader.close()

    with ThreadPoolExecutor(16) as pool:
        texts = list(pool.map(header, files))
    groups: dict[str, list[str]] = {}
    for text, file in zip(texts, files):
        groups.setdefault(text, []).append(file.toString())
    if len(groups) == 1 and not folders:
        return [(json.loads(text), [path]) for text in groups]
    return [(json.loads(text), [_literal(p) for p in paths]) for text, paths in groups.items()]


def _literal(path: str) -> str:
    """A path as a glob that matches it alone."""
    return _GLOB.sub(r"\\\1", path)


def _spark_avro(spark: SparkSession, paths: list[str], avro: dict) -> DataFrame | None:
    """Spark's Avro reader, or None when its module is not deployed."""
    try:
        return spark.read.format("avro").option("avroSchema", json.dumps(avro)).load(paths)
    except Exception as exc:  # noqa: BLE001
        if "Failed to find data source" in str(exc):
            return None
        raise


def read_avro_records(spark: SparkSession, globs: list[str], avro: dict, row_text: bool = False) -> DataFrame:
    """Physical records of files of one schema, plus ``_src`` (source file) and ``bq_row_id``."""
    df = _spark_avro(spark, globs, avro)
    if df is not None:
        return df.withColumns({SRC_COL: file_path(), ROW_ID_COL: row_id()})
    if not row_text:
        raise RuntimeError("Spark's Avro module is not deployed; row_text=True reads the files through Avro's text input format")
    listed = ",".join(g.replace("\\", "\\\\").replace(",", "\\,") for g in globs)
    rdd = spark.sparkContext.hadoopRDD(
        "org.apache.avro.mapred.AvroAsTextInputFormat", "org.apache.hadoop.io.Text", "org.apache.hadoop.io.NullWritable",
        conf={"mapreduce.input.fileinputformat.inputdir": listed, "avro.mapred.ignore.inputs.without.extension": "false"})
    text = spark.createDataFrame(rdd.map(lambda kv: (kv[0],)), "datum string")
    text = text.withColumns({SRC_COL: F.input_file_name(), ROW_ID_COL: row_id(F.input_file_name(), F.input_file_block_start())})
    return decode_json_datums(text, "datum", avro, keep=[SRC_COL, ROW_ID_COL])


def field_defaults(schemas: list[dict]) -> dict[str, Column]:
    """By lower-case name: the latest non-null default of each field, where it is a plain value in the form its type is stored in."""
    out: dict[str, Any] = {}
    for schema in schemas:
        for f in schema["fields"]:
            base, kind, _ = logical(f["type"])
            if isinstance(f.get("default"), (str, int, float, bool)) and kind is None and base not in ("bytes", "fixed"):
                out[f["name"].lower()] = F.lit(f["default"])
    return out


def read_avro(
    spark: SparkSession,
    path: str,
    date_regex: str = "",
    partition_field: str = "",
    schema: dict | None = None,
    row_text: bool = False,
    fill_defaults: bool = False,
) -> DataFrame:
    """Normalised records + partition date field + ``bq_row_id`` / ``bq_row_src``.

    The date (first match of ``date_regex`` in the source path) is written as
    raw text under ``partition_field`` when the regex is set and matches.  A
    field that a file's schema lacks is NULL in its rows, or with
    ``fill_defaults`` the default that a later schema gives it.  With ``schema``
    all files are read by that one.
    """
    groups = [(schema, [path])] if schema else schema_groups(spark, path)
    keep = [SRC_COL, ROW_ID_COL]
    frames = [normalise_records(read_avro_records(spark, globs, avro, row_text), avro, keep=keep) for avro, globs in groups]
    rows = frames[0]
    if len(frames) > 1:
        rows = union_of(frames, field_defaults([avro for avro, _ in groups]) if fill_defaults else None)
    rows = rows.select(*[c for c in rows.columns if c not in keep], *keep)
    if date_regex and partition_field:
        date = extract_path_date(F.col(SRC_COL), date_regex)
        rows = rows.withColumn(partition_field, F.when(date != "", date))
    return rows.withColumn(ROW_SRC_COL, F.col(SRC_COL))
