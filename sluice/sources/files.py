"""Text file scan with the source path and a date taken from the path.

``spark.read.text`` splits large files across tasks (gzip is decoded, though a
gzip file is one split), and ``_metadata.file_path`` gives each line its file
without a per-file Python step.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NO_DATE_MATCH = "no date in path"


def resolve_path(conf_path: str | None, file_path: str | None) -> str:
    """A runtime path wins when it is non-empty; otherwise the config path."""
    if file_path:
        return file_path
    if not conf_path:
        raise ValueError("no input path: neither a runtime path nor a configured path is set")
    return conf_path


def check_date_regex(regex: str) -> None:
    """A non-empty path regex must hold exactly one capture group (checked on the driver)."""
    if not regex:
        return
    try:
        groups = re.compile(regex).groups
    except re.error:
        groups = _count_groups(regex)
    if groups != 1:
        raise ValueError(f"date regex must have exactly one capture group, got {groups}: {regex}")


def _count_groups(regex: str) -> int:
    count, i = 0, 0
    while i < len(regex):
        ch = regex[i]
        if ch == "\\":
            i += 2
            continue
        if ch == "(" and not regex.startswith("(?", i):
            count += 1
        elif regex.startswith("(?<", i) and not regex.startswith("(?<=", i) and not regex.startswith("(?<!", i):
            count += 1
        i += 1
    return count


def extract_path_date(path: Column, regex: str | None) -> Column:
    """First (unanchored) match of ``regex`` in the full path; its group is the date.

    Empty or missing regex -> ''.  No match -> NULL, which the job turns into
    a failure (or a dead letter when so configured).
    """
    if not regex:
        return F.lit("")
    check_date_regex(regex)
    return F.when(path.rlike(regex), F.regexp_extract(path, regex, 1))


def file_path() -> Column:
    """The path of a row's source file as it is named (Spark's metadata column holds it percent-encoded)."""
    path = F.col("_metadata.file_path")
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)


def row_id(path: Column | None = None, block: Column | None = None) -> Column:
    """A row's id in UUID form, made of its file, its block's start in the file and its number among the rows its task reads.

    To be taken right above the scan.  A retried task, the two outputs of a job
    and a second run over the same files (under the same split settings) all
    give a row the same id.
    """
    path = F.col("_metadata.file_path") if path is None else path
    block = F.col("_metadata.file_block_start") if block is None else block
    number = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    h = F.md5(F.concat_ws("|", path, block.cast("string"), number.cast("string")).cast("binary"))
    return F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")


def read_lines(spark: SparkSession, path: str, line_col: str = "line", path_col: str = "path", id_col: str | None = None) -> DataFrame:
    """One row per line (UTF-8), with the full source path of each line, and its id under ``id_col`` if given."""
    ids = [row_id().alias(id_col)] if id_col else []
    return spark.read.format("text").load(path).select(
        F.col("value").alias(line_col), file_path().alias(path_col), *ids
    )


def read_dated_lines(
    spark: SparkSession,
    path: str,
    date_regex: str | None,
    on_no_match: str = "fail",
    id_col: str | None = None,
) -> DataFrame:
    """Lines + path + ``file_date`` (+ the row's id under ``id_col``).

    ``on_no_match='fail'`` stops the job on a path without a date (a task error
    raised by ``raise_error``); ``'dead_letter'`` keeps the rows with a NULL
    date so the delimited step sends them to the dead-letter store.
    """
    lines = read_lines(spark, path, id_col=id_col)
    date = extract_path_date(F.col("path"), date_regex)
    if date_regex and on_no_match == "fail":
        date = F.coalesce(date, F.raise_error(F.concat(F.lit(f"{NO_DATE_MATCH}: "), F.col("path"))).cast("string"))
    elif on_no_match not in ("fail", "dead_letter"):
        raise ValueError(f"on_no_match must be 'fail' or 'dead_letter', got {on_no_match!r}")
    return lines.withColumn("file_date", date)
