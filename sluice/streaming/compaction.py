"""Compaction of a stream's table: many small ``batch=`` partitions become few (K2, K9).

Every micro-batch leaves a ``batch=<run>-<id>`` partition.  ``compact`` merges
those of batches that the stream has committed, where there are enough of them,
into ``batch=<run>-<first>..<last>``; enough merged ones are merged again with
what has come since, so a row is rewritten about as often as the logarithm of
the number of batches.  Reading and writing are one Spark job; its files
replace the old partitions through a publication, so readers that come later
see either the old or the new files, and a job that dies changes nothing.

The table's log (``_log/<run>.json``) says up to which batch a run has been
compacted.  It is written before the publication: a replay of such a batch, say
after a checkpoint was restored, finds it there and writes nothing, as its rows
are in the table under one name or the other.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.sinks.publish import AT_ONCE, Files, Publication, recover

BATCH_COL = "batch"
LEAF = re.compile(rf"{BATCH_COL}=(?P<run>.+)-(?P<first>\d+)(?:\.\.(?P<last>\d+))?$")


def _log(root: str, run: str) -> str:
    return f"{root.rstrip('/')}/_log/{run}.json"


def compacted_upto(spark: SparkSession, root: str, run: str) -> int:
    """The last batch of a run that a compaction has taken in; -1 if there is none."""
    files, path = Files(spark, root), _log(root, run)
    return json.loads(files.read(path))["upto"] if files.exists(path) else -1


def split_batch_id(batch_id: int | str) -> tuple[str, int] | None:
    """Run and number of a batch named ``<run>-<number>``; None for other names."""
    run, dash, number = str(batch_id).rpartition("-")
    return (run, int(number)) if dash and run and number.isdigit() else None


def _leaves(files: Files, root: str, depth: int, prefix: str = "") -> list[tuple[str, re.Match]]:
    """(parent folder, match) of every batch partition ``depth`` folders below ``root``."""
    out = []
    for name in files.children(f"{root}/{prefix}".rstrip("/")):
        if name.startswith(("_", ".")):
            continue
        if depth:
            out += _leaves(files, root, depth - 1, f"{prefix}{name}/")
        elif found := LEAF.match(name):
            out.append((prefix, found))
    return out


def mergeable(leaves: list[tuple[str, re.Match]], run: str, before: int, fan: int) -> dict[str, list[str]]:
    """By parent folder: batch partitions of ``run`` below batch ``before`` that are worth merging."""
    out = {}
    by_parent = defaultdict(list)
    for parent, m in leaves:
        if m["run"] == run and int(m["last"] or m["first"]) < before:
            by_parent[parent].append(m)
    for parent, found in by_parent.items():
        single = [m for m in found if m["last"] is None]
        merged = [m for m in found if m["last"] is not None]
        if len(merged) >= fan:
            out[parent] = [m.string for m in found]
        elif len(single) >= fan:
            out[parent] = [m.string for m in single]
    return out


def compact(spark: SparkSession, root: str, run: str, before: int, parents: list[str] | None = None, fan: int = 16,
            fmt: str = "parquet") -> int:
    """Merge committed batches of ``run`` with numbers below ``before``; returns how many partitions were replaced.

    ``parents`` are the partition columns above ``batch`` (the day's).  Only where a
    folder holds at least ``fan`` single (or merged) batches is there anything to
    do.  Rows keep all columns; their order within a partition is not kept.
    """
    root, parents = root.rstrip("/"), list(parents or [])
    recover(spark, root)
    files = Files(spark, root)
    todo = mergeable(_leaves(files, root, len(parents)), run, before, fan)
    if not todo:
        return 0
    paths = [f"{parent}{leaf}" for parent, leaves in sorted(todo.items()) for leaf in leaves]
    ranges = [LEAF.match(p.rpartition("/")[2]) for p in paths]
    first, last = min(int(m["first"]) for m in ranges), max(int(m["last"] or m["first"]) for m in ranges)
    name = f"{run}-{first}..{last}"
    rows = _rows(spark, root, paths, parents, fmt).withColumn(BATCH_COL, F.lit(name))
    change = Publication(spark, root)
    stage = change.stage(root)
    try:
        keys = [F.col(f"`{p}`") for p in parents]
        rows.hint("rebalance", *keys).write.options(**AT_ONCE).format(fmt).partitionBy(*parents, BATCH_COL).save(stage)
        change.add(root, stage, paths)
        upto = max(last, compacted_upto(spark, root, run))
        files.make(f"{root}/_log")
        files.write(_log(root, run), json.dumps({"run": run, "upto": upto}))
    except BaseException:
        change.discard()
        raise
    change.publish()
    return len(paths)


def _rows(spark: SparkSession, root: str, paths: list[str], parents: list[str], fmt: str) -> DataFrame:
    """Rows of the partitions ``paths``, with the partition columns as text."""
    data = spark.read.format(fmt).load(f"{root}/{paths[0]}").schema
    schema = T.StructType([*data.fields, *[T.StructField(p, T.StringType()) for p in [*parents, BATCH_COL]]])
    return spark.read.schema(schema).format(fmt).option("basePath", root).load([f"{root}/{p}" for p in paths])
