"""Ranks of pieces within their length, and their places by a plan over (length, rank).

Packing decides by counts: so many pieces of a length go to such windows.
These helpers tell which piece is which, whatever share of all pieces has one
length, and put them where the plan says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from sluice.llm.common import Scratch, tidy

BROADCAST_BASES = 100_000
"""Rows (writing task, length) that may be sent to all executors; more are joined by a shuffle."""


class TaskRanks:
    """Numbers the pieces of each length that one task handles, in the order they come."""

    def __init__(self):
        import numpy as np
        from pyspark import TaskContext

        self.part, self.seen = TaskContext.get().partitionId(), np.zeros(1 << 12, np.int64)

    def columns(self, length):
        """``_part`` and ``_nth`` of pieces of these lengths, as Arrow arrays."""
        import numpy as np
        import pyarrow as pa

        if len(length) and length.max() >= len(self.seen):
            self.seen = np.concatenate([self.seen, np.zeros(length.max() + 1 - len(self.seen), np.int64)])
        o = np.argsort(length, kind="stable")
        own, first, n = np.unique(length[o], return_index=True, return_counts=True)
        nth = np.empty(len(o), np.int64)
        nth[o] = np.arange(len(o)) - np.repeat(first - self.seen[own], n)
        self.seen[own] += n
        return [pa.array(np.full(len(o), self.part, np.int32)), pa.array(nth)]


RANK_FIELDS = [StructField("_part", IntegerType()), StructField("_nth", LongType())]


def numbered_by_task(pieces: DataFrame) -> DataFrame:
    """``pieces(length, ...)`` with the task that handles a row, ``_part``, and the row's number ``_nth`` among that task's rows of its length."""
    names = [c for c in pieces.columns if c not in ("_part", "_nth")]

    def number(batches):
        import pyarrow as pa

        ranks = TaskRanks()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *ranks.columns(b.column("length").to_numpy())], [*names, "_part", "_nth"])

    return pieces.select(*names).mapInArrow(tidy(number), StructType([*pieces.select(*names).schema.fields, *RANK_FIELDS]))


def ranked(pieces: DataFrame, tmp: Scratch) -> tuple[DataFrame, dict[int, int]]:
    """``pieces(length, _part, _nth, ...)`` with ``_rank``, gapless from 0 within a length, and the number of pieces by length.

    ``_nth`` numbers the pieces of a length within the task ``_part`` that wrote
    them.  Only counts by (task, length) are sorted, and added up per length;
    pieces themselves are not, so no length is gathered anywhere.
    """
    counts = tmp.keep(pieces.groupBy("_part", "length").agg(F.count(F.lit(1)).alias("_n")), "counts")
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    lengths = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    side = F.broadcast(bases) if counts.count() <= BROADCAST_BASES else bases
    out = pieces.join(side, ["_part", "length"]).withColumn("_rank", F.col("_nth") + F.col("_base"))
    return out.drop("_part", "_nth", "_base"), lengths


def placed(pieces: DataFrame, plan: list[tuple[int, int, int, int, int]]) -> DataFrame:
    """``pieces(length, _rank, ...)`` with ``sequence_id`` and ``offset`` in place of the rank.

    An entry ``(length, lo, per, first, offset)`` puts the pieces of that length
    from rank ``lo`` up to its next entry into the windows ``first, first + 1,
    ...``, ``per`` to a window, one behind the other from ``offset`` on.
    """
    import numpy as np

    entries = np.array(sorted(plan), np.int64).reshape(-1, 5)
    shipped = pieces.sparkSession.sparkContext.broadcast(entries)
    names = [c for c in pieces.columns if c not in ("_rank", "sequence_id", "offset")]

    def place(batches):
        import pyarrow as pa

        e = shipped.value
        starts = np.searchsorted(e[:, 0], np.arange(e[-1, 0] + 2)) if len(e) else None
        for b in batches:
            if not b.num_rows:
                continue
            length, rank = (b.column(c).to_numpy() for c in ("length", "_rank"))
            at = np.empty(len(length), np.int64)
            o = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[o])) + 1
            for k in np.split(o, cuts):
                a, z = starts[length[k[0]]], starts[length[k[0]] + 1]
                at[k] = a + np.searchsorted(e[a:z, 1], rank[k], side="right") - 1
            _, lo, per, first, offset = e[at].T
            share = rank - lo
            added = [pa.array(first + share // per), pa.array(offset + share % per * length)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *added], [*names, "sequence_id", "offset"])

    fields = [f for f in pieces.schema.fields if f.name in names]
    schema = StructType(fields).add("sequence_id", LongType()).add("offset", LongType())
    return pieces.select(*names, "_rank").mapInArrow(tidy(place), schema)
