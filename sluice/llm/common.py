"""Helpers shared by the training-data operators."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.session import ensure_checkpoint_dir

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20
"""Rows and bytes that go to a Python worker at once, at most (a longer text goes alone)."""


def small_batches(spark: SparkSession) -> None:
    """Bound the batches sent to Python workers, so that documents of any length fit beside the executor's heap."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def tidy(fn):
    """``fn`` over batches; what its task has freed goes back to the system when the task ends, as Python workers live on."""
    def run(batches):
        import ctypes

        import pyarrow as pa

        try:
            yield from fn(batches)
        finally:
            pa.default_memory_pool().release_unused()
            libc = ctypes.CDLL(None)
            if hasattr(libc, "malloc_trim"):
                libc.malloc_trim(0)

    return run


def small_frame(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A few rows as a DataFrame, through Arrow (plain lists would start Python workers of another kind)."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)
    columns = list(zip(*rows)) or [[]] * len(kinds)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.types)], names=kinds.names), schema)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


class Scratch:
    """Intermediate tables of one operator run, in the folder that ``spark.checkpoint.dir`` names.

    ``keep`` writes a DataFrame as Parquet there and reads it back, which cuts
    its lineage: a lost executor costs the tasks it ran, not the stages before.
    ``drop`` deletes tables that no later step reads.
    """

    def __init__(self, spark: SparkSession, operator: str):
        small_batches(spark)
        self.spark = spark
        self.root = f"{ensure_checkpoint_dir(spark)}/llm/{operator}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        conf = self.spark.conf
        before = conf.get(SHUFFLE_CLEANUP, None)
        conf.set(SHUFFLE_CLEANUP, "true")  # the table replaces them
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            conf.unset(SHUFFLE_CLEANUP) if before is None else conf.set(SHUFFLE_CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            path.getFileSystem(conf).delete(path, True)


def id_key(col: str) -> Column:
    """The id of any type as text that joins nulls to each other and passes through pandas, where integers with nulls would lose digits.

    Ids are marked by ``=`` in front, so no id looks like the null one.
    """
    return F.coalesce(F.concat(F.lit("="), F.col(col).cast("string")), F.lit(""))


def restored(col: str, like) -> Column:
    """An ``id_key`` column as the id it was, of the type ``like``."""
    return F.when(F.col(col) != "", F.substring(col, 2, 1 << 30)).cast(like).alias(col)


def text_hash(text: str) -> Column:
    """Tells rows that repeat an id with another text apart."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def blocks_for(rows: int, per_block: int = 200_000) -> int:
    return max(1, math.ceil(rows / per_block))


def numbered(df: DataFrame, cls: list[str], order: list, out: str, rows: int) -> DataFrame:
    """Add ``out``: a gapless number from 0 within each ``cls``, although one class may hold most rows.

    A class is cut into hash blocks of about 200,000 rows; blocks are numbered
    on their own and shifted by the rows of the blocks before, so no task
    orders a whole class.  ``order`` must identify a row (ties get any order).
    """
    from pyspark.sql import Window

    n = blocks_for(rows)
    b = df.withColumn("_blk", F.pmod(F.xxhash64(*order), F.lit(n)).cast("int"))
    w = Window.partitionBy(*cls, "_blk").orderBy(*order)
    if n == 1:
        return b.withColumn(out, (F.row_number().over(w) - 1).cast("long")).drop("_blk")
    counts = b.groupBy(*cls, "_blk").agg(F.count(F.lit(1)).alias("_cnt"))
    before = Window.partitionBy(*cls).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*cls, "_blk", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_base"))
    out_rows = b.withColumn("_rn", F.row_number().over(w) - 1)
    return (out_rows.join(counts, [*cls, "_blk"])
            .withColumn(out, (F.col("_rn") + F.col("_base")).cast("long")).drop("_blk", "_rn", "_base"))
