"""Reading the driver's parquet tables with enough parallelism for CPU-heavy work.

A parquet file is split by row group, so a table stored as one file with one
row group is read by a single task however many cores there are.  When the
scan cannot yield at least one split per core (few files, few row groups:
checked from the file footers, a metadata read bounded by the core count),
the rows are redistributed once after the scan, hash-partitioned on a row id
(``monotonically_increasing_id``: unique per row, so even many identical
copies spread evenly; a re-read of the same split gives the same ids, so a
retried task sends each row where it went before; no sort is needed).  Large tables
with many files or row groups are left exactly as scanned: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _row_groups(spark: SparkSession, path: str, enough: int) -> int:
    """Row groups under ``path``, counted in file footers on whatever store it is in, up to ``enough``."""
    jvm = spark._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    files, groups = hpath.getFileSystem(conf).listFiles(hpath, True), 0
    while groups < enough and files.hasNext():
        file = files.next().getPath()
        if not file.getName().startswith(("_", ".")):
            footer = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
                jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(file, conf))
            try:
                groups += footer.getRowGroups().size()
            finally:
                footer.close()
    return groups


def read_table(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if _row_groups(spark, path, cores) >= cores:
        return df
    return df.repartition(cores, F.monotonically_increasing_id())
