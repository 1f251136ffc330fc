"""Document -> table row (T6): JSON text bound to the target table's schema.

Fields the table does not have are dropped, missing ones are NULL; a text
that is not a JSON object marks the row as failed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.results import ERROR_COL, RAW_COL, SRC_COL, stage_barrier

_CORRUPT = "_corrupt_record"


def document_to_row(df: DataFrame, json_col: str, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    full = T.StructType(list(schema.fields) + [T.StructField(_CORRUPT, T.StringType())])
    parsed = df.select(*(keep or []), F.col(json_col).alias("__doc"),
                       F.from_json(F.col(json_col), full, {"columnNameOfCorruptRecord": _CORRUPT}).alias("__r"))
    r = F.col("__r")
    bad = r.isNull() | r[_CORRUPT].isNotNull()
    return parsed.select(
        *(keep or []), *[r[f.name].alias(f.name) for f in schema.fields],
        F.when(bad, F.lit("not a JSON object")).alias(ERROR_COL), F.col("__doc").alias(RAW_COL),
        F.lit(None).cast("string").alias(SRC_COL), stage_barrier(),
    )
