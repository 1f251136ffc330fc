"""The one result shape: typed columns plus ``_error``, ``_raw`` and ``_src``.

``_error`` is NULL for a good record and the failure reason otherwise;
``_raw`` is the text that goes to the dead-letter store; ``_src`` is the
lineage source (file path or message id).  ``good_rows`` and ``bad_rows`` are the
only places where a plan branches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERROR_COL = "_error"
RAW_COL = "_raw"
SRC_COL = "_src"
BARRIER_COL = "_stage"
INTERNAL_COLS = (ERROR_COL, RAW_COL, SRC_COL, BARRIER_COL)

ROW_ID_COL = "bq_row_id"
ROW_SRC_COL = "bq_row_src"


def first_error(errors: list[Column]) -> Column:
    """The first non-NULL error in order (a record fails at its first bad field)."""
    if not errors:
        return F.lit(None).cast("string")
    if len(errors) == 1:
        return errors[0]
    return F.coalesce(*errors)



def stage_barrier() -> Column:
    """A cheap non-deterministic column for the projection that computes ``_error``.

    Catalyst pushes a filter through a projection by inlining the projected
    expressions; for ``_error IS NULL`` that would copy every parse into the
    filter and evaluate it twice.  A projection holding a non-deterministic
    expression is not pushed through, and referencing this column in the
    split filter keeps it from being pruned.
    """
    return F.spark_partition_id().alias(BARRIER_COL)


def _status(df: DataFrame, good: bool) -> Column:
    cond = F.col(ERROR_COL).isNull() if good else F.col(ERROR_COL).isNotNull()
    if BARRIER_COL in df.columns:
        cond = cond & (F.col(BARRIER_COL) >= 0)
    return cond


def good_rows(df: DataFrame) -> DataFrame:
    return df.filter(_status(df, True)).drop(*[c for c in INTERNAL_COLS if c in df.columns])


def bad_rows(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Dead-letter records: ``value`` (text), ``error`` (reason), ``source``."""
    src = F.col(SRC_COL) if SRC_COL in df.columns else F.lit(None).cast("string")
    return df.filter(_status(df, False)).select(
        F.col(RAW_COL).alias("value"), F.col(ERROR_COL).alias("error"), src.alias("source"),
        *[F.col(c) for c in (keep or [])],
    )

