"""Delimited lines -> typed rows (header/trailer filter, split, arity, typing).

Input: a frame with a text ``line`` column, optionally a per-row ``file date``
column (from the path, appended as one extra last cell when non-empty) and a
source column.  Output: one column per header spec plus ``_error``, ``_raw``
and ``_src``.  Everything is a narrow projection: no shuffle, and the CSV
split runs inside the executor's expression evaluation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.fieldops import apply_plans, plan_spec
from sluice.functions.spec import FieldSpec, parse_header_list
from sluice.operators.results import ERROR_COL, RAW_COL, SRC_COL, first_error, stage_barrier

# The error text of a wrong cell count.
ARITY_ERROR = "File schema doesn't match with number of columns within the line"
_CORRUPT = "_corrupt"
# Separators (quoted ones too) from which on a line is not split but fails the cell count.
MAX_CELLS = 1 << 16


def full_match(line: Column, regex: str) -> Column:
    """Java ``String.matches``: the whole line must match."""
    return line.rlike(r"\A(?:" + regex + r")\z")


def drop_header_trailer(
    df: DataFrame, header_regex: str | None, trailer_regex: str | None, line_col: str = "line"
) -> DataFrame:
    """Drop every line that fully matches the header or the trailer regex.

    An empty regex fully matches only the empty line, so it drops blank lines.
    ``None`` disables that side.
    """
    conds = [full_match(F.col(line_col), rx) for rx in (header_regex, trailer_regex) if rx is not None]
    if not conds:
        return df
    drop = conds[0] if len(conds) == 1 else (conds[0] | conds[1])
    return df.filter(~drop)


def csv_options(splitter: str) -> dict[str, str]:
    """Split settings: delimiter is the first character of ``splitter``.

    Unquoted cells are trimmed, ``""`` escapes a quote, ``#`` is data, and cell
    length is unlimited (a limit makes the parser raise instead of failing
    the record).
    """
    if not splitter:
        raise ValueError("splitter must not be empty")
    return {
        "sep": splitter[0],
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": "true",
        "ignoreTrailingWhiteSpace": "true",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
        "maxColumns": str(MAX_CELLS),
    }


def _csv_struct(line: Column, width: int, splitter: str) -> Column:
    """The split line; NULL (a wrong count) for one with too many separators for the parser, which would raise."""
    if width >= MAX_CELLS:
        raise ValueError(f"more than {MAX_CELLS - 1} columns are not supported")
    schema = ", ".join(f"c{i} string" for i in range(width)) + f", {_CORRUPT} string"
    separators = F.length(line) - F.length(F.replace(line, F.lit(splitter[0]), F.lit("")))
    # A short line can't have too many: they are counted in long ones only.
    few = (F.octet_length(line) < MAX_CELLS - 1) | (separators < MAX_CELLS - 1)
    return F.when(few, F.from_csv(line, schema, csv_options(splitter)))


def _cells_of(parsed: Column, width: int) -> list[Column]:
    return [F.coalesce(parsed[f"c{i}"], F.lit("")) for i in range(width)]


def _wrong_count(parsed: Column | None, line: Column) -> Column:
    # A blank line has no cells at all; the parser reports it as all-NULL.
    if parsed is None:
        return line != ""
    return parsed.isNull() | parsed[_CORRUPT].isNotNull() | (line == "")


def parse_delimited(
    df: DataFrame,
    headers: str | list[FieldSpec],
    splitter: str = ",",
    line_col: str = "line",
    date_col: str | None = None,
    src_col: str | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Split each line, check the cell count, type every cell by its spec.

    With ``date_col`` a non-empty file date is appended as the last cell, so
    the line itself must hold one cell fewer than there are specs.
    """
    specs = parse_header_list(headers) if isinstance(headers, str) else list(headers)
    n = len(specs)
    keep = list(keep or [])
    src = F.col(src_col) if src_col else F.lit(None).cast("string")
    line = F.col(line_col)

    # Stage 0: split each line exactly once.
    if date_col is None:
        no_date = F.lit(False)
        base = df.select(*keep, line.alias("__line"), F.lit("").alias("__date"), src.alias("__src"),
                         no_date.alias("__no_date"),
                         (_csv_struct(line, n, splitter) if n else F.lit(None)).alias("__cells"))
        cells = _cells_of(F.col("__cells"), n)
        wrong = _wrong_count(F.col("__cells") if n else None, F.col("__line"))
        raw_arity = F.col("__line")
    else:
        k = max(n - 1, 0)
        base = df.select(*keep, line.alias("__line"), F.coalesce(F.col(date_col), F.lit("")).alias("__date"),
                         src.alias("__src"), F.col(date_col).isNull().alias("__no_date"),
                         (_csv_struct(line, k, splitter) if k else F.lit(None)).alias("__cells"))
        ln, date = F.col("__line"), F.col("__date")
        has_date = date != ""
        short_cells = _cells_of(F.col("__cells"), k) + [date]
        # Rare: the path regex matched an empty date, so nothing is appended
        # and the line must hold all n cells (parsed only for such rows).
        full = _csv_struct(ln, n, splitter) if n else None
        full_cells = _cells_of(full, n) if n else []
        cells = [F.when(has_date, c).otherwise(fc) for c, fc in zip(short_cells[:n], full_cells)]
        short_wrong = _wrong_count(F.col("__cells") if k else None, ln) if n else F.lit(True)
        wrong = F.when(has_date, short_wrong).otherwise(_wrong_count(full, ln))
        raw_arity = F.when(has_date, F.concat(ln, F.lit(","), date)).otherwise(ln)

    texts = base.select(
        *keep, "__src", "__no_date",
        wrong.alias("__wrong"), raw_arity.alias("__raw_arity"),
        *[c.alias(f"__t{i}") for i, c in enumerate(cells)],
    )
    items = [(F.col(f"__t{i}"), plan_spec(spec, F.col(f"__t{i}"))) for i, spec in enumerate(specs)]
    passthrough = keep + ["__src", "__no_date", "__wrong", "__raw_arity"] + [f"__t{i}" for i in range(n)]
    staged, values, errors = apply_plans(texts, items, passthrough)

    wrong_c = F.col("__wrong")
    # A path without a date (when such rows are kept) is the first reason.
    error = (F.when(F.col("__no_date"), F.concat(F.lit("no date in path: "), F.coalesce(F.col("__src"), F.lit(""))))
             .when(wrong_c, F.lit(ARITY_ERROR)).otherwise(first_error(errors)))
    joined = F.concat_ws(",", *[F.col(f"__t{i}") for i in range(n)]) if n else F.lit("")
    raw = F.when(wrong_c, F.col("__raw_arity")).otherwise(joined)

    # A name given twice keeps its last value, as a keyed row would.
    last_index = {spec.name: i for i, spec in enumerate(specs)}
    out = [values[i].alias(name) for name, i in last_index.items()]
    return staged.select(*keep, *out, error.alias(ERROR_COL), raw.alias(RAW_COL), F.col("__src").alias(SRC_COL),
                         stage_barrier())
