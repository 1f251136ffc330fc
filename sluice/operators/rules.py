"""Ordered update rules over records (T4) and derived fields (T5).

A rule is ``{location, operation}``: ``location`` is a JSON pointer into the
record, ``operation`` a field operation.  Rules run in order and each sees the
results of the earlier ones.  The result is written at the root under the
pointer's last segment (a nested read, a root write).  An absent location
skips the rule; a NULL value stays NULL; a failing operation sends the whole
record, as it was before any rule, to the dead-letter store.

Each rule compiles to two narrow projections; there is no shuffle and no
Python on the data path.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.fieldops import apply_plans, plan_op, result_type
from sluice.functions.spec import parse_field_spec
from sluice.operators.results import (
    BARRIER_COL, ERROR_COL, INTERNAL_COLS, RAW_COL, SRC_COL, first_error, stage_barrier,
)

_ERR = "__rule_err"


@dataclass(frozen=True)
class Rule:
    location: str
    operation: str


def parse_rules(items: Iterable[Mapping[str, str] | Rule]) -> list[Rule]:
    out = []
    for item in items:
        if isinstance(item, Rule):
            out.append(item)
        else:
            out.append(Rule(str(item["location"]), str(item["operation"])))
    return out


def pointer_segments(location: str) -> list[str] | None:
    """JSON pointer -> segments; None when it is not a pointer (no leading '/')."""
    if location == "":
        return []
    if not location.startswith("/"):
        return None
    return [seg.replace("~1", "/").replace("~0", "~") for seg in location[1:].split("/")]


def resolve(schema: T.StructType, segments: list[str]) -> tuple[Column, T.DataType, Column] | None:
    """Column, type and per-row presence at a pointer; None when no row can have it.

    A location under a NULL record, past the end of an array or under a
    missing map key is absent for that row (the rule then leaves the row
    alone), while a NULL value at the location itself is present.
    """
    if not segments:
        return None
    names = {f.name: f for f in schema.fields}
    first = names.get(segments[0])
    if first is None:
        return None
    col: Column = F.col(f"`{first.name}`")
    dtype = first.dataType
    present: Column = F.lit(True)
    for seg in segments[1:]:
        if isinstance(dtype, T.StructType):
            match = next((f for f in dtype.fields if f.name == seg), None)
            if match is None:
                return None
            present = present & col.isNotNull()
            col, dtype = col.getField(match.name), match.dataType
        elif isinstance(dtype, T.ArrayType) and seg.isdigit() and (seg == "0" or not seg.startswith("0")):
            present = present & col.isNotNull() & (F.size(col) > int(seg))
            col, dtype = F.get(col, int(seg)), dtype.elementType
        elif isinstance(dtype, T.MapType) and isinstance(dtype.keyType, T.StringType):
            present = present & col.isNotNull() & F.coalesce(F.map_contains_key(col, F.lit(seg)), F.lit(False))
            col, dtype = F.try_element_at(col, F.lit(seg)), dtype.valueType
        else:
            return None
    return col, dtype, present


def as_text(col: Column, dtype: T.DataType) -> Column:
    """The node's text: scalars print, containers give '' (so they turn NULL)."""
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.when(col.isNotNull(), F.lit(""))
    if isinstance(dtype, T.BooleanType):
        return F.when(col, F.lit("true")).when(~col, F.lit("false"))
    return col.cast("string")


def _record_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in INTERNAL_COLS]


def _target(location: str) -> str:
    """The field a rule writes: the pointer's last segment as it stands, escapes and all."""
    return location.rsplit("/", 1)[-1]


def _is_invalid(rule: Rule) -> bool:
    return pointer_segments(rule.location) is None


def _stages(rules: list[Rule]) -> list[list[Rule]]:
    """Group consecutive rules that can run in one projection.

    A rule starts a new stage when it reads, or writes, a field that an
    earlier rule of the current stage writes, so every rule still sees the
    results of all rules before it.
    """
    stages: list[list[Rule]] = []
    written: set[str] = set()
    for rule in rules:
        segments = pointer_segments(rule.location) or []
        reads = segments[0] if segments else None
        target = _target(rule.location) if segments else None
        if not stages or reads in written or target in written:
            stages.append([])
            written = set()
        stages[-1].append(rule)
        if target:
            written.add(target)
    return stages


def apply_rules(df: DataFrame, rules: Iterable[Mapping[str, str] | Rule], *, compat: bool = False) -> DataFrame:
    """Apply rules in order; adds ``_error`` and ``_raw`` (the record as JSON text).

    ``compat=True`` keeps the quirk where INTEGER, DOUBLE, FLOAT, BIGINT and
    BIGDECIMAL results are written as NULL.  The record's schema is tracked
    on the driver as rules rewrite fields, so building the plan costs two
    projections per rule and no re-analysis.
    """
    rules = parse_rules(rules)
    record = _record_columns(df)
    src = F.col(SRC_COL) if SRC_COL in df.columns else F.lit(None).cast("string")
    prior = F.col(ERROR_COL) if ERROR_COL in df.columns else F.lit(None).cast("string")
    cur = df.select(
        *[F.col(f"`{c}`") for c in record],
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in record]), {"ignoreNullFields": "false"}).alias(RAW_COL),
        src.alias(SRC_COL),
        prior.alias(_ERR),
    )
    fields = {f.name: f.dataType for f in df.schema.fields if f.name in record}
    order = list(record)
    for stage in _stages(rules):
        schema = T.StructType([T.StructField(n, fields[n]) for n in order])
        items, targets, invalid = [], [], []
        for rule in stage:
            segments = pointer_segments(rule.location)
            if segments is None:
                invalid.append(F.lit(f"Invalid input: JSON Pointer expression must start with '/': \"{rule.location}\""))
                items.append(None)
                continue
            found = resolve(schema, segments)
            if found is None:
                items.append(None)
                continue
            value_col, dtype, present = found
            text = as_text(value_col, dtype)
            items.append((text, plan_op(rule.operation, text, compat=compat, name="")))
            targets.append((_target(rule.location), rule.operation, present))
        live = [it for it in items if it is not None]
        if not live and not invalid:
            continue
        staged, values, errors = apply_plans(cur, live, order + [RAW_COL, SRC_COL, _ERR])
        # Errors in rule order (an invalid pointer fails where it stands).
        ordered_errors, k, m = [], 0, 0
        for it in items:
            if it is None:
                if m < len(invalid) and _is_invalid(stage[len(ordered_errors)]):
                    ordered_errors.append(invalid[m])
                    m += 1
                else:
                    ordered_errors.append(None)
            else:
                ordered_errors.append(F.when(targets[k][2], errors[k]))
                k += 1
        new_values = {}
        for (target, op, present), value, (_, plan) in zip(targets, values, live):
            new_type = T._parse_datatype_string(plan.nulled_type or result_type(op))
            # Where the location is absent the row keeps what it had (NULL for a new field).
            before = F.col(f"`{target}`").try_cast(new_type) if target in fields else F.lit(None).cast(new_type)
            new_values[target] = F.when(present, value).otherwise(before)
            if target not in fields:
                order.append(target)
            fields[target] = new_type
        out = [new_values[c].alias(c) if c in new_values else F.col(f"`{c}`") for c in order]
        err = first_error([F.col(_ERR)] + [e for e in ordered_errors if e is not None])
        cur = staged.select(*out, F.col(RAW_COL), F.col(SRC_COL), err.alias(_ERR))
    return cur.select(
        *[F.col(f"`{c}`") for c in order],
        F.col(_ERR).alias(ERROR_COL), F.col(RAW_COL), F.col(SRC_COL), stage_barrier(),
    )


def derive_field(df: DataFrame, new_field: str, target_spec: str) -> DataFrame:
    """T5: ``new_field`` = the operation of ``name:OP(arg)`` applied to field ``name``.

    NULL input gives NULL; a failing value marks the record as failed.
    """
    spec = parse_field_spec(target_spec)
    if spec.problem:
        raise ValueError(spec.problem)
    if spec.name not in df.columns:
        raise ValueError(f"no field {spec.name!r} to derive {new_field!r} from")
    text = F.col(f"`{spec.name}`").cast("string")
    plan = plan_op(spec.op, text, name=spec.name)
    carry = [c for c in df.columns if c not in (new_field, BARRIER_COL)]
    staged, values, errors = apply_plans(df, [(text, plan)], carry)
    prior = F.col(ERROR_COL) if ERROR_COL in df.columns else F.lit(None).cast("string")
    keep = [F.col(f"`{c}`") for c in carry if c != ERROR_COL]
    return staged.select(*keep, values[0].alias(new_field), first_error([prior, errors[0]]).alias(ERROR_COL),
                         stage_barrier())
