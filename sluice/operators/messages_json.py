"""JSON messages -> records with a strict bind (M1-M6).

Input: an envelope frame ``payload STRING, attributes MAP<STRING,STRING>``.
The payload must be a JSON object; the attributes overlay its keys
(attributes win); the merged record binds to a target schema as strictly as
a JSON object binder does by default:

* an unknown key (top level or nested) rejects the message;
* a number or boolean where text is expected is accepted as its text;
* an object or array where a scalar is expected rejects the message;
* a non-array where an array is expected rejects the message;
* a missing key or JSON null gives NULL.

Numbers bound to text read as the parser that fed the binder printed them:
integers exactly, other numbers as doubles (``1.50`` -> ``1.5``,
``0.00001`` -> ``1.0E-5``).  Malformed JSON and a missing required attribute
are dead-lettered (the text kept is the payload).  The payload is parsed once
into a VARIANT; checks and values both read it, all JVM-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.results import ERROR_COL, RAW_COL, SRC_COL, first_error, stage_barrier

# The attribute keys every message carries.
ATTRIBUTE_KEYS = ("TopicName", "MessageId", "LogicalDate")

APPOINTMENT_DETAIL = T.StructType([
    T.StructField("AppointmentId", T.StringType()),
    T.StructField("TimestampUtc", T.StringType()),
    T.StructField("Disciplines", T.ArrayType(T.StringType())),
])
APPOINTMENTS = T.StructType([
    T.StructField("Type", T.StringType()),
    T.StructField("Data", T.ArrayType(APPOINTMENT_DETAIL)),
    T.StructField("TopicName", T.StringType()),
    T.StructField("MessageId", T.StringType()),
    T.StructField("LogicalDate", T.StringType()),
])

MALFORMED = "malformed JSON payload"
DUPLICATE_KEYS = "spark.sql.variant.allowDuplicateKeys"


def _is_absent(x: Column) -> Column:
    return x.isNull() | F.is_variant_null(x)


def _as_object(x: Column) -> Column:
    return F.try_variant_get(x, "$", "map<string,variant>")


def _as_array(x: Column) -> Column:
    return F.try_variant_get(x, "$", "array<variant>")


def _is_container(x: Column) -> Column:
    kind = F.schema_of_variant(x)
    return kind.startswith("OBJECT") | kind.startswith("ARRAY")


def _field(x: Column, name: str) -> Column:
    """One field of an object, taken by its path."""
    if "'" in name or "\\" in name:
        return F.element_at(_as_object(x), F.lit(name))
    return F.try_variant_get(x, f"$['{name}']", "variant")


def conforms(x: Column, dtype: T.DataType) -> Column:
    """True when the VARIANT value ``x`` binds to ``dtype`` (NULL/missing binds)."""
    if isinstance(dtype, T.StructType):
        obj = _as_object(x)
        allowed = F.array(*[F.lit(f.name) for f in dtype.fields])
        known = F.size(F.array_except(F.map_keys(obj), allowed)) == 0
        fields = [conforms(_field(x, f.name), f.dataType) for f in dtype.fields]
        ok = obj.isNotNull() & known
        for f_ok in fields:
            ok = ok & f_ok
        return _is_absent(x) | F.coalesce(ok, F.lit(False))
    if isinstance(dtype, T.ArrayType):
        arr = _as_array(x)
        elem_ok = F.forall(arr, lambda e: conforms(e, dtype.elementType))
        return _is_absent(x) | F.coalesce(arr.isNotNull() & elem_ok, F.lit(False))
    if isinstance(dtype, T.MapType):
        obj = _as_object(x)
        vals_ok = F.forall(F.map_values(obj), lambda e: conforms(e, dtype.valueType))
        return _is_absent(x) | F.coalesce(obj.isNotNull() & vals_ok, F.lit(False))
    return _is_absent(x) | ~_is_container(x)


def _text_of(x: Column) -> Column:
    """A scalar as bound text: a fractional or exponent number reads as its double prints."""
    kind = F.schema_of_variant(x)
    fractional = (kind.startswith("DECIMAL") & ~kind.endswith(",0)")) | kind.isin("DOUBLE", "FLOAT")
    return F.when(fractional, F.try_variant_get(x, "$", "double").cast("string")) \
        .otherwise(F.try_variant_get(x, "$", "string"))


def bound_value(x: Column, dtype: T.DataType) -> Column:
    """The value a strict binder produces from VARIANT ``x`` for ``dtype`` (after ``conforms``)."""
    if isinstance(dtype, T.StructType):
        return F.when(F.schema_of_variant(x).startswith("OBJECT"), F.struct(*[
            bound_value(_field(x, f.name), f.dataType).alias(f.name) for f in dtype.fields
        ]))
    if isinstance(dtype, T.ArrayType):
        return F.transform(_as_array(x), lambda e: bound_value(e, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(_as_object(x), lambda k, e: bound_value(e, dtype.valueType))
    if isinstance(dtype, T.StringType):
        return F.when(~_is_absent(x), _text_of(x))
    return F.try_variant_get(x, "$", dtype.simpleString())


def bind_json_messages(
    df: DataFrame,
    schema: T.StructType = APPOINTMENTS,
    payload_col: str = "payload",
    attributes_col: str = "attributes",
    required_attributes: tuple[str, ...] = ATTRIBUTE_KEYS,
    keep: list[str] | None = None,
) -> DataFrame:
    """Parse, merge attributes, bind strictly; adds ``_error``/``_raw``/``_src``."""
    keep = list(keep or [])
    payload = F.col(payload_col)
    attrs = F.coalesce(F.col(attributes_col), F.create_map().cast("map<string,string>"))
    # Parse once into a VARIANT; of a repeated key the last value counts.
    df.sparkSession.conf.set(DUPLICATE_KEYS, "true")
    parsed = df.select(*keep, payload.alias("__payload"), attrs.alias("__attrs"),
                       F.try_parse_json(payload).alias("__v"))
    base = parsed.select(
        *keep, "__payload", "__attrs", "__v",
        F.map_keys(F.try_variant_get(F.col("__v"), "$", "map<string,variant>")).alias("__keys"),
    )
    p, a, v, keys = (F.col(c) for c in ("__payload", "__attrs", "__v", "__keys"))
    allowed = F.array(*[F.lit(f.name) for f in schema.fields])

    errors = [F.when(p.isNull() | keys.isNull(), F.lit(MALFORMED))]
    for k in required_attributes:
        errors.append(F.when(~F.map_contains_key(a, F.lit(k)), F.lit(f"missing attribute {k}")))
    unknown = F.array_except(F.array_union(keys, F.map_keys(a)), allowed)
    errors.append(F.when(F.size(unknown) > 0,
                         F.concat(F.lit('Unrecognized field "'), F.element_at(unknown, 1), F.lit('"'))))
    values = []
    for f in schema.fields:
        from_attr = F.map_contains_key(a, F.lit(f.name))
        attr_val = F.element_at(a, F.lit(f.name))
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            attr_ok = F.lit(False)
            attr_typed = F.lit(None).cast(f.dataType)
        elif isinstance(f.dataType, T.StringType):
            attr_ok = F.lit(True)
            attr_typed = attr_val
        else:
            attr_typed = attr_val.try_cast(f.dataType)
            attr_ok = attr_typed.isNotNull()
        sub = _field(v, f.name)
        payload_ok = conforms(sub, f.dataType)
        bad = F.when(from_attr, ~attr_ok).otherwise(~payload_ok)
        errors.append(F.when(bad, F.lit(f'Cannot bind field "{f.name}" to {f.dataType.simpleString()}')))
        values.append(F.when(from_attr, attr_typed).otherwise(bound_value(sub, f.dataType)).alias(f.name))
    error = first_error(errors)
    src = F.element_at(a, F.lit("MessageId")) if "MessageId" in required_attributes else F.lit(None).cast("string")
    return base.select(*keep, *values, error.alias(ERROR_COL), p.alias(RAW_COL), src.alias(SRC_COL), stage_barrier())
