"""Field operations: ``(text, OP(arg)) -> (typed value, error)`` as Spark columns.

One compiler serves both callers: delimited headers (``Name:OP(arg)``) and
update rules (``OP(arg)``).  Each operation is compiled once on the driver into
built-in column expressions (no Python UDF), so the work stays inside
whole-stage codegen on the executors.

Semantics that decide results:

* An empty or NULL input gives NULL for every operation, checked before the
  operation name (so an unsupported operation fails only non-empty values).
* Operation names are matched in a fixed order; the date/time names match by
  prefix, so ``DATETIME(p)`` behaves as ``DATE(p)``.
* Numbers follow Java's parsers, which are stricter than Spark's casts (no
  blanks around integers, no ``nan``/``inf`` spellings), so every cast has a
  guard.
* Date/time results are ISO text.  Timestamps print in the shortest ISO form:
  seconds are omitted when zero and the fraction has 3 or 6 digits.
* Errors read ``failed at field: <name>, trace:<reason>``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.patterns import PatternInfo, classify
from sluice.functions.spec import FieldSpec, parse_operation

# Operation names matched exactly, then the ones matched by prefix,
# each list in the order they are tried.
EXACT_OPS = ["STRING", "INTEGER", "DOUBLE", "int2bigDecimal", "FLOAT", "LONG", "BIGINT", "BIGDECIMAL"]
PREFIX_OPS = [
    "TIMESTAMP", "DATE", "PRECISION", "UTC_TIMESTAMP", "TIME",
    "TRANSFORM_TIMESTAMP_TO_DATE", "TRANSFORM_UTC_TIMESTAMP_TO_DATE",
]
# Operations whose result an update rule keeps only in compat mode as NULL.
RULE_NULLED_OPS = {"INTEGER", "DOUBLE", "FLOAT", "BIGINT", "BIGDECIMAL"}

# The error texts here and in the messages below.
UNSUPPORTED = "Data type not supported"
INT_RX = r"^[+-]?[0-9]+\z"
DECIMAL_RX = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
PLAIN_RX = r"^(?:-?[1-9][0-9]*+|0)(?:\.[0-9]++)?\z"
ZERO_RX = r"^[+-]?(0+\.?0*|\.0+)([eE][+-]?[0-9]+)?\z"
JAVA_SPECIAL_RX = r"^[\x00-\x20]*[+-]?(NaN|Infinity)[\x00-\x20]*\z"
SPARK_SPECIAL_RX = r"^[\x00-\x20]*[+-]?(nan|inf|infinity)[\x00-\x20]*\z"
BIGDECIMAL_SCALE = 18
MAX_PLAIN_SCALE = 1_000_000
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")
"""HotSpot never compiles a longer method; Spark then runs a projection in many small ones instead of a single long one."""

ISO_MINUTE = "yyyy-MM-dd'T'HH:mm"
ISO_SECOND = "yyyy-MM-dd'T'HH:mm:ss"
ISO_MILLI = "yyyy-MM-dd'T'HH:mm:ss.SSS"
ISO_MICRO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


@dataclass(frozen=True)
class Typed:
    """A compiled operation: ``value`` is NULL whenever ``error`` is set."""

    value: Column
    error: Column


def _identity(c: Column) -> Column:
    return c


@dataclass(frozen=True)
class OpPlan:
    """An operation split into stages so heavy work runs once per row.

    ``parse`` (over the input text) is projected first, then each of ``steps``
    over the result before it (NULL stays NULL); ``finish`` turns a reference
    to the last one into the value; the error is derived afterwards from a
    NULL value, so no parse is repeated for the error text.
    """

    parse: Column
    finish: Callable[[Column], Column] = _identity
    reason: Column | None = None       # why a non-empty value failed
    always_fails: bool = False         # fails every value, empty or not
    nulled_type: str | None = None     # compat: result replaced by NULL of this type
    steps: tuple[Callable[[Column], Column], ...] = ()

    def error(self, text: Column, parsed: Column) -> Column:
        """Failure text given the input and a reference to the parse result.

        ``finish`` never turns a non-NULL parse into NULL, so a NULL parse of
        a non-empty input is exactly a failure.
        """
        if self.always_fails:
            return self.reason
        if self.reason is None:
            return F.lit(None).cast("string")
        return F.when(text.isNotNull() & (text != "") & parsed.isNull(), self.reason)

    def value(self, parsed: Column) -> Column:
        return F.lit(None).cast(self.nulled_type) if self.nulled_type else self.finish(parsed)

    def inline(self, text: Column) -> Typed:
        """Single-expression form (the parse may be evaluated more than once)."""
        parsed = self.parse
        for step in self.steps:
            parsed = _let(parsed, step)
        value = _let(parsed, self.finish) if self.steps else self.finish(parsed)
        error = self.error(text, parsed)
        if self.nulled_type:
            value = F.lit(None).cast(self.nulled_type)
        return Typed(value, error)


def resolve_kind(op: str) -> str | None:
    """The operation an op text dispatches to, or None when unsupported."""
    if op in EXACT_OPS:
        return op
    for prefix in PREFIX_OPS:
        if op.startswith(prefix) and "\n" not in op:
            return prefix
    return None


def result_type(op: str) -> str:
    kind = resolve_kind(op)
    return {
        "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float", "LONG": "bigint",
        "BIGINT": "decimal(38,0)", "BIGDECIMAL": f"decimal(38,{BIGDECIMAL_SCALE})",
    }.get(kind or "", "string")


# ---------------------------------------------------------------- messages
# The wording of these errors.

def number_error(text: Column) -> Column:
    return F.concat(F.lit('For input string: "'), text, F.lit('"'))


def datetime_error(text: Column) -> Column:
    return F.concat(F.lit("Text '"), text, F.lit("' could not be parsed"))


def field_error(name: str, reason: Column) -> Column:
    return F.concat(F.lit(f"failed at field: {name}, trace:"), reason)


# ---------------------------------------------------------------- numbers

def _present(text: Column) -> Column:
    return text.isNotNull() & (text != "")


def _integral(text: Column, spark_type: str) -> OpPlan:
    parsed = F.when(text.rlike(INT_RX), text.try_cast(spark_type))
    return OpPlan(parsed, reason=number_error(text))


def _floating(text: Column, spark_type: str) -> OpPlan:
    # Spark also reads 'nan', 'inf', 'infinity' in any case; Java reads only
    # 'NaN' and 'Infinity'.  Only a NaN or infinite result needs the check.
    parsed = text.try_cast(spark_type)
    special = F.isnan(parsed) | (F.abs(parsed) == F.lit(float("inf")))
    java_ok = ~F.lower(text).rlike(SPARK_SPECIAL_RX) | text.rlike(JAVA_SPECIAL_RX)
    return OpPlan(F.when(~special | java_ok, parsed), reason=number_error(text))


def _big_decimal(text: Column, scale: int) -> OpPlan:
    """A number that the typed column holds exactly; one with more digits fails instead of being rounded."""
    def cast(p: Column) -> Column:
        zeros = F.length(p["digits"]) - F.length(F.rtrim(p["digits"], F.lit("0")))
        exact = F.coalesce((F.abs(p["scale"]) <= MAX_PLAIN_SCALE) & (p["scale"] - zeros <= scale), F.lit(False))
        is_zero = p["digits"] == ""
        # A zero is cast as '0' (Spark rejects e.g. '0e38').
        number = F.when(is_zero, F.lit("0")).when(exact, p["text"])
        return number.try_cast(f"decimal(38,{scale})")

    too_wide = F.concat(F.lit('Value does not fit DECIMAL(38,%d): "' % scale), text, F.lit('"'))
    reason = F.when(text.rlike(DECIMAL_RX), too_wide).otherwise(number_error(text))
    return OpPlan(_mantissa_and_exponent(text), reason=reason, steps=(lambda p: _decimal_parts(p, p["text"].alias("text")), cast))


def _around_e(text: Column) -> tuple[Column, Column]:
    """What comes before a decimal's exponent, and that exponent (NULL beyond an int)."""
    lowered = F.replace(text, F.lit("E"), F.lit("e"))
    exponent = F.when(F.contains(lowered, F.lit("e")), F.substring_index(lowered, "e", -1).try_cast("int")).otherwise(F.lit(0))
    return F.substring_index(lowered, "e", 1).alias("mantissa"), exponent.cast("bigint").alias("exponent")


def _mantissa_and_exponent(text: Column) -> Column:
    """The text of a valid decimal, what comes before its exponent, and that exponent (NULL beyond an int)."""
    return F.when(text.rlike(DECIMAL_RX), F.struct(text.alias("text"), *_around_e(text)))


def _plain_or_parts(text: Column, may_be_plain: bool = True) -> Column:
    """A plain decimal without needless zeros in front, as it is, with the place of its point (0: none); a ``_mantissa_and_exponent`` of any other."""
    plain = F.lit(may_be_plain) & (F.octet_length(text) <= MAX_PLAIN_SCALE) & text.rlike(PLAIN_RX)
    none = F.lit(None)
    as_is = F.struct(text.alias("plain"), F.instr(text, ".").alias("point"), none.cast("string").alias("mantissa"), none.cast("bigint").alias("exponent"))
    return F.when(plain, as_is).when(text.rlike(DECIMAL_RX), F.struct(
        none.cast("string").alias("plain"), none.cast("int").alias("point"), *_around_e(text)))


def _decimal_parts(p: Column, *more: Column) -> Column:
    """Sign, digits from the first that is not zero, and scale of a ``_mantissa_and_exponent``."""
    unsigned = F.ltrim(p["mantissa"], F.lit("+-"))
    fraction = F.when(F.contains(unsigned, F.lit(".")), F.length(unsigned) - F.instr(unsigned, ".")).otherwise(F.lit(0))
    return F.when(p.isNotNull(), F.struct(
        F.startswith(p["mantissa"], F.lit("-")).alias("negative"),
        F.ltrim(F.replace(unsigned, F.lit("."), F.lit("")), F.lit("0")).alias("digits"),
        (fraction - p["exponent"]).alias("scale"), *more))


def _parts_unless_plain(p: Column) -> Column:
    """``plain`` where the text is settled, else the ``_decimal_parts``."""
    none = F.lit(None)
    settled = F.struct(none.cast("boolean").alias("negative"), none.cast("string").alias("digits"), none.cast("bigint").alias("scale"), p["plain"].alias("plain"))
    return F.when(p["plain"].isNotNull(), settled).otherwise(_decimal_parts(p, none.cast("string").alias("plain")))


def _printable(p: Column) -> Column:
    """Parts to be printed; an exponent beyond the limit would print as megabytes of zeros: the value fails."""
    usable = F.coalesce(p["plain"].isNotNull() | (F.abs(p["scale"]) <= MAX_PLAIN_SCALE), F.lit(False))
    return F.when(usable, F.struct(p["plain"].alias("plain"), p["negative"].alias("negative"), p["digits"].alias("digits"),
                                   p["scale"].cast("int").alias("scale")))


def _plain_from_parts(parts: Column) -> Column:
    scale, unscaled = parts["scale"], parts["digits"]
    is_zero = unscaled == ""
    neg = F.when(parts["negative"], F.lit("-")).otherwise(F.lit(""))
    return (
        F.when(parts["plain"].isNotNull(), parts["plain"])
        .when(is_zero & (scale <= 0), F.lit("0"))
        .when(is_zero, F.concat(F.lit("0."), F.repeat(F.lit("0"), scale)))
        .when(scale <= 0, F.concat(neg, unscaled, F.repeat(F.lit("0"), -scale)))
        .otherwise(_pointed(neg, unscaled, scale))
    )


def _pointed(neg: Column, digits: Column, scale: Column) -> Column:
    """Digits with a point before the last ``scale`` (above 0) of them."""
    whole = F.octet_length(digits) - scale
    return (F.when(whole > 0, F.concat(neg, F.substring(digits, F.lit(1), whole), F.lit("."), F.substring(digits, whole + 1, scale)))
            .otherwise(F.concat(neg, F.lit("0."), F.repeat(F.lit("0"), -whole), digits)))


def plain_decimal_text(text: Column) -> OpPlan:
    """Decimal text -> plain text with the scale the text implies.

    ``1E3`` -> ``1000``, ``1.50`` -> ``1.50``, ``.5`` -> ``0.5``,
    ``1.50E1`` -> ``15.0``, ``-0.0`` -> ``0.0``.  Built from string functions so
    it has no precision limit; the text is taken apart once (parse stage and
    steps) and put back together from those parts (finish stage).
    """
    return OpPlan(_plain_or_parts(text), _plain_from_parts, number_error(text), steps=(_parts_unless_plain, _printable))


def _java_int(text: str) -> int | None:
    import re

    if not re.fullmatch(r"[+-]?[0-9]+", text):
        return None
    v = int(text)
    return v if -(2**31) <= v < 2**31 else None


def _precision(text: Column, arg: str) -> OpPlan:
    scale = _java_int(arg)
    if scale is None:
        return _always_fail(F.lit(f'For input string: "{arg}"'))
    if abs(scale) > MAX_PLAIN_SCALE:
        return _always_fail(F.lit(f"scale {scale} is not supported"))
    return OpPlan(_plain_or_parts(text, scale >= 0), lambda p: _plain_at(p, scale), number_error(text),
                  steps=(lambda p: _plain_cut_at(p, scale), lambda p: _cut_at(p, scale), _rounded_up))


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` refers to it."""
    return F.element_at(F.transform(F.array(value), lambda x: use(x)), 1)


# HALF_UP at ``to`` decimals as plain text, by string arithmetic on the digits (no precision limit).
# A plain decimal is cut behind the last digit kept, and one is added there if need be.  Of any other text
# the digits are cut, one is added if need be, and the point is put in.

def _plain_cut_at(p: Column, to: int) -> Column:
    """``plain`` down to ``to`` decimals, with what is left of it without nines at its end as ``head`` where one is added; the parts of any other."""
    text, point = p["plain"], p["point"]
    scale = F.when(point == 0, F.lit(0)).otherwise(F.octet_length(text) - point)
    kept = F.substring(text, F.lit(1), point + to if to > 0 else point - 1)
    up = F.substring(text, point + (to + 1), F.lit(1)) >= "5"
    zeros = F.concat(text, F.when((point == 0) & F.lit(to > 0), F.lit(".")).otherwise(F.lit("")), F.repeat(F.lit("0"), F.lit(to) - scale))
    none = F.lit(None)
    cut = F.struct(none.cast("boolean").alias("negative"), none.cast("string").alias("digits"), none.cast("bigint").alias("scale"),
                   F.when(scale > to, kept).otherwise(zeros).alias("plain"),
                   F.when((scale > to) & up, F.rtrim(kept, F.lit("9."))).alias("head"))
    return F.when(text.isNotNull(), cut).otherwise(_decimal_parts(p, none.cast("string").alias("plain"), none.cast("string").alias("head")))


def _plus_one(number: Column) -> Column:
    n = F.octet_length(number)
    last = F.substring(number, n, F.lit(1))
    return F.concat(F.substring(number, F.lit(1), n - 1), (last.cast("int") + 1).cast("string"))


def _cut_at(p: Column, to: int) -> Column:
    """``plain`` with one added; of parts, the digits down to ``to`` decimals after a zero, and whether the first one dropped is 5 or more."""
    plain, head = p["plain"], p["head"]
    raised = F.when(head.isin("", "-"), F.concat(head, F.lit("1"))).otherwise(_plus_one(head))
    nines = F.substring(plain, F.octet_length(head) + 1, F.octet_length(plain))
    settled = F.when(head.isNull(), plain).otherwise(F.concat(raised, F.replace(nines, F.lit("9"), F.lit("0"))))
    # ``cut`` digits are dropped, or zeros added when it is negative.
    usable = F.coalesce(F.abs(p["scale"]) <= MAX_PLAIN_SCALE, F.lit(False))
    digits, cut = p["digits"], p["scale"].cast("int") - to
    left = F.octet_length(digits) - cut
    kept = F.concat(F.lit("0"), F.substring(digits, F.lit(1), left), F.repeat(F.lit("0"), -cut))
    up = (left >= 0) & (F.substring(digits, left + 1, F.lit(1)) >= "5")
    none = F.lit(None)
    return F.when(plain.isNotNull(), F.struct(settled.alias("plain"), none.cast("boolean").alias("negative"), none.cast("string").alias("kept"), none.cast("boolean").alias("up"))).when(
        usable, F.struct(none.cast("string").alias("plain"), p["negative"].alias("negative"), kept.alias("kept"), up.alias("up")))


def _rounded_up(p: Column) -> Column:
    kept = p["kept"]
    # Adding one turns the nines at the end into zeros; the zero in front keeps a digit before them.
    head = F.rtrim(kept, F.lit("9"))
    carried = F.concat(_plus_one(head), F.repeat(F.lit("0"), F.length(kept) - F.length(head)))
    whole = F.when(~p["up"], kept).when(F.endswith(kept, F.lit("9")), carried).otherwise(_plus_one(kept))
    settled = F.struct(p["plain"].alias("plain"), F.lit(None).cast("boolean").alias("negative"), F.lit(None).cast("string").alias("digits"))
    return F.when(p["plain"].isNotNull(), settled).when(p.isNotNull(), F.struct(
        F.lit(None).cast("string").alias("plain"), p["negative"].alias("negative"), F.ltrim(whole, F.lit("0")).alias("digits")))


def _plain_at(p: Column, to: int) -> Column:
    digits = p["digits"]
    neg = F.when(p["negative"] & (digits != ""), F.lit("-")).otherwise(F.lit(""))
    if to <= 0:
        printed = F.when(digits == "", F.lit("0")).otherwise(F.concat(neg, digits, F.repeat(F.lit("0"), F.lit(-to))))
    else:
        printed = _pointed(neg, digits, F.lit(to))
    return F.when(p["plain"].isNotNull(), p["plain"]).otherwise(printed)


# ---------------------------------------------------------------- date / time

def iso_local_datetime(ts: Column) -> Column:
    """Shortest ISO text of a TIMESTAMP_NTZ value (minutes, seconds, 3 or 6 digits)."""
    micros = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return (
        F.when(ts.isNull(), F.lit(None).cast("string"))
        .when(micros == 0, F.date_format(ts, ISO_MINUTE))
        .when(micros % 1_000_000 == 0, F.date_format(ts, ISO_SECOND))
        .when(micros % 1_000 == 0, F.date_format(ts, ISO_MILLI))
        .otherwise(F.date_format(ts, ISO_MICRO))
    )


def iso_local_time(ts: Column) -> Column:
    """Shortest ISO text of the time part of a TIMESTAMP_NTZ value."""
    micros = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return (
        F.when(ts.isNull(), F.lit(None).cast("string"))
        .when(micros == 0, F.date_format(ts, "HH:mm"))
        .when(micros % 1_000_000 == 0, F.date_format(ts, "HH:mm:ss"))
        .when(micros % 1_000 == 0, F.date_format(ts, "HH:mm:ss.SSS"))
        .otherwise(F.date_format(ts, "HH:mm:ss.SSSSSS"))
    )


def _nanos(parsed: Column, text: Column, info: PatternInfo) -> Column:
    """``parsed`` with the nine fraction digits of the text, which a timestamp holds only six of."""
    group = next(g for ch, g in info.full_groups if ch == "S")
    return F.when(parsed.isNotNull(), F.struct(
        parsed.alias("at"), F.rpad(F.regexp_extract(text, info.full_regex, group), 9, "0").alias("fraction")))


def _with_nanos(finish: Callable[[Column], Column], whole: str) -> Callable[[Column], Column]:
    """ISO text of a ``_nanos`` value: nine digits where the last three are not all zero."""
    def text(parsed: Column) -> Column:
        short = F.substring(parsed["fraction"], 7, 3) == "000"
        return F.when(short, finish(parsed["at"])).otherwise(
            F.concat(F.date_format(parsed["at"], whole), F.lit("."), parsed["fraction"]))
    return text


def _plus_day(value: Column) -> Column:
    return value + F.make_dt_interval(F.lit(1))


def utc_wall_clock(instant: Column) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ wall clock in UTC."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def clamped_day_text(text: Column, info: PatternInfo) -> Column | None:
    """The text with a day-of-month past the month's end moved to its last day.

    java.time's default resolver accepts ``2019-02-30`` as ``2019-02-28`` (and
    ``04-31`` as ``04-30``) but not day 32; Spark rejects them all.  Where
    the pattern fixes the text positions of year, month and day, the text is
    rewritten that way, to be parsed again only after the strict parse failed.
    """
    if info.ymd_offsets is not None:
        oy, om, od = info.ymd_offsets
        year = F.substring(text, oy + 1, 4).try_cast("int")
        month = F.substring(text, om + 1, 2).try_cast("int")
        day = F.substring(text, od + 1, 2).try_cast("int")
        last, fix = _month_end(year, month, day)
        return F.when(fix, F.overlay(text, F.lpad(last.cast("string"), 2, "0"), F.lit(od + 1), F.lit(2)))
    if info.field_regex is None or info.ymd_groups is None:
        return None
    # Variable-width fields: take the text apart by the pattern's regex and
    # put it back together with the day replaced.
    rx = info.field_regex
    gy, gm, gd = info.ymd_groups
    year = F.regexp_extract(text, rx, gy).try_cast("int")
    if info.two_digit_year:
        year = year + 2000
    month_text = F.regexp_extract(text, rx, gm)
    if info.month_is_text:
        names = FULL_MONTH_NAMES if len(info.pattern) and "MMMM" in info.pattern else SHORT_MONTH_NAMES
        month = F.array_position(F.array(*[F.lit(n) for n in names]), month_text).cast("int")
        month = F.when(month > 0, month)
    else:
        month = month_text.try_cast("int")
    day = F.regexp_extract(text, rx, gd).try_cast("int")
    last, fix = _month_end(year, month, day)
    pieces = [last.cast("string") if g == gd else F.regexp_extract(text, rx, g) for _, g in info.token_groups]
    return F.when(fix & text.rlike(rx), F.concat(*pieces))


def _month_end(year: Column, month: Column, day: Column) -> tuple[Column, Column]:
    """The month's last day, and whether ``day`` (29-31) lies past it."""
    ok_month = month.between(1, 12) & year.between(1, 9999)
    last = F.dayofmonth(F.last_day(F.make_date(F.when(ok_month, year), F.when(ok_month, month), F.lit(1))))
    return last, ok_month & day.between(29, 31) & (day > last)


# English month names, as java.time prints them for MMM and MMMM.
SHORT_MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
FULL_MONTH_NAMES = ["January", "February", "March", "April", "May", "June", "July", "August", "September",
                    "October", "November", "December"]
# English day names, as java.time prints them for E..EEE and EEEE.
SHORT_DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
FULL_DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _with_clamp(parse, text: Column, info: PatternInfo, local=None, plus_day=_plus_day) -> Column:
    """Strict parse; on failure, the parse of the day-clamped text (if any).

    A leading day name (``EEE, dd MMM yyyy ...``) is cut off before parsing
    and must name the weekday of the date written in the text (``local``
    parses it ignoring any zone), as java.time checks it.
    """
    if info.day_name_letters:
        names = FULL_DAY_NAMES if info.day_name_letters == 4 else SHORT_DAY_NAMES
        if info.day_name_regex is not None:
            # The name sits inside the text: take it out by the pattern's regex.
            rx = info.day_name_regex
            name = F.regexp_extract(text, rx, info.day_name_group)
            rest = F.concat(*[F.regexp_extract(text, rx, g) for g in info.rest_groups])
        else:
            name = F.regexp_extract(text, "^(" + "|".join(names) + ")", 1)
            rest = F.substring(text, F.length(name) + 1, F.lit(1 << 30))
        parsed = _clamped_parse(parse, rest, info, plus_day)
        written = parsed if local is None else _clamped_parse(local, rest, info, plus_day)
        shown = F.date_format(written, "EEEE" if info.day_name_letters == 4 else "EEE")
        return F.when((name != "") & (shown == name), parsed)
    return _clamped_parse(parse, text, info, plus_day)


def _text_fields_cased(text: Column, info: PatternInfo) -> Column | None:
    """Checks java.time makes that Spark's parser does not.

    Month names and AM/PM match case-sensitively, and a fraction field takes
    exactly as many digits as the pattern has letters.
    """
    checks = []
    if "S" in info.letters and info.full_regex is not None:
        checks.append(text.rlike(info.full_regex))
    for letter in ("M", "L"):
        count = info.letters.get(letter, 0)
        if count == 3:
            checks.append(text.rlike("(" + "|".join(SHORT_MONTH_NAMES) + ")"))
        elif count == 4:
            checks.append(text.rlike("(" + "|".join(FULL_MONTH_NAMES) + ")"))
    if "a" in info.letters:
        checks.append(text.rlike("(AM|PM)"))
    if not checks:
        return None
    ok = checks[0]
    for c in checks[1:]:
        ok = ok & c
    return ok


def end_of_day_text(text: Column, info: PatternInfo) -> Column | None:
    """``24:00`` (all smaller fields zero) rewritten as ``00:00``, for the next day.

    java.time's default resolver reads hour 24 at the end of a day as the
    next day's midnight; Spark rejects it.  Used only after the strict parse
    failed.
    """
    if info.full_regex is None:
        return None
    hours = [g for ch, g in info.full_groups if ch == "H"]
    if len(hours) != 1:
        return None
    rx, gh = info.full_regex, hours[0]
    cond = text.rlike(rx) & (F.regexp_extract(text, rx, gh) == "24")
    for ch, g in info.full_groups:
        if ch in "msS":
            cond = cond & F.regexp_extract(text, rx, g).rlike("^0+$")
    pieces = [F.lit("00") if g == gh else F.regexp_extract(text, rx, g) for _, g in info.full_groups]
    return F.when(cond, F.concat(*pieces))


def _clamped_parse(parse, text: Column, info: PatternInfo, plus_day=_plus_day) -> Column:
    """Strict parse, then the rare forms: a day past the month's end, hour 24.

    The rare forms sit in a lambda over a one-element array: Spark interprets
    it, and only for rows whose strict parse is NULL, instead of adding it to
    the generated method of every row.
    """
    def rare(t: Column) -> Column | None:
        clamped, midnight = clamped_day_text(t, info), end_of_day_text(t, info)
        tries = [parse(clamped)] if clamped is not None else []
        if midnight is not None:
            tries.append(plus_day(parse(midnight)))
        return F.coalesce(*tries) if tries else None

    parsed = parse(text)
    if rare(text) is not None:
        parsed = F.coalesce(parsed, F.element_at(F.transform(F.array(text), rare), 1))
    cased = _text_fields_cased(text, info)
    return parsed if cased is None else F.when(cased, parsed)


def _local_parser(info: PatternInfo):
    def strict(t: Column) -> Column:
        if info.has_zone:
            fits = F.try_to_timestamp(t, F.lit(info.pattern)).isNotNull()
            return F.when(fits, F.to_timestamp_ntz(t, F.lit(info.pattern)))
        # Zoneless text parses in the session zone; the jobs pin it to UTC,
        # where the round trip to wall-clock time is exact.
        return F.try_to_timestamp(t, F.lit(info.pattern)).cast("timestamp_ntz")
    return strict


def parse_instant(text: Column, info: PatternInfo) -> Column:
    return _with_clamp(lambda t: F.try_to_timestamp(t, F.lit(info.pattern)), text, info, _local_parser(info))


def parse_local(text: Column, info: PatternInfo) -> Column:
    """Local date-time fields of the text; a zone in the text is ignored."""
    return _with_clamp(_local_parser(info), text, info)


def _datetime_op(kind: str, text: Column, arg: str) -> OpPlan:
    info = classify(arg)
    if info.problem:
        return _always_fail(F.lit(info.problem))
    need_zone = kind in ("TIMESTAMP", "TRANSFORM_TIMESTAMP_TO_DATE")
    need_date = kind != "TIME"
    need_time = kind != "DATE"
    if need_zone and not info.has_zone:
        return _always_fail(F.concat(datetime_error(text), F.lit(": Unable to obtain ZonedDateTime")))
    if need_date and not info.has_date:
        return _always_fail(F.concat(datetime_error(text), F.lit(": Unable to obtain LocalDate")))
    if need_time and not info.has_time:
        return _always_fail(F.concat(datetime_error(text), F.lit(": Unable to obtain LocalTime")))
    reason = datetime_error(text)
    if kind in ("TIMESTAMP", "UTC_TIMESTAMP", "TIME") and info.letters.get("S", 0) > 6 and info.full_regex is not None:
        parsed = utc_wall_clock(parse_instant(text, info)) if kind == "TIMESTAMP" else parse_local(text, info)
        finish, whole = (iso_local_time, "HH:mm:ss") if kind == "TIME" else (iso_local_datetime, ISO_SECOND)
        return OpPlan(_nanos(parsed, text, info), _with_nanos(finish, whole), reason)
    if kind == "TIMESTAMP":
        return OpPlan(utc_wall_clock(parse_instant(text, info)), iso_local_datetime, reason)
    if kind == "TRANSFORM_TIMESTAMP_TO_DATE":
        return OpPlan(utc_wall_clock(parse_instant(text, info)).cast("date").cast("string"), reason=reason)
    if kind == "DATE":
        if info.has_zone:
            return OpPlan(parse_local(text, info).cast("date").cast("string"), reason=reason)
        return OpPlan(_with_clamp(lambda t: F.try_to_date(t, info.pattern), text, info,
                                  plus_day=lambda d: F.date_add(d, 1)).cast("string"), reason=reason)
    if kind == "UTC_TIMESTAMP":
        return OpPlan(parse_local(text, info), iso_local_datetime, reason)
    if kind == "TIME":
        return OpPlan(parse_local(text, info), iso_local_time, reason)
    # TRANSFORM_UTC_TIMESTAMP_TO_DATE
    return OpPlan(parse_local(text, info).cast("date").cast("string"), reason=reason)


def _always_fail(reason: Column) -> OpPlan:
    """Every non-empty value fails with ``reason``."""
    return OpPlan(F.lit(None).cast("string"), reason=reason)


# ---------------------------------------------------------------- compiler

def plan_op(op: str, text: Column, *, compat: bool = False, name: str | None = None) -> OpPlan:
    """Compile an operation (``OP(arg)``) or, with ``name``, a named field.

    ``compat=True`` reproduces the update-rule quirk where INTEGER, DOUBLE,
    FLOAT, BIGINT and BIGDECIMAL results are replaced by NULL (their parse
    errors still fail the record).
    """
    spec = parse_operation(op)
    return plan_spec(FieldSpec(name or "", spec.op, spec.arg, spec.problem), text, compat=compat,
                     named=name is not None)


def plan_spec(spec: FieldSpec, text: Column, *, compat: bool = False, named: bool = True) -> OpPlan:
    if spec.problem:
        # The spec cannot be cut: every record fails, empty or not.
        return OpPlan(F.lit(None).cast("string"), reason=F.lit(spec.problem), always_fails=True)
    kind = resolve_kind(spec.op)
    if kind == "STRING":
        plan = OpPlan(text)
    elif kind == "INTEGER":
        plan = _integral(text, "int")
    elif kind == "LONG":
        plan = _integral(text, "bigint")
    elif kind == "BIGINT":
        plan = _integral(text, "decimal(38,0)")
    elif kind == "DOUBLE":
        plan = _floating(text, "double")
    elif kind == "FLOAT":
        plan = _floating(text, "float")
    elif kind == "BIGDECIMAL":
        plan = _big_decimal(text, BIGDECIMAL_SCALE)
    elif kind == "int2bigDecimal":
        plan = plain_decimal_text(text)
    elif kind == "PRECISION":
        plan = _precision(text, spec.arg)
    elif kind is None:
        plan = _always_fail(F.lit(UNSUPPORTED))
    else:
        plan = _datetime_op(kind, text, spec.arg)
    # Empty text gives NULL before the operation is even looked at.
    parse = F.when(_present(text), plan.parse)
    reason = plan.reason
    if named and reason is not None:
        reason = field_error(spec.name, reason)
    nulled = result_type(spec.op) if compat and kind in RULE_NULLED_OPS else None
    return OpPlan(parse, plan.finish, reason, False, nulled, plan.steps)


def compile_op(op: str, text: Column, *, compat: bool = False) -> Typed:
    return plan_op(op, text, compat=compat).inline(text)


def compile_field(spec: FieldSpec, text: Column, *, compat: bool = False) -> Typed:
    """Compile a named field; errors carry the ``failed at field`` prefix."""
    return plan_spec(spec, text, compat=compat).inline(text)


def apply_plans(df: DataFrame, items: list[tuple[Column, OpPlan]], passthrough: list[str]):
    """Evaluate each plan's parse once: ``(text column, OpPlan)`` items.

    Projects ``passthrough`` plus one ``__p<i>`` column per item, once for the
    parses and once for each step of those that have some, and returns
    ``(frame, values, errors)`` where values and errors are expressions over
    that frame for the caller's next projection.  Each parse column is used
    twice there (value and error), so Catalyst keeps the two projections
    apart and no parse is repeated.  The text columns must survive in
    ``passthrough`` when an error needs them.
    """
    df.sparkSession.conf.set(*METHOD_LIMIT)
    p = [f"__p{i}" for i in range(len(items))]
    staged = df.select(*[F.col(f"`{c}`") for c in passthrough],
                       *[plan.parse.alias(p[i]) for i, (_, plan) in enumerate(items)])
    for k in range(max((len(plan.steps) for _, plan in items), default=0)):
        staged = staged.select(*[F.col(f"`{c}`") for c in passthrough],
                               *[(plan.steps[k](F.col(p[i])) if k < len(plan.steps) else F.col(p[i])).alias(p[i])
                                 for i, (_, plan) in enumerate(items)])
    values = [plan.value(F.col(p[i])) for i, (_, plan) in enumerate(items)]
    errors = [plan.error(text, F.col(p[i])) for i, (text, plan) in enumerate(items)]
    return staged, values, errors


# ---------------------------------------------------------------- library helpers

def parse_local_date(text: Column, pattern: str) -> Column:
    """Date text with a pattern -> DATE; NULL stays NULL (and bad text gives NULL)."""
    info = classify(pattern)
    if info.problem:
        return F.lit(None).cast("date")
    return parse_local(text, info).cast("date")


def parse_iso_instant(text: Column) -> Column:
    """ISO-8601 text (offset optional) -> TIMESTAMP."""
    return text.try_cast("timestamp")


def zoned_to_utc_date(text: Column, pattern: str) -> Column:
    """Zoned date-time text -> its UTC date as ``yyyy-MM-dd`` (NULL on failure)."""
    plan = _datetime_op("TRANSFORM_TIMESTAMP_TO_DATE", text, pattern)
    return plan.finish(plan.parse)
