import decimal
import re

import pytest
from pyspark.sql import functions as F

from sluice.functions.fieldops import compile_op

NUMBERS = ["", "+5", " 5 ", "5.0", "1e3", "2147483648", "1" * 39, "1d", "NaN", "nan", "inf", "007", ".5",
           "1.5E1", "2.345", "-2.345"]


def apply(spark, op, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    t = compile_op(op, F.col("x"))
    return {r.x: (r.v, r.e) for r in df.select("x", t.value.alias("v"), t.error.alias("e")).collect()}


def ok(result):
    return {k: v for k, (v, e) in result.items() if e is None}


def test_integer_is_java_strict(spark):
    r = ok(apply(spark, "INTEGER", NUMBERS))
    assert r == {"": None, "+5": 5, "007": 7}


def test_long_and_bigint(spark):
    assert ok(apply(spark, "LONG", NUMBERS)) == {"": None, "+5": 5, "2147483648": 2147483648, "007": 7}
    big = ok(apply(spark, "BIGINT", NUMBERS))
    assert big[""] is None and int(big["2147483648"]) == 2147483648 and "1" * 39 not in big


def test_double_follows_java_parser(spark):
    r = ok(apply(spark, "DOUBLE", NUMBERS))
    assert r["1d"] == 1.0 and r["1e3"] == 1000.0 and r[" 5 "] == 5.0 and r[".5"] == 0.5
    assert "nan" not in r and "inf" not in r and r["NaN"] != r["NaN"]


def test_plain_decimal_text(spark):
    r = ok(apply(spark, "int2bigDecimal", NUMBERS + ["1.50", "-0.0", "1E3", "1.50E1", "1E-3", "0E3"]))
    assert r["1e3"] == "1000" and r["1.50"] == "1.50" and r[".5"] == "0.5" and r["1.50E1"] == "15.0"
    assert r["-0.0"] == "0.0" and r["1E-3"] == "0.001" and r["0E3"] == "0" and r["007"] == "7"
    assert r["1" * 39] == "1" * 39 and r["+5"] == "5"


def test_precision_half_up_plain(spark):
    r = ok(apply(spark, "PRECISION(2)", ["2.345", "-2.345", "2.5", "1E3", "-0.001", "x"]))
    assert r == {"2.345": "2.35", "-2.345": "-2.35", "2.5": "2.50", "1E3": "1000.00", "-0.001": "0.00"}
    assert ok(apply(spark, "PRECISION(4)", ["2.5"])) == {"2.5": "2.5000"}
    assert ok(apply(spark, "PRECISION(-1)", ["125", "124.5"])) == {"125": "130", "124.5": "120"}
    bad = apply(spark, "PRECISION(x)", ["1", ""])
    assert bad["1"][1] and bad[""] == (None, None)


def test_empty_gives_null_even_for_unsupported_op(spark):
    r = apply(spark, "WHATEVER", ["", "a"])
    assert r[""] == (None, None)
    assert r["a"] == (None, "Data type not supported")


def test_field_error_text(spark):
    from sluice.functions.fieldops import compile_field
    from sluice.functions.spec import parse_field_spec

    df = spark.createDataFrame([("x",)], "t string")
    t = compile_field(parse_field_spec("Amount:INTEGER"), F.col("t"))
    assert df.select(t.error).first()[0] == 'failed at field: Amount, trace:For input string: "x"'


def test_zoned_timestamp_to_utc_shortest_iso(spark):
    pat = "yyyy-MM-dd'T'HH:mm[:ss][.SSSSSS][.SSS]XXX"
    r = ok(apply(spark, f"TIMESTAMP({pat})", ["2019-12-28T10:15+01:00", "2019-12-28T10:15:05+01:00",
                                             "2019-12-28T10:15:05.120+01:00", "2019-12-28T10:15:05.000123-02:30"]))
    assert r == {
        "2019-12-28T10:15+01:00": "2019-12-28T09:15",
        "2019-12-28T10:15:05+01:00": "2019-12-28T09:15:05",
        "2019-12-28T10:15:05.120+01:00": "2019-12-28T09:15:05.120",
        "2019-12-28T10:15:05.000123-02:30": "2019-12-28T12:45:05.000123",
    }


def test_zone_required_for_timestamp(spark):
    r = apply(spark, "TIMESTAMP(yyyy-MM-dd HH:mm)", ["2019-12-28 10:15", ""])
    assert r[""] == (None, None) and "ZonedDateTime" in r["2019-12-28 10:15"][1]


def test_local_ops(spark):
    assert ok(apply(spark, "UTC_TIMESTAMP(yyyy-MM-dd HH:mm:ss)", ["2019-12-28 10:15:00"])) == {
        "2019-12-28 10:15:00": "2019-12-28T10:15"}
    assert ok(apply(spark, "TIME(HH:mm)", ["09:37"])) == {"09:37": "09:37"}
    assert ok(apply(spark, "TIME(HH:mm:ss.SSS)", ["09:37:01.500"])) == {"09:37:01.500": "09:37:01.500"}
    assert ok(apply(spark, "DATE(yyyyMMdd)", ["20191228"])) == {"20191228": "2019-12-28"}
    assert ok(apply(spark, "DATETIME(yyyyMMdd)", ["20191228"])) == {"20191228": "2019-12-28"}
    # The zone in the text is ignored by local operations.
    assert ok(apply(spark, "DATE(yyyy-MM-dd HH:mmXXX)", ["2019-12-28 23:30-05:00"])) == {
        "2019-12-28 23:30-05:00": "2019-12-28"}
    assert ok(apply(spark, "TRANSFORM_TIMESTAMP_TO_DATE(yyyy-MM-dd HH:mmXXX)", ["2019-12-28 23:30-05:00"])) == {
        "2019-12-28 23:30-05:00": "2019-12-29"}
    assert ok(apply(spark, "TRANSFORM_UTC_TIMESTAMP_TO_DATE(yyyy-MM-dd HH:mm)", ["2019-12-28 23:30"])) == {
        "2019-12-28 23:30": "2019-12-28"}


def test_month_end_with_variable_width_fields(spark):
    r = apply(spark, "DATE(d/M/yyyy)", ["31/6/2019", "30/2/2020", "32/1/2019", "5/13/2019", "9/9/2019"])
    assert r["31/6/2019"] == ("2019-06-30", None) and r["30/2/2020"] == ("2020-02-29", None)
    assert r["9/9/2019"] == ("2019-09-09", None) and r["32/1/2019"][1] and r["5/13/2019"][1]
    assert ok(apply(spark, "UTC_TIMESTAMP(yyyy-M-d H:mm)", ["2019-2-30 9:05"])) == {"2019-2-30 9:05": "2019-02-28T09:05"}
    assert ok(apply(spark, "DATE(dd MMM yyyy)", ["31 Jun 2019", "29 Feb 2019", "31 Foo 2019"])) == {
        "31 Jun 2019": "2019-06-30", "29 Feb 2019": "2019-02-28"}
    assert ok(apply(spark, "DATE(dd MMMM yyyy)", ["31 September 2019"])) == {"31 September 2019": "2019-09-30"}
    assert ok(apply(spark, "DATE(dd/MM/yy)", ["30/02/20"])) == {"30/02/20": "2020-02-29"}
    r = apply(spark, "TIMESTAMP(EEE, dd MMM yyyy HH:mm:ss Z)", ["Sun, 31 Jun 2019 10:00:00 +0000"])
    assert r["Sun, 31 Jun 2019 10:00:00 +0000"] == ("2019-06-30T10:00", None)


def test_fraction_takes_exactly_its_digits(spark):
    assert ok(apply(spark, "UTC_TIMESTAMP(yyyy-MM-dd HH:mm:ss.SSS)",
                    ["2019-06-28 10:15:30.100", "2019-06-28 10:15:30.1", "2019-06-28 10:15:30.1000"])) == {
        "2019-06-28 10:15:30.100": "2019-06-28T10:15:30.100"}


def test_month_names_and_am_pm_are_case_sensitive(spark):
    assert ok(apply(spark, "DATE(dd MMM yyyy)", ["28 Jun 2019", "28 jun 2019", "28 JUN 2019"])) == {
        "28 Jun 2019": "2019-06-28"}
    assert ok(apply(spark, "UTC_TIMESTAMP(yyyy-MM-dd hh:mm a)", ["2019-06-28 10:00 PM", "2019-06-28 10:00 pm"])) == {
        "2019-06-28 10:00 PM": "2019-06-28T22:00"}


def test_day_name_inside_the_pattern_is_checked(spark):
    # (An operation's argument ends at its first ')', so patterns hold no parentheses.)
    r = apply(spark, "DATE(dd MMM yyyy, EEE)", ["28 Dec 2019, Sat", "28 Dec 2019, Mon", "31 Jun 2019, Sun"])
    assert r["28 Dec 2019, Sat"] == ("2019-12-28", None)
    assert r["28 Dec 2019, Mon"][1]
    assert r["31 Jun 2019, Sun"] == ("2019-06-30", None)
    assert ok(apply(spark, "UTC_TIMESTAMP(yyyy-MM-dd EEEE HH:mm)", ["2019-12-28 Saturday 10:05"])) == {
        "2019-12-28 Saturday 10:05": "2019-12-28T10:05"}


def test_hour_24_is_the_next_days_midnight(spark):
    r = apply(spark, "UTC_TIMESTAMP(yyyy-MM-dd HH:mm)", ["2019-12-31 24:00", "2019-12-31 24:01"])
    assert r["2019-12-31 24:00"] == ("2020-01-01T00:00", None) and r["2019-12-31 24:01"][1]
    assert ok(apply(spark, "DATE(yyyy-MM-dd HH:mm)", ["2019-12-31 24:00"])) == {"2019-12-31 24:00": "2020-01-01"}
    assert ok(apply(spark, "TIME(HH:mm:ss)", ["24:00:00"])) == {"24:00:00": "00:00"}
    assert ok(apply(spark, "TIMESTAMP(yyyy-MM-dd HH:mmXXX)", ["2019-12-31 24:00+01:00"])) == {
        "2019-12-31 24:00+01:00": "2019-12-31T23:00"}


def test_leading_day_name_is_checked(spark):
    r = apply(spark, "TIMESTAMP(EEE, dd MMM yyyy HH:mm:ss Z)",
              ["Sat, 28 Dec 2019 10:15:30 +0100", "Mon, 28 Dec 2019 10:15:30 +0100", "28 Dec 2019 10:15:30 +0100"])
    assert r["Sat, 28 Dec 2019 10:15:30 +0100"] == ("2019-12-28T09:15:30", None)
    assert r["Mon, 28 Dec 2019 10:15:30 +0100"][1] and r["28 Dec 2019 10:15:30 +0100"][1]
    assert ok(apply(spark, "DATE(EEEE yyyy-MM-dd)", ["Saturday 2019-12-28"])) == {"Saturday 2019-12-28": "2019-12-28"}
    assert ok(apply(spark, "DATE(EEE yyyy-MM-dd)", ["Mon 2019-02-30"])) == {}   # clamped to Thu 28th: wrong name


@pytest.mark.parametrize("op", ["DATE(YYYY-MM-dd)", "DATE(yyyy-MM-dd EEE EEE)", "DATE(yyyy-MM-dd bb)", "UTC_TIMESTAMP(yyyy-MM-dd)"])
def test_unusable_patterns_fail_each_value_without_raising(spark, op):
    r = apply(spark, op, ["2019-12-28", ""])
    assert r[""] == (None, None) and r["2019-12-28"][1]


def test_day_past_month_end_is_moved_to_the_last_day(spark):
    r = apply(spark, "DATE(yyyy-MM-dd)", ["2019-02-30", "2020-02-30", "2019-04-31", "2019-02-32", "2019-13-01"])
    assert r["2019-02-30"] == ("2019-02-28", None) and r["2020-02-30"] == ("2020-02-29", None)
    assert r["2019-04-31"] == ("2019-04-30", None)
    assert r["2019-02-32"][1] and r["2019-13-01"][1]
    assert ok(apply(spark, "DATE(dd/MM/yyyy)", ["31/06/2019"])) == {"31/06/2019": "2019-06-30"}
    assert ok(apply(spark, "UTC_TIMESTAMP(yyyy-MM-dd HH:mm)", ["2019-02-29 10:00"])) == {
        "2019-02-29 10:00": "2019-02-28T10:00"}
    assert ok(apply(spark, "TIMESTAMP(yyyy-MM-dd HH:mmXXX)", ["2019-02-29 23:00-02:00"])) == {
        "2019-02-29 23:00-02:00": "2019-03-01T01:00"}


def test_library_date_helpers(spark):
    from sluice.functions.fieldops import parse_iso_instant, parse_local_date, zoned_to_utc_date

    df = spark.createDataFrame([("28/12/2019", "2019-12-28T10:00:00+02:00", "2019-12-28 23:30 -0500"),
                                (None, None, None)], "d string, i string, z string")
    r = df.select(parse_local_date(F.col("d"), "dd/MM/yyyy").cast("string").alias("d"),
                  parse_iso_instant(F.col("i")).cast("string").alias("i"),
                  zoned_to_utc_date(F.col("z"), "yyyy-MM-dd HH:mm Z").alias("z")).collect()
    assert tuple(r[0]) == ("2019-12-28", "2019-12-28 08:00:00", "2019-12-29")
    assert tuple(r[1]) == (None, None, None)


def test_document_to_row(spark):
    from pyspark.sql import types as T

    from sluice.operators.documents import document_to_row

    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.LongType())])
    df = spark.createDataFrame([('{"a":"x","n":5,"extra":1}',), ("not json",)], "doc string")
    got = {r._raw: (r.a, r.n, r._error) for r in document_to_row(df, "doc", schema).collect()}
    assert got['{"a":"x","n":5,"extra":1}'] == ("x", 5, None)
    assert got["not json"][2] == "not a JSON object"


def test_decimal_steps_are_projected_once_and_stay_compiled(spark):
    from sluice.functions.fieldops import METHOD_LIMIT
    from sluice.operators.delimited import parse_delimited

    texts = ["0", "-0.00", "9.995", "-9.995", "99.5", "0.005", "-0.004", ".5", "5.", "1E3", "-1.5e-3", "+00012.3400", "1e9999999999",
             "0e9999999", "1E2000000", "7E-1", "", "x", "-", ".", "1e", "9" * 40 + ".5", "0." + "0" * 30 + "1"]
    df = spark.createDataFrame([(f"{t},{t},{t},{t},{t}",) for t in texts], "line string").repartition(2)
    out = parse_delimited(df, "plain:int2bigDecimal,p2:PRECISION(2),p0:PRECISION(0),tens:PRECISION(-1),typed:BIGDECIMAL")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[eE][+-]?[0-9]+)?\\z") <= 2 * 5 and "transform(" not in plan
    assert spark.conf.get(METHOD_LIMIT[0]) == METHOD_LIMIT[1]

    def want(t, to):
        if not re.fullmatch(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", t):
            return None
        ctx = decimal.Context(prec=200, Emax=10**15, Emin=-10**15)
        d = ctx.create_decimal(t)
        if abs(d.as_tuple().exponent) > 1_000_000:
            return None
        if to is not None:
            d = d.quantize(decimal.Decimal(1).scaleb(-to), decimal.ROUND_HALF_UP, ctx)
        return format(abs(d) if d == 0 else d, "f") if d != 0 or d.as_tuple().exponent <= 0 else "0"

    got = {r["_raw"].split(",")[0]: r for r in out.collect()}
    for t in texts:
        for name, to in (("plain", None), ("p2", 2), ("p0", 0), ("tens", -1)):
            expected = want(t, to)
            assert got[t][name] == ("0" if expected is not None and set(expected) == {"0"} else expected), (t, name)
    assert got["0e9999999"]["typed"] == 0 and got["1E3"]["typed"] == 1000 and got["9.995"]["typed"] == decimal.Decimal("9.995")
    assert got["0." + "0" * 30 + "1"]["typed"] is None and got["1e9999999999"]["typed"] is None


def test_plain_decimals_are_settled_without_being_taken_apart(spark):
    from sluice.functions import fieldops

    texts = ["1.50", "0", "0.00", "-7", "1234567890123456789012345678901234567890.5", "-12.995", "9.5", "99", "007", "1E3", "+1", "-0.0", ".5", "5."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    parts = df.select("t", fieldops._plain_or_parts(F.col("t")).alias("p")).select("t", "p.plain", "p.mantissa").collect()
    assert [r["t"] for r in parts if r["plain"] is not None] == texts[:8]
    assert all((r["plain"] is None) != (r["mantissa"] is None) for r in parts)


def test_rounded_plain_decimals(spark):
    from decimal import ROUND_HALF_UP, Context, Decimal

    whole = ["0", "1", "-1", "9", "-9", "99", "10", "109", "-1099", "98765432109876543210" * 3]
    texts = [w + f for w in whole for f in ("", ".0", ".4", ".5", ".9", ".04", ".05", ".49", ".94", ".95", ".99", ".995", ".999", ".0949", ".0950", ".9950", ".00049999", ".19999995")]
    for scale in (-1, 0, 1, 2, 3, 7, 9):
        got = ok(apply(spark, f"PRECISION({scale})", texts))
        for t in texts:
            want = f"{Decimal(t).quantize(Decimal(1).scaleb(-scale), ROUND_HALF_UP, Context(prec=200)):f}"
            assert got[t] == (want.lstrip("-") if not Decimal(want) else want), (t, scale)
