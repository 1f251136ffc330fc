"""Field operations against small Python models of Java's number parsing.

Each hypothesis example is a batch of generated texts evaluated in one Spark
job, then compared value by value with the model.
"""

import decimal
import re

from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions.fieldops import compile_op

digits = st.text(alphabet="0123456789", min_size=0, max_size=25)
decimal_text = st.builds(
    lambda sign, i, frac, dot, exp: sign + i + (("." + frac) if dot else "") + exp,
    st.sampled_from(["", "+", "-"]),
    digits,
    digits,
    st.booleans(),
    st.one_of(st.just(""), st.builds(lambda e, s, n: e + s + str(n), st.sampled_from(["e", "E"]),
                                     st.sampled_from(["", "+", "-"]), st.integers(0, 40))),
)
noise = st.sampled_from(["", " 1", "1 ", "1.2.3", "abc", "--1", "1e", ".", "+", "0x10", "1,5", "NaN", "٣"])
texts = st.lists(st.one_of(decimal_text, noise), min_size=50, max_size=150)

# Wide enough for every generated text; Java's BigDecimal has no such limit.
decimal.getcontext().prec = 200
FAST = settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.reuse, Phase.generate])

JAVA_DECIMAL = re.compile(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?")


def run(spark, op, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    t = compile_op(op, F.col("x"))
    return {r.x: (r.v, r.e) for r in df.select("x", t.value.cast("string").alias("v"), t.error.alias("e")).collect()}


def plain_model(text):
    """BigDecimal(text).toPlainString(), or None when Java would reject the text."""
    if not JAVA_DECIMAL.fullmatch(text):
        return None
    d = decimal.Decimal(text)
    out = format(d, "f")
    return out[1:] if out.startswith("-") and d == 0 else out


def half_up_model(text, scale):
    if not JAVA_DECIMAL.fullmatch(text):
        return None
    d = decimal.Decimal(text).quantize(decimal.Decimal(1).scaleb(-scale), rounding=decimal.ROUND_HALF_UP)
    out = format(d, "f")
    return out[1:] if out.startswith("-") and d == 0 else out


def int_model(text, bits):
    if not re.fullmatch(r"[+-]?[0-9]+", text):
        return None
    v = int(text)
    return str(v) if -(2 ** (bits - 1)) <= v < 2 ** (bits - 1) else None


@FAST
@given(texts)
def test_plain_decimal_text_matches_model(spark, values):
    got = run(spark, "int2bigDecimal", values)
    for text in values:
        if text == "":
            assert got[text] == (None, None)
            continue
        want = plain_model(text)
        assert got[text][0] == want, text
        assert (got[text][1] is None) == (want is not None), text


@FAST
@given(texts, st.integers(-4, 45))
def test_precision_matches_half_up_model(spark, values, scale):
    got = run(spark, f"PRECISION({scale})", values)
    for text in values:
        if text == "":
            continue
        assert got[text][0] == half_up_model(text, scale), text


@FAST
@given(st.lists(st.one_of(st.integers(-(2 ** 70), 2 ** 70).map(str), noise,
                          st.builds(lambda s, n: s + n, st.sampled_from(["", "+", "-", "0", "00"]), digits)),
                min_size=50, max_size=150))
def test_integer_and_long_match_java(spark, values):
    for op, bits in (("INTEGER", 32), ("LONG", 64)):
        got = run(spark, op, values)
        for text in values:
            if text == "":
                continue
            assert got[text][0] == int_model(text, bits), (op, text)


# Java's Double.parseDouble: blanks (<= ' ') around; NaN / Infinity without a
# suffix; decimal numbers with an optional f/F/d/D suffix.
JAVA_DOUBLE = re.compile(
    r"[\x00-\x20]*([+-]?)(?:(NaN|Infinity)|((?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)[fFdD]?)[\x00-\x20]*"
)


def double_model(text):
    m = JAVA_DOUBLE.fullmatch(text)
    if not m:
        return None
    core = m.group(2) or m.group(3)
    return float(m.group(1) + core.replace("Infinity", "inf"))


double_text = st.builds(
    lambda pad1, core, suffix, pad2: pad1 + core + suffix + pad2,
    st.sampled_from(["", " ", "\t"]),
    st.one_of(decimal_text, st.sampled_from(["NaN", "-Infinity", "+NaN", "nan", "inf", "-inf", "infinity", "1e400",
                                             "4.9e-324", "1e-400"])),
    st.sampled_from(["", "", "d", "F"]),
    st.sampled_from(["", " ", "\n"]),
)


@FAST
@given(st.lists(st.one_of(double_text, noise), min_size=50, max_size=150))
def test_double_matches_java(spark, values):
    import math

    df = spark.createDataFrame([(v,) for v in values], "x string")
    t = compile_op("DOUBLE", F.col("x"))
    got = {r.x: r.v for r in df.select("x", t.value.alias("v")).collect()}
    for text in values:
        if text == "":
            continue
        want = double_model(text)
        have = got[text]
        if want is None:
            assert have is None, repr(text)
        elif math.isnan(want):
            assert have is not None and math.isnan(have), repr(text)
        else:
            assert have == want, repr(text)


def date_model(text):
    m = re.fullmatch(r"([0-9]{4})-([0-9]{2})-([0-9]{2})", text)
    if not m:
        return None
    import calendar

    y, mo, d = (int(g) for g in m.groups())
    if not (1 <= mo <= 12 and 1 <= d <= 31) or y == 0:
        return None
    d = min(d, calendar.monthrange(y, mo)[1])
    return f"{y:04d}-{mo:02d}-{d:02d}"


@FAST
@given(st.lists(st.builds(lambda y, m, d, sep: f"{y:04d}{sep}{m:02d}{sep}{d:02d}",
                          st.integers(1, 9999), st.integers(0, 13), st.integers(0, 32), st.sampled_from(["-", "-", "/"])),
                min_size=50, max_size=150))
def test_date_matches_java_default_resolver(spark, values):
    got = run(spark, "DATE(yyyy-MM-dd)", values)
    for text in values:
        assert got[text][0] == date_model(text), text


scalar = st.one_of(st.text(alphabet="abcXYZ é", max_size=5), st.integers(-5, 5), st.booleans(), st.none())
anything = st.recursive(scalar, lambda inner: st.one_of(st.lists(inner, max_size=3),
                                                        st.dictionaries(st.sampled_from(["a", "b"]), inner, max_size=2)),
                        max_leaves=4)
detail = st.dictionaries(st.sampled_from(["AppointmentId", "TimestampUtc", "Disciplines", "Room"]),
                         st.one_of(scalar, st.lists(st.one_of(scalar, anything), max_size=3), anything), max_size=4)
document = st.dictionaries(
    st.sampled_from(["Type", "Data", "Extra"]),
    st.one_of(scalar, st.lists(st.one_of(detail, st.none(), scalar), max_size=3), detail, anything),
    max_size=3,
)


def _scalar(v):
    return not isinstance(v, (list, dict))


def binds(doc):
    """Whether a strict object binder accepts the document as the appointment record."""
    if set(doc) - {"Type", "Data"}:
        return False
    if not _scalar(doc.get("Type")):
        return False
    data = doc.get("Data")
    if data is None:
        return True
    if not isinstance(data, list):
        return False
    for item in data:
        if item is None:
            continue
        if not isinstance(item, dict) or set(item) - {"AppointmentId", "TimestampUtc", "Disciplines"}:
            return False
        if not (_scalar(item.get("AppointmentId")) and _scalar(item.get("TimestampUtc"))):
            return False
        disc = item.get("Disciplines")
        if disc is not None and not (isinstance(disc, list) and all(_scalar(x) for x in disc)):
            return False
    return True


@FAST
@given(st.lists(document, min_size=30, max_size=80))
def test_json_binding_matches_strict_binder(spark, docs):
    import json as _json

    from sluice.operators.messages_json import bind_json_messages

    attrs = {"TopicName": "t", "MessageId": "m", "LogicalDate": "d"}
    payloads = [_json.dumps(d, ensure_ascii=False) for d in docs]
    df = spark.createDataFrame([(p, attrs) for p in payloads], "payload string, attributes map<string,string>")
    got = {r._raw: (r._error, r.Type) for r in bind_json_messages(df).collect()}
    for doc, payload in zip(docs, payloads):
        error, typ = got[payload]
        assert (error is None) == binds(doc), (payload, error)
        if error is None and isinstance(doc.get("Type"), str):
            assert typ == doc["Type"]


rule_value = st.sampled_from(["12.34", "-0.05", "7", "abc", "", None, "1e3", "+5", "0.95", "2147483648"])
record = st.fixed_dictionaries({"a": rule_value, "n": rule_value,
                                "b": st.one_of(st.none(), st.fixed_dictionaries({"c": rule_value}))})
rule = st.tuples(st.sampled_from(["/a", "/b/c", "/c", "/n", "/x"]),
                 st.sampled_from(["STRING", "LONG", "PRECISION(1)", "int2bigDecimal"]))


def rules_model(rec, rules):
    """Apply rules with JSON-pointer semantics and Java's number rules; None when the record fails."""
    rec = {k: (dict(v) if isinstance(v, dict) else v) for k, v in rec.items()}
    for loc, op in rules:
        node, found = rec, True
        for seg in loc[1:].split("/"):
            if isinstance(node, dict) and seg in node:
                node = node[seg]
            else:
                found = False
                break
        if not found:
            continue
        text = None if node is None or isinstance(node, dict) else str(node)
        if text is None or text == "":
            result = None
        elif op == "STRING":
            result = text
        elif op == "LONG":
            result = int_model(text, 64)
            if result is None:
                return None
            result = int(result)
        elif op == "PRECISION(1)":
            result = half_up_model(text, 1)
            if result is None:
                return None
        else:
            result = plain_model(text)
            if result is None:
                return None
        rec[loc.rsplit("/", 1)[1]] = result
    return rec


@FAST
@given(st.lists(record, min_size=20, max_size=60), st.lists(rule, min_size=1, max_size=6))
def test_update_rules_match_json_pointer_model(spark, recs, rules):
    from sluice.operators.results import ERROR_COL
    from sluice.operators.rules import apply_rules

    rows = [(i, r["a"], r["n"], None if r["b"] is None else (r["b"]["c"],)) for i, r in enumerate(recs)]
    df = spark.createDataFrame(rows, "id long, a string, n string, b struct<c:string>")
    out = apply_rules(df, [{"location": loc, "operation": op} for loc, op in rules])
    cols = [c for c in ("a", "n", "c") if c in out.columns]
    got = {r.id: r for r in out.select("id", ERROR_COL, *[F.col(c).cast("string").alias(c) for c in cols]).collect()}
    for i, rec in enumerate(recs):
        want = rules_model(rec, rules)
        have = got[i]
        assert (have[ERROR_COL] is None) == (want is not None), (rec, rules, have)
        if want is None:
            continue
        for c in cols:
            expected = want.get(c)
            assert have[c] == (None if expected is None else str(expected)), (rec, rules, c, have)


def dmy_model(text):
    m = re.fullmatch(r"([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})", text)
    if not m:
        return None
    return date_model(f"{m.group(3)}-{int(m.group(2)):02d}-{int(m.group(1)):02d}")


@FAST
@given(st.lists(st.builds(lambda d, m, y, pad: f"{d:0{pad}d}/{m}/{y:04d}",
                          st.integers(0, 33), st.integers(0, 13), st.integers(1, 9999), st.sampled_from([1, 2])),
                min_size=50, max_size=150))
def test_variable_width_date_matches_java_default_resolver(spark, values):
    got = run(spark, "DATE(d/M/yyyy)", values)
    for text in values:
        assert got[text][0] == dmy_model(text), text


xml_text = st.text(alphabet="ab ÄZ<&", min_size=0, max_size=4)
xml_child = st.one_of(
    st.tuples(st.just("Type"), xml_text),
    st.tuples(st.just("Unknown"), xml_text),
    st.tuples(st.just("Data"), st.lists(st.one_of(
        st.tuples(st.sampled_from(["AppointmentId", "TimestampUtc", "Discipline", "Other"]), xml_text)), max_size=4)),
)
xml_doc = st.tuples(st.sampled_from(["Appointments", "Appointments", "appointments", "Other"]), st.booleans(),
                    st.lists(xml_child, max_size=5))


def _esc(t):
    return t.replace("&", "&amp;").replace("<", "&lt;")


def render_xml(doc):
    root, ns, children = doc
    pre = "p:" if ns else ""
    body = []
    for name, value in children:
        if name == "Data":
            inner = "".join(f"<{pre}{n}>{_esc(v)}</{pre}{n}>" for n, v in value)
            body.append(f"<{pre}Data>{inner}</{pre}Data>")
        else:
            body.append(f"<{pre}{name}>{_esc(value)}</{pre}{name}>")
    decl = ' xmlns:p="urn:x"' if ns else ""
    return f"<{pre}{root}{decl}>{''.join(body)}</{pre}{root}>"


def xml_model(doc):
    """(accepted, Type, (AppointmentId, TimestampUtc, Disciplines) or None) as an XML object binder gives them."""
    root, _, children = doc
    if root != "Appointments":
        return False, None, None
    typ, data = None, None
    for name, value in children:
        if name == "Type":
            typ = value
        elif name == "Data":
            fields = {"AppointmentId": None, "TimestampUtc": None}
            disciplines = []
            for n, v in value:
                if n == "Discipline":
                    disciplines.append(v)
                elif n in fields:
                    fields[n] = v
            data = (fields["AppointmentId"], fields["TimestampUtc"], disciplines)
    return True, typ, data


@FAST
@given(st.lists(xml_doc, min_size=20, max_size=60))
def test_xml_binding_matches_object_binder(spark, docs):
    from sluice.operators.messages_xml import bind_xml_messages

    attrs = {"TopicName": "t", "MessageId": "m", "LogicalDate": "d"}
    payloads = [render_xml(d) for d in docs]
    df = spark.createDataFrame([(i, p, attrs) for i, p in enumerate(payloads)],
                               "i long, payload string, attributes map<string,string>")
    got = {r.i: r for r in bind_xml_messages(df, keep=["i"]).collect()}
    for i, doc in enumerate(docs):
        accepted, typ, data = xml_model(doc)
        r = got[i]
        assert (r._error is None) == accepted, (payloads[i], r._error)
        if not accepted:
            continue
        assert r.Type == typ, payloads[i]
        if data is None:
            assert r.Data is None, payloads[i]
        else:
            d = r.Data[0]
            assert (d.AppointmentId, d.TimestampUtc, list(d.Disciplines)) == data, payloads[i]


csv_cell = st.one_of(
    st.tuples(st.text(alphabet="ab 1#é", max_size=5), st.just(False)),          # unquoted: trimmed
    st.tuples(st.text(alphabet='ab ,"1', max_size=5), st.just(True)),            # quoted: kept as is
)


def render_cell(text, quoted):
    return '"' + text.replace('"', '""') + '"' if quoted else text


def cell_model(text, quoted):
    value = text if quoted else text.strip(" ")
    return value if value != "" else None


@FAST
@given(st.lists(st.lists(csv_cell, min_size=2, max_size=4), min_size=30, max_size=80))
def test_csv_split_matches_reference_parser_rules(spark, lines):
    from sluice.operators.delimited import ARITY_ERROR, parse_delimited

    rendered = [",".join(render_cell(t, q) for t, q in cells) for cells in lines]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rendered)], "i long, line string")
    out = parse_delimited(df, "a:STRING,b:STRING,c:STRING", keep=["i"])
    got = {r.i: r for r in out.collect()}
    for i, cells in enumerate(lines):
        r = got[i]
        if len(cells) != 3:
            assert r._error == ARITY_ERROR, rendered[i]
            continue
        assert r._error is None, rendered[i]
        assert (r.a, r.b, r.c) == tuple(cell_model(t, q) for t, q in cells), rendered[i]
