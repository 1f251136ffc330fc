from sluice.functions.fieldops import resolve_kind
from sluice.functions.patterns import classify
from sluice.functions.spec import op_argument, parse_field_spec, split_header_list


def test_name_op_split_outside_parentheses():
    spec = parse_field_spec("Day:DATE(yyyy-MM-dd HH:mm)")
    assert (spec.name, spec.op, spec.arg, spec.problem) == ("Day", "DATE(yyyy-MM-dd HH:mm)", "yyyy-MM-dd HH:mm", None)


def test_blank_after_colon_is_skipped():
    assert parse_field_spec("Amount:  PRECISION(2)").op == "PRECISION(2)"


def test_spec_needs_two_parts():
    assert parse_field_spec("NoOp").problem
    assert parse_field_spec("a:b:c").problem
    # Java's split drops trailing empty strings, so a trailing ':' still gives two parts.
    assert parse_field_spec("a:STRING:").problem is None


def test_argument_cut():
    assert op_argument("STRING") == ("", None)
    assert op_argument("DATE(yyyyMMdd)") == ("yyyyMMdd", None)
    assert op_argument("DATE(yyyyMMdd")[1] is not None


def test_header_list_keeps_commas_inside_parentheses():
    assert split_header_list("a:STRING, b:DATE(dd, MMM yyyy) ,c:LONG") == ["a:STRING", "b:DATE(dd, MMM yyyy)", "c:LONG"]


def test_operation_dispatch_order_and_prefixes():
    assert resolve_kind("DATETIME(yyyy)") == "DATE"
    assert resolve_kind("TIMESTAMP(x)") == "TIMESTAMP"
    assert resolve_kind("TIMEOFDAY(x)") == "TIME"
    assert resolve_kind("UTC_TIMESTAMP(x)") == "UTC_TIMESTAMP"
    assert resolve_kind("TRANSFORM_UTC_TIMESTAMP_TO_DATE(x)") == "TRANSFORM_UTC_TIMESTAMP_TO_DATE"
    assert resolve_kind("BIGDECIMAL(4)") is None
    assert resolve_kind("string") is None


def test_pattern_classification():
    assert classify("uuuu-MM-dd").pattern == "yyyy-MM-dd"
    assert classify("YYYY-MM-dd").problem
    assert classify("EEE yyyy-MM-dd").day_name_letters == 3 and classify("EEE yyyy-MM-dd").problem is None
    assert classify("yyyy-MM-dd EEE").day_name_regex and classify("yyyy-MM-dd EEE EEE").problem
    assert classify("yyyy-MM-dd bb").problem
    assert classify("yyyy-MM-dd'").problem
    assert classify("").problem
    info = classify("yyyy-MM-dd'T'HH:mm:ssXXX")
    assert info.problem is None and info.has_zone and info.has_date and info.has_time
    assert not classify("yyyy-MM-dd HH:mm").has_zone
    assert not classify("HH:mm").has_date
    assert classify("yyyy-MM-dd'T'HH:mm").pattern == "yyyy-MM-dd'T'HH:mm"
