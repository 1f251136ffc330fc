"""Registered queries over the driver's tables, each with a DuckDB oracle.

The driver's inputs are parquet tables, so each query renders table rows into
the text an ingestion job receives (CSV lines, JSON or XML messages, Avro-like
records) inside the Spark plan, runs the real operator on that text, and
returns its output.  All rows of each table are used; damaged records are
chosen by a rule on the key so the oracle can predict them.  The oracle SQL
computes the expected output straight from the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.fieldops import parse_iso_instant, parse_local_date, zoned_to_utc_date
from sluice.operators.delimited import drop_header_trailer, parse_delimited
from sluice.operators.results import bad_rows, good_rows
from sluice.sources.tables import read_table


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def pin_utc(spark: SparkSession) -> None:
    """Date/time operators assume a UTC session zone (as the jobs set it)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def dec2(c: Column) -> Column:
    """A double as fixed two-decimal text, the way a CSV export writes money."""
    return c.cast("decimal(18,2)").cast("string")


def csv_line(*cells: Column) -> Column:
    return F.concat_ws(",", *[c.cast("string") for c in cells])


SQL: dict[str, str] = {}

# ---------------------------------------------------------------- CSV family

LINEITEM_HEADERS = (
    "l_orderkey:LONG,l_partkey:LONG,l_suppkey:LONG,l_linenumber:INTEGER,l_quantity:DOUBLE,"
    "l_extendedprice:DOUBLE,l_discount:DOUBLE,l_tax:DOUBLE,l_returnflag:STRING,l_linestatus:STRING,"
    "l_shipdate:DATE(yyyyMMdd)"
)


def lineitem_lines(li: DataFrame) -> DataFrame:
    return li.select(
        csv_line(
            F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber"),
            F.col("l_quantity"), F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax"),
            F.col("l_returnflag"), F.col("l_linestatus"), F.date_format("l_shipdate", "yyyyMMdd"),
        ).alias("line")
    )


def csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every lineitem row as a CSV line, split and typed."""
    pin_utc(spark)
    return good_rows(parse_delimited(lineitem_lines(read(spark, sf_dir, "lineitem")), LINEITEM_HEADERS))


SQL["csv_typed"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem
"""


def csv_header_trailer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header and trailer lines (and look-alikes) around the data lines.

    Each order's first line is preceded by a header line and followed by a
    trailer; its second line is followed by a trailer look-alike that matches
    only in part, so it stays and fails the cell count.
    """
    pin_utc(spark)
    li = read(spark, sf_dir, "lineitem")
    data = csv_line(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity"),
                    F.date_format("l_shipdate", "yyyyMMdd"))
    header = F.when(F.col("l_linenumber") == 1, F.lit("l_orderkey,l_linenumber,l_quantity,l_shipdate"))
    trailer = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("TRL,"), F.col("l_orderkey").cast("string")))
    look_alike = F.when(F.col("l_linenumber") == 2, F.concat(F.lit("TRL,x,"), F.col("l_orderkey").cast("string")))
    lines = li.select(F.explode(F.filter(F.array(header, data, trailer, look_alike), lambda x: x.isNotNull())).alias("line"))
    kept = drop_header_trailer(lines, r"l_orderkey,.*", r"TRL,[0-9]+")
    parsed = parse_delimited(kept, "l_orderkey:LONG,l_linenumber:INTEGER,l_quantity:DOUBLE,l_shipdate:DATE(yyyyMMdd)")
    return good_rows(parsed)


SQL["csv_header_trailer"] = """
SELECT l_orderkey, l_linenumber, l_quantity, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem
"""

ORDERS_HEADERS = (
    "o_orderkey:LONG,o_custkey:LONG,o_orderstatus:STRING,o_totalprice:DOUBLE,"
    "o_orderdate:DATE(yyyy-MM-dd),o_orderpriority:STRING"
)


def damaged_order_lines(o: DataFrame) -> DataFrame:
    """Orders as CSV lines; ``o_orderkey % 7`` picks one kind of damage."""
    k = F.col("o_orderkey") % 7
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    price = dec2(F.col("o_totalprice"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    cust_cell = F.when(k == 5, F.concat(F.lit('" '), cust, F.lit(' "'))).otherwise(cust)
    price_cell = F.when(k == 3, F.concat(F.lit("x"), price)).otherwise(price)
    day_cell = F.when(k == 4, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(day)
    base = F.concat_ws(",", key, cust_cell, F.col("o_orderstatus"), price_cell, day_cell)
    line = (
        F.when(k == 1, base)                                            # one cell short
        .when(k == 2, F.concat_ws(",", base, F.col("o_orderpriority"), F.lit("extra")))
        .otherwise(F.concat_ws(",", base, F.col("o_orderpriority")))
    )
    return o.select(line.alias("line"))


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dead letters of damaged order lines: text and reason."""
    pin_utc(spark)
    parsed = parse_delimited(damaged_order_lines(read(spark, sf_dir, "orders")), ORDERS_HEADERS)
    return bad_rows(parsed).select("value", "error")


SQL["csv_rejects"] = """
WITH o AS (
  SELECT *, o_orderkey % 7 AS k, CAST(o_orderkey AS VARCHAR) AS key, CAST(o_custkey AS VARCHAR) AS cust,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price, strftime(o_orderdate, '%Y-%m-%d') AS day
  FROM orders)
SELECT
  CASE k
    WHEN 1 THEN concat_ws(',', key, cust, o_orderstatus, price, day)
    WHEN 2 THEN concat_ws(',', key, cust, o_orderstatus, price, day, o_orderpriority, 'extra')
    WHEN 3 THEN concat_ws(',', key, cust, o_orderstatus, 'x' || price, day, o_orderpriority)
    WHEN 4 THEN concat_ws(',', key, cust, o_orderstatus, price, strftime(o_orderdate, '%Y/%m/%d'), o_orderpriority)
    WHEN 5 THEN concat_ws(',', key, ' ' || cust || ' ', o_orderstatus, price, day, o_orderpriority)
  END AS value,
  CASE k
    WHEN 1 THEN 'File schema doesn''t match with number of columns within the line'
    WHEN 2 THEN 'File schema doesn''t match with number of columns within the line'
    WHEN 3 THEN 'failed at field: o_totalprice, trace:For input string: "x' || price || '"'
    WHEN 4 THEN 'failed at field: o_orderdate, trace:Text ''' || strftime(o_orderdate, '%Y/%m/%d') || ''' could not be parsed'
    WHEN 5 THEN 'failed at field: o_custkey, trace:For input string: " ' || cust || ' "'
  END AS error
FROM o WHERE k BETWEEN 1 AND 5
"""


def csv_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty cells become NULL for every operation (F17); names contain '#'."""
    pin_utc(spark)
    c = read(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 5
    blank = F.lit("")
    line = csv_line(
        F.col("c_custkey"),
        F.col("c_name"),
        F.when(k.isin(3, 4), blank).otherwise(F.col("c_nationkey").cast("string")),
        F.when(k.isin(1, 4), blank).otherwise(dec2(F.col("c_acctbal"))),
        F.when(k.isin(2, 4), blank).otherwise(F.col("c_mktsegment")),
    )
    parsed = parse_delimited(
        c.select(line.alias("line")),
        "c_custkey:LONG,c_name:STRING,c_nationkey:INTEGER,c_acctbal:PRECISION(2),c_mktsegment:STRING",
    )
    # A nullable integer is compared as text, so NULLs cannot change its type in either engine.
    return good_rows(parsed).withColumn("c_nationkey", F.col("c_nationkey").cast("string"))


SQL["csv_nulls"] = """
SELECT c_custkey, c_name,
  CASE WHEN c_custkey % 5 IN (3, 4) THEN NULL ELSE CAST(c_nationkey AS VARCHAR) END AS c_nationkey,
  CASE WHEN c_custkey % 5 IN (1, 4) THEN NULL ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS c_acctbal,
  CASE WHEN c_custkey % 5 IN (2, 4) THEN NULL ELSE c_mktsegment END AS c_mktsegment
FROM customer
"""


def path_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date taken from the file path and appended as the last cell."""
    pin_utc(spark)
    o = read(spark, sf_dir, "orders")
    path = F.concat(F.lit("/landing/orders/"), F.date_format("o_orderdate", "yyyyMMdd"),
                    F.lit("/orders_part"), (F.col("o_orderkey") % 16).cast("string"), F.lit(".csv"))
    lines = o.select(csv_line(F.col("o_orderkey"), F.col("o_orderstatus")).alias("line"), path.alias("path"))
    from sluice.sources.files import extract_path_date

    dated = lines.withColumn("file_date", extract_path_date(F.col("path"), r"(\d{8})"))
    parsed = parse_delimited(dated, "o_orderkey:LONG,o_orderstatus:STRING,order_day:DATE(yyyyMMdd)",
                             date_col="file_date", src_col="path")
    return good_rows(parsed)


SQL["path_date"] = """
SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders
"""

def month_end_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days past the month's end move to its last day (F10 with the default resolver, Q12).

    Every order date is written with day 31 (``yyyy-MM-dd``) and day 30
    (``dd/MM/yyyy``) of its month.
    """
    pin_utc(spark)
    o = read(spark, sf_dir, "orders")
    d31 = F.concat(F.date_format("o_orderdate", "yyyy-MM-"), F.lit("31"))
    d30 = F.concat(F.lit("30/"), F.date_format("o_orderdate", "MM/yyyy"))
    lines = o.select(csv_line(F.col("o_orderkey"), d31, d30).alias("line"))
    return good_rows(parse_delimited(lines, "o_orderkey:LONG,day31:DATE(yyyy-MM-dd),day30:DATE(dd/MM/yyyy)"))


SQL["month_end_dates"] = """
SELECT o_orderkey, strftime(last_day(o_orderdate), '%Y-%m-%d') AS day31,
       strftime(make_date(year(o_orderdate), month(o_orderdate), least(30, day(last_day(o_orderdate)))), '%Y-%m-%d') AS day30
FROM orders
"""

# ---------------------------------------------------------------- numbers


def precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HALF_UP rounding to a fixed scale, printed plain.

    The amount text has five decimals taken from the keys, negative on even
    line numbers, so ties at every scale occur.
    """
    li = read(spark, sf_dir, "lineitem")
    sign = F.when(F.col("l_linenumber") % 2 == 0, F.lit("-")).otherwise(F.lit(""))
    amount = F.concat(sign, (F.col("l_orderkey") % 1000).cast("string"), F.lit("."),
                      F.lpad((F.col("l_partkey") * 7 % 100000).cast("string"), 5, "0"))
    lines = li.select(csv_line(F.col("l_orderkey"), F.col("l_linenumber"), amount, amount, amount).alias("line"))
    parsed = parse_delimited(
        lines, "l_orderkey:LONG,l_linenumber:INTEGER,amt2:PRECISION(2),amt0:PRECISION(0),amt_tens:PRECISION(-1)"
    )
    return good_rows(parsed)


def _half_up_sql(scale: int) -> str:
    """Exact HALF_UP of n / 100000 to ``scale`` digits, as text (integer arithmetic)."""
    unit = 10 ** (5 - scale)
    q = f"((abs(n) + {unit // 2}) // {unit})"
    if scale > 0:
        body = f"CAST({q} // {10 ** scale} AS VARCHAR) || '.' || lpad(CAST({q} % {10 ** scale} AS VARCHAR), {scale}, '0')"
    elif scale == 0:
        body = f"CAST({q} AS VARCHAR)"
    else:
        body = f"CAST({q} * {10 ** -scale} AS VARCHAR)"
    return f"CASE WHEN n < 0 AND {q} > 0 THEN '-' ELSE '' END || {body}"


SQL["precision"] = f"""
WITH t AS (
  SELECT l_orderkey, l_linenumber,
         (CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END) * ((l_orderkey % 1000) * 100000 + (l_partkey * 7 % 100000)) AS n
  FROM lineitem)
SELECT l_orderkey, l_linenumber, {_half_up_sql(2)} AS amt2, {_half_up_sql(0)} AS amt0, {_half_up_sql(-1)} AS amt_tens
FROM t
"""


def big_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain decimal text, big integers and big decimals.

    The price text is written three ways (plain, exponent, signed with leading
    zeros); the big integer has 21 zeros appended to the order key.
    """
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 3
    cents = (F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("decimal(18,0)").cast("string")
    price = dec2(F.col("o_totalprice"))
    text = (F.when(k == 0, price)
            .when(k == 1, F.concat(cents, F.lit("E-2")))
            .otherwise(F.concat(F.lit("+00"), price)))
    big = F.concat(F.col("o_orderkey").cast("string"), F.lit("0" * 21))
    lines = o.select(csv_line(F.col("o_orderkey"), text, text, big).alias("line"))
    parsed = parse_delimited(lines, "o_orderkey:LONG,price_plain:int2bigDecimal,price_dec:BIGDECIMAL,big:BIGINT")
    out = good_rows(parsed)
    return out.select("o_orderkey", "price_plain", F.col("price_dec").cast("string").alias("price_dec"),
                      F.col("big").cast("string").alias("big"))


SQL["big_numbers"] = """
SELECT o_orderkey,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price_plain,
       CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,18)) AS VARCHAR) AS price_dec,
       CASE WHEN o_orderkey = 0 THEN '0' ELSE CAST(o_orderkey AS VARCHAR) || repeat('0', 21) END AS big
FROM orders
"""

# ---------------------------------------------------------------- date / time


def _varied_ts(ts: Column, key: Column) -> Column:
    """Cut the timestamp to minutes, seconds or millis by key, to vary the ISO form."""
    k = key % 4
    return (F.when(k == 0, F.date_trunc("minute", ts))
            .when(k == 1, F.date_trunc("second", ts))
            .when(k == 2, F.date_trunc("millisecond", ts))
            .otherwise(ts))


def _offset_minutes(key: Column) -> Column:
    return ((key % 29) - 14) * 30


def _offset_text(minutes: Column) -> Column:
    sign = F.when(minutes < 0, F.lit("-")).otherwise(F.lit("+"))
    a = F.abs(minutes)
    return F.concat(sign, F.lpad((a / 60).cast("int").cast("string"), 2, "0"), F.lit(":"),
                    F.lpad((a % 60).cast("string"), 2, "0"))


def ts_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zoned timestamps to UTC ISO text and UTC dates.

    Each event time is printed as local time at an offset from -07:00 to
    +07:00 (by key) with its offset, then parsed back.
    """
    pin_utc(spark)
    e = read(spark, sf_dir, "events")
    ts = _varied_ts(F.col("ts"), F.col("event_id"))
    mins = _offset_minutes(F.col("event_id"))
    local = ts + F.make_dt_interval(F.lit(0), F.lit(0), mins)
    text = F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), _offset_text(mins))
    lines = e.select(csv_line(F.col("event_id"), text, text).alias("line"))
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    parsed = parse_delimited(
        lines, f"event_id:LONG,ts_utc:TIMESTAMP({pattern}),day_utc:TRANSFORM_TIMESTAMP_TO_DATE({pattern})"
    )
    return good_rows(parsed)


def _iso_sql(t: str) -> str:
    return f"""CASE WHEN microsecond({t}) = 0 THEN strftime({t}, '%Y-%m-%dT%H:%M')
  WHEN microsecond({t}) % 1000000 = 0 THEN strftime({t}, '%Y-%m-%dT%H:%M:%S')
  WHEN microsecond({t}) % 1000 = 0 THEN strftime({t}, '%Y-%m-%dT%H:%M:%S.%g')
  ELSE strftime({t}, '%Y-%m-%dT%H:%M:%S.%f') END"""


def _time_sql(t: str) -> str:
    return f"""CASE WHEN microsecond({t}) = 0 THEN strftime({t}, '%H:%M')
  WHEN microsecond({t}) % 1000000 = 0 THEN strftime({t}, '%H:%M:%S')
  WHEN microsecond({t}) % 1000 = 0 THEN strftime({t}, '%H:%M:%S.%g')
  ELSE strftime({t}, '%H:%M:%S.%f') END"""


_VARIED_SQL = """CASE event_id % 4 WHEN 0 THEN date_trunc('minute', ts) WHEN 1 THEN date_trunc('second', ts)
  WHEN 2 THEN date_trunc('millisecond', ts) ELSE ts END"""

SQL["ts_zoned"] = f"""
WITH e AS (SELECT event_id, {_VARIED_SQL} AS t FROM events)
SELECT event_id, {_iso_sql('t')} AS ts_utc, strftime(t, '%Y-%m-%d') AS day_utc FROM e
"""


def ts_day_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RFC-1123-style text: a leading day name checked against the date.

    Local time at an offset from -07:00 to +07:00 is printed as
    ``EEE, dd MMM yyyy HH:mm:ss Z``; every seventh event names the next day
    instead, so it must be rejected.
    """
    pin_utc(spark)
    e = read(spark, sf_dir, "events")
    ts = F.date_trunc("second", F.col("ts"))
    mins = _offset_minutes(F.col("event_id"))
    local = ts + F.make_dt_interval(F.lit(0), F.lit(0), mins)
    day = F.when(F.col("event_id") % 7 == 0, F.date_format(F.date_add(F.to_date(local), 1), "EEE")) \
        .otherwise(F.date_format(local, "EEE"))
    zone = F.regexp_replace(_offset_text(mins), ":", "")
    text = F.concat(day, F.lit(", "), F.date_format(local, "dd MMM yyyy HH:mm:ss"), F.lit(" "), zone)
    lines = e.select(F.col("event_id"), text.alias("line"))
    parsed = parse_delimited(lines.select(F.concat(F.col("event_id").cast("string"), F.lit(',"'), F.col("line"),
                                                   F.lit('"')).alias("line")),
                             "event_id:LONG,ts_utc:TIMESTAMP(EEE, dd MMM yyyy HH:mm:ss Z)")
    return good_rows(parsed)


SQL["ts_day_names"] = """
SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M') ||
       CASE WHEN second(ts) = 0 THEN '' ELSE strftime(date_trunc('second', ts), ':%S') END AS ts_utc
FROM events WHERE event_id % 7 <> 0
"""


def ts_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zoneless timestamps, times of day and dates."""
    pin_utc(spark)
    e = read(spark, sf_dir, "events")
    ts = _varied_ts(F.col("ts"), F.col("event_id"))
    text = F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    time_text = F.date_format(ts, "HH:mm:ss.SSSSSS")
    lines = e.select(csv_line(F.col("event_id"), text, time_text, text, F.date_format(ts, "dd/MM/yyyy")).alias("line"))
    parsed = parse_delimited(
        lines,
        "event_id:LONG,ts_local:UTC_TIMESTAMP(yyyy-MM-dd HH:mm:ss.SSSSSS),time_of_day:TIME(HH:mm:ss.SSSSSS),"
        "day_local:TRANSFORM_UTC_TIMESTAMP_TO_DATE(yyyy-MM-dd HH:mm:ss.SSSSSS),day_text:DATE(dd/MM/yyyy)",
    )
    return good_rows(parsed)


SQL["ts_local"] = f"""
WITH e AS (SELECT event_id, {_VARIED_SQL} AS t FROM events)
SELECT event_id, {_iso_sql('t')} AS ts_local, {_time_sql('t')} AS time_of_day,
       strftime(t, '%Y-%m-%d') AS day_local, strftime(t, '%Y-%m-%d') AS day_text FROM e
"""

def wide_decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers with more digits than a decimal column holds: exact text, or an error, never rounded."""
    pin_utc(spark)
    li = read(spark, sf_dir, "lineitem")
    key, line = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    wide = F.concat(F.lit("98765432109876543210"), key, F.lit("."), line, F.lit("00000000000000000000000000000000000049999"))
    lines = li.select(csv_line(F.col("l_orderkey"), F.col("l_linenumber"), wide, wide, wide,
                               F.concat(key, F.lit("E-120")),
                               F.concat(key, F.lit(".0000000000000000000"), F.when(F.col("l_linenumber") < 3, F.lit("0")).otherwise(line)),
                               F.concat(F.lit("1"), F.repeat(F.lit("0"), F.lit(35)), key)).alias("line"))
    specs = ("k:LONG,n:INTEGER,same:int2bigDecimal,p2:PRECISION(2),p41:PRECISION(41),tiny:int2bigDecimal,"
             "typed:BIGDECIMAL,big:BIGINT")
    out = parse_delimited(lines, specs)
    ok = F.col("_error").isNull()
    return out.select("k", "n", "same", "p2", "p41", "tiny",
                      F.when(ok, F.col("typed").cast("string")).alias("typed"), F.col("_error").alias("error"))


SQL["wide_decimals"] = """
WITH t AS (
  SELECT l_orderkey AS k, l_linenumber AS n, CAST(l_orderkey AS VARCHAR) AS ks, CAST(l_linenumber AS VARCHAR) AS ns,
         '98765432109876543210' || CAST(l_orderkey AS VARCHAR) AS whole FROM lineitem),
u AS (SELECT *, ks || '.0000000000000000000' || CASE WHEN n < 3 THEN '0' ELSE ns END AS typed_text,
             '1' || repeat('0', 35) || ks AS big_text FROM t)
SELECT CAST(k AS BIGINT) AS k, CAST(n AS INTEGER) AS n, whole || '.' || ns || '00000000000000000000000000000000000049999' AS same,
       whole || '.' || ns || '0' AS p2, whole || '.' || ns || '0000000000000000000000000000000000005000' AS p41,
       '0.' || repeat('0', 120 - length(ks)) || ks AS tiny,
       CASE WHEN n < 3 AND length(big_text) <= 38 THEN ks || '.000000000000000000' END AS typed,
       CASE WHEN n >= 3 THEN 'failed at field: typed, trace:Value does not fit DECIMAL(38,18): "' || typed_text || '"'
            WHEN length(big_text) > 38 THEN 'failed at field: big, trace:For input string: "' || big_text || '"' END AS error
FROM u
"""


def ts_nanos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven to nine fraction digits are kept."""
    pin_utc(spark)
    e = read(spark, sf_dir, "events")
    nanos = F.lpad((F.col("event_id") * 7919 % 1_000_000_000).cast("string"), 9, "0")
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    lines = e.select(csv_line(F.col("event_id"), F.concat(at, F.lit("."), nanos, F.lit(" +02:00")), F.concat(at, F.lit("."), nanos),
                              F.concat(F.date_format("ts", "HH:mm:ss"), F.lit("."), F.substring(nanos, 1, 7))).alias("line"))
    specs = ("id:LONG,zoned:TIMESTAMP(yyyy-MM-dd HH:mm:ss.SSSSSSSSS XXX),local:UTC_TIMESTAMP(yyyy-MM-dd HH:mm:ss.SSSSSSSSS),"
             "clock:TIME(HH:mm:ss.SSSSSSS)")
    return good_rows(parse_delimited(lines, specs))


SQL["ts_nanos"] = """
WITH t AS (SELECT event_id, ts, lpad(CAST(event_id * 7919 % 1000000000 AS VARCHAR), 9, '0') AS f FROM events),
u AS (SELECT *, substring(f, 1, 7) || '00' AS f7 FROM t)
SELECT CAST(event_id AS BIGINT) AS id,
""" + ",\n".join(f"""       strftime({at}, '{day}%H:%M') ||
       CASE WHEN {f} = '000000000' AND second(ts) = 0 THEN ''
            WHEN {f} = '000000000' THEN strftime(ts, ':%S')
            WHEN substring({f}, 4) = '000000' THEN strftime(ts, ':%S.') || substring({f}, 1, 3)
            WHEN substring({f}, 7) = '000' THEN strftime(ts, ':%S.') || substring({f}, 1, 6)
            ELSE strftime(ts, ':%S.') || {f} END AS {name}""" for at, day, f, name in (
    ("ts - INTERVAL 2 HOUR", "%Y-%m-%dT", "f", "zoned"), ("ts", "%Y-%m-%dT", "f", "local"), ("ts", "", "f7", "clock"))) + """
FROM u
"""


def float_and_unsupported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLOAT cells, and an operation nobody knows, which fails each value but not an empty cell."""
    pin_utc(spark)
    li = read(spark, sf_dir, "lineitem")
    lines = li.select(csv_line(F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_quantity"),
                               F.when(F.col("l_linenumber") == 2, F.col("l_returnflag")).otherwise(F.lit(""))).alias("line"))
    out = parse_delimited(lines, "k:LONG,n:INTEGER,quantity:FLOAT,flag:BOOLEAN")
    return out.select("k", "n", F.col("quantity").cast("double").alias("quantity"), "flag", F.col("_error").alias("error"))


SQL["float_and_unsupported"] = """
SELECT CAST(l_orderkey AS BIGINT) AS k, CAST(l_linenumber AS INTEGER) AS n, CAST(CAST(l_quantity AS FLOAT) AS DOUBLE) AS quantity,
       CAST(NULL AS VARCHAR) AS flag,
       CASE WHEN l_linenumber = 2 THEN 'failed at field: flag, trace:Data type not supported' END AS error
FROM lineitem
"""


def date_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library's date functions."""
    pin_utc(spark)
    e = read(spark, sf_dir, "events")
    day = F.when(F.col("event_id") % 6 != 0, F.date_format("ts", "dd/MM/yyyy")).otherwise(F.lit("31/31/2024"))
    return e.select(
        "event_id", parse_local_date(day, "dd/MM/yyyy").cast("string").alias("day"),
        F.date_format(parse_iso_instant(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")), "yyyy-MM-dd HH:mm:ss").alias("instant"),
        zoned_to_utc_date(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm"), F.lit(" -05:00")), "yyyy-MM-dd HH:mm XXX").alias("utc_day"))


SQL["date_helpers"] = """
SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS day,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS instant, strftime(ts + INTERVAL 5 HOUR, '%Y-%m-%d') AS utc_day FROM events
"""

QUERIES = {
    "wide_decimals": wide_decimals,
    "ts_nanos": ts_nanos,
    "float_and_unsupported": float_and_unsupported,
    "date_helpers": date_helpers,
    "csv_typed": csv_typed,
    "csv_header_trailer": csv_header_trailer,
    "csv_rejects": csv_rejects,
    "csv_nulls": csv_nulls,
    "path_date": path_date,
    "month_end_dates": month_end_dates,
    "precision": precision,
    "big_numbers": big_numbers,
    "ts_zoned": ts_zoned,
    "ts_local": ts_local,
    "ts_day_names": ts_day_names,
}
