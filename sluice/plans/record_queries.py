"""Registered queries for record operators: update rules, derived fields, Avro, SQL source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.operators.avro_records import decode_json_datums, normalise_records
from sluice.operators.documents import document_to_row
from sluice.operators.results import bad_rows, good_rows
from sluice.operators.rules import apply_rules, derive_field
from sluice.plans.table_queries import pin_utc, read
from sluice.sinks.table import partition_key
from sluice.sources.sql import sql_source

SQL: dict[str, str] = {}

ORDER_RULES = [
    {"location": "/o_totalprice", "operation": "PRECISION(1)"},
    {"location": "/o_orderdate", "operation": "DATE(yyyy-MM-dd HH:mm:ss)"},
    {"location": "/detail/status", "operation": "STRING"},          # nested read, root write
    {"location": "/no_such_field", "operation": "STRING"},          # absent: skipped
    {"location": "/o_orderkey", "operation": "int2bigDecimal"},
    {"location": "/o_orderkey", "operation": "PRECISION(2)"},       # sees the previous result
    {"location": "/maybe_null", "operation": "STRING"},             # NULL stays NULL
    {"location": "/cust_code", "operation": "LONG"},                # 'n/a' fails the record
    {"location": "/o_custkey", "operation": "DOUBLE"},
]


def order_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the records an Avro source would hand to the rules."""
    o = read(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"),
        "o_orderpriority",
        F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")).alias("detail"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")).alias("maybe_null"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string")).alias("cust_code"),
    )


def update_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered update rules over nested records (T4 T4a-T4d T4f)."""
    pin_utc(spark)
    out = good_rows(apply_rules(order_records(spark, sf_dir), ORDER_RULES))
    return out.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "status", "maybe_null", "cust_code")


SQL["update_rules"] = """
SELECT CAST(o_orderkey AS VARCHAR) || '.00' AS o_orderkey,
       CAST(o_custkey AS DOUBLE) AS o_custkey,
       CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,1)) AS VARCHAR) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       o_orderstatus AS status,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS maybe_null,
       o_custkey AS cust_code
FROM orders WHERE o_orderkey % 11 <> 0
"""


def update_rules_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records failed by a rule, as the JSON text they had before any rule."""
    pin_utc(spark)
    return bad_rows(apply_rules(order_records(spark, sf_dir), ORDER_RULES)).select("value", "error")


SQL["update_rules_rejects"] = """
SELECT to_json(struct_pack(
         o_orderkey := o_orderkey, o_custkey := o_custkey, o_orderstatus := o_orderstatus,
         o_totalprice := o_totalprice, o_orderdate := strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
         o_orderpriority := o_orderpriority,
         detail := struct_pack(status := o_orderstatus, priority := o_orderpriority),
         maybe_null := CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END,
         cust_code := 'n/a'))::VARCHAR AS value,
       'failed at field: , trace:For input string: "n/a"' AS error
FROM orders WHERE o_orderkey % 11 = 0
"""


def partition_from_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A date field derived from another field, and its day-partition key (T5 K4)."""
    pin_utc(spark)
    o = read(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate_txt"))
    derived = good_rows(derive_field(o, "p_date", "o_orderdate_txt:DATE(yyyy-MM-dd HH:mm:ss)"))
    return derived.select("o_orderkey", "p_date", partition_key(F.col("p_date")).alias("p_key"))


SQL["partition_from_field"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS p_date, strftime(o_orderdate, '%Y%m%d') AS p_key FROM orders
"""

EVENT_AVRO_SCHEMA = {
    "type": "record", "name": "Event", "fields": [
        {"name": "EventId", "type": "long"},
        {"name": "Kind", "type": {"type": "enum", "name": "Kind", "symbols": ["view", "click", "purchase", "error"]}},
        {"name": "Ts", "type": {"type": "long", "logicalType": "timestamp-millis"}},
        {"name": "Day", "type": {"type": "int", "logicalType": "date"}},
        {"name": "AtMillis", "type": {"type": "int", "logicalType": "time-millis"}},
        {"name": "Micros", "type": {"type": "long", "logicalType": "timestamp-micros"}},
        {"name": "Amount", "type": {"type": "bytes", "logicalType": "decimal", "precision": 12, "scale": 2}},
        {"name": "Props", "type": ["null", "string"]},
        {"name": "UserId", "type": ["long", "null"]},
    ],
}


def event_datums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as Avro datum JSON text, the form Avro's text input format yields.

    The decimal carries its big-endian two's-complement bytes as ISO-8859-1
    text; amounts are negative for odd ids.
    """
    e = read(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    sign = F.when(F.col("event_id") % 2 == 1, F.lit(-1)).otherwise(F.lit(1))
    unscaled = F.round(F.col("value") * 100).cast("bigint") * sign
    raw = F.decode(F.unhex(F.lpad(F.hex(unscaled), 16, "0")), "ISO-8859-1")
    datum = F.to_json(F.struct(
        F.col("event_id").alias("EventId"),
        F.col("event_type").alias("Kind"),
        F.unix_millis(ts).alias("Ts"),
        F.unix_date(F.to_date(ts)).alias("Day"),
        (F.unix_millis(ts) % 86_400_000).cast("int").alias("AtMillis"),
        F.unix_micros(ts).alias("Micros"),
        raw.alias("Amount"),
        F.when(F.col("event_id") % 2 == 0, F.col("props")).alias("Props"),
        F.when(F.col("event_id") % 5 != 0, F.col("user_id")).alias("UserId"),
    ))
    return e.select(datum.alias("datum"))


def avro_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Avro datums decoded and normalised: names, logical types, decimals, unions."""
    pin_utc(spark)
    physical = decode_json_datums(event_datums(spark, sf_dir), "datum", EVENT_AVRO_SCHEMA)
    rows = normalise_records(physical, EVENT_AVRO_SCHEMA)
    return (rows.withColumn("amount", F.col("amount").cast("string"))
            .withColumn("userid", F.col("userid").cast("string")))


SQL["avro_normalise"] = """
WITH e AS (SELECT *, date_trunc('millisecond', ts) AS tm FROM events)
SELECT event_id AS eventid, event_type AS kind,
       strftime(tm, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS ts,
       strftime(ts, '%Y-%m-%d') AS day,
       strftime(tm, '%H:%M:%S.%g') AS atmillis,
       epoch_us(ts) AS micros,
       CAST(CAST(round(value * 100) * (CASE WHEN event_id % 2 = 1 THEN -1 ELSE 1 END) / 100 AS DECIMAL(12,2)) AS VARCHAR) AS amount,
       CASE WHEN event_id % 2 = 0 THEN props END AS props,
       CASE WHEN event_id % 5 <> 0 THEN CAST(user_id AS VARCHAR) END AS userid
FROM e
"""

SOURCE_SQL = """
SELECT o_orderpriority, o_orderstatus, count(*) AS n_orders,
       CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS STRING) AS total_price,
       min(o_orderkey) AS first_order
FROM orders
GROUP BY o_orderpriority, o_orderstatus
"""


def sql_source_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL query over registered tables as a job's input."""
    return sql_source(spark, SOURCE_SQL, {"orders": f"{sf_dir}/orders.parquet"})


SQL["sql_source"] = SOURCE_SQL

def update_rules_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result kinds in compat mode, where typed numbers are written as NULL; then an empty list of rules (T4e T4f)."""
    pin_utc(spark)
    rules = [{"location": "/o_custkey", "operation": "DOUBLE"}, {"location": "/o_orderkey", "operation": "LONG"},
             {"location": "/o_totalprice", "operation": "PRECISION(1)"}, {"location": "/maybe_null", "operation": "INTEGER"}]
    out = apply_rules(good_rows(apply_rules(order_records(spark, sf_dir), rules, compat=True)), [])
    return out.select("o_orderkey", "o_custkey", "o_totalprice", "maybe_null", F.col("_error").alias("error"))


SQL["update_rules_compat"] = """
SELECT o_orderkey, CAST(NULL AS DOUBLE) AS o_custkey, CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(18,1)) AS VARCHAR) AS o_totalprice,
       CAST(NULL AS INTEGER) AS maybe_null, CAST(NULL AS VARCHAR) AS error
FROM orders WHERE o_orderkey % 3 = 0
"""


def update_rules_bad_pointer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A location that is no pointer fails every record with a reason (T4g)."""
    pin_utc(spark)
    out = apply_rules(order_records(spark, sf_dir), [{"location": "o_custkey", "operation": "STRING"}])
    return out.select("o_orderkey", F.col("_error").alias("error"))


SQL["update_rules_bad_pointer"] = """
SELECT o_orderkey, 'Invalid input: JSON Pointer expression must start with ''/'': "o_custkey"' AS error FROM orders
"""


def document_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON documents to rows, with the ones that are no object set aside."""
    pin_utc(spark)
    e = read(spark, sf_dir, "events")
    doc = F.when(F.col("event_id") % 9 == 0, F.concat(F.lit("["), F.col("event_id").cast("string"))).otherwise(
        F.to_json(F.struct("event_id", "event_type", F.col("user_id").alias("user"))))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()), T.StructField("user", T.StringType())])
    out = document_to_row(e.select(doc.alias("doc"), F.col("event_id").alias("key")), "doc", schema, keep=["key"])
    return out.select("key", "event_id", "event_type", "user", F.col("_error").alias("error"))


SQL["document_rows"] = """
SELECT event_id AS key, CASE WHEN event_id % 9 <> 0 THEN event_id END AS event_id, CASE WHEN event_id % 9 <> 0 THEN event_type END AS event_type,
       CASE WHEN event_id % 9 <> 0 THEN CAST(user_id AS VARCHAR) END AS "user",
       CASE WHEN event_id % 9 = 0 THEN 'not a JSON object' END AS error FROM events
"""

QUERIES = {
    "update_rules_compat": update_rules_compat,
    "update_rules_bad_pointer": update_rules_bad_pointer,
    "document_rows": document_rows,
    "update_rules": update_rules,
    "update_rules_rejects": update_rules_rejects,
    "partition_from_field": partition_from_field,
    "avro_normalise": avro_normalise,
    "sql_source": sql_source_query,
}
