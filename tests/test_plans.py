"""Physical-plan properties the operators are built to have."""

from pyspark.sql import functions as F

from sluice.operators.delimited import parse_delimited
from sluice.operators.messages_json import bind_json_messages
from sluice.operators.results import bad_rows, good_rows
from sluice.plans.message_queries import json_envelopes
from sluice.plans.table_queries import LINEITEM_HEADERS, lineitem_lines

SMOKE = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_parse_is_one_narrow_stage_with_one_split_per_row(spark):
    li = spark.read.parquet(f"{SMOKE}/lineitem.parquet")
    plan = plan_of(good_rows(parse_delimited(lineitem_lines(li), LINEITEM_HEADERS)))
    assert "Exchange" not in plan
    assert plan.count("from_csv(") == 1
    # The good/bad filter sits above the parse instead of copying it.
    filter_line = next(line for line in plan.splitlines() if "Filter" in line and "_error" in line)
    assert "from_csv" not in filter_line and "gettimestamp" not in filter_line


def test_only_needed_columns_are_scanned(spark):
    c = spark.read.parquet(f"{SMOKE}/customer.parquet")
    lines = c.select(F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name").alias("line"))
    plan = plan_of(good_rows(parse_delimited(lines, "k:LONG,n:STRING")))
    read_schema = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "c_custkey" in read_schema and "c_name" in read_schema
    assert "c_acctbal" not in read_schema and "c_mktsegment" not in read_schema


def test_sql_source_prunes_and_aggregates_partially(spark):
    from sluice.plans.record_queries import sql_source_query

    plan = plan_of(sql_source_query(spark, SMOKE))
    read_schema = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "o_custkey" not in read_schema and "o_orderdate" not in read_schema
    assert plan.count("HashAggregate") >= 2          # partial aggregation before the shuffle


def test_json_payload_parsed_once(spark):
    env = json_envelopes(spark.read.parquet(f"{SMOKE}/events.parquet"))
    parsed = bind_json_messages(env)
    for df in (good_rows(parsed), bad_rows(parsed)):
        plan = plan_of(df)
        assert plan.count("parseJson(") == 1
        assert "Exchange" not in plan


def test_no_query_outgrows_generated_code():
    """No plan falls back from generated code (Spark logs 'Code grows beyond 64 KB' when one does)."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = (
        "import sys; sys.path.insert(0, '.')\n"
        "from sluice.session import local_session\n"
        "spark = local_session(2)\n"
        "from sluice.plans import job_queries, message_queries, record_queries, table_queries\n"
        "for m in (table_queries, record_queries, message_queries, job_queries):\n"
        "    for name, query in m.QUERIES.items():\n"
        "        query(spark, '/root/testdata/sf0.001').write.format('noop').mode('overwrite').save()\n"
        "print('all ran')\n")
    done = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=900)
    assert "all ran" in done.stdout, done.stderr[-2000:]
    assert "grows beyond 64 KB" not in done.stderr
