import duckdb
import pytest

from oracle_compare import TABLES, digest

SMOKE = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert "l_shipdate" in df.columns


def test_every_query_has_an_oracle():
    from __spark_entry__ import oracle_sql, queries

    # Operators that SQL cannot express are held against brute force in their own tests.
    without = {name for name in queries() if name not in oracle_sql()}
    assert all(name == "pipeline" or name.startswith("op") for name in without)
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", ["csv_rejects", "precision", "ts_zoned", "update_rules", "json_rejects",
                                  "xml_bind", "avro_normalise", "raw_archive"])
def test_query_matches_oracle_at_smoke_scale(spark, name):
    from __spark_entry__ import oracle_sql, queries

    sdf = queries()[name](spark, SMOKE)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    rel = con.sql(oracle_sql()[name])
    assert digest(sdf.columns, [tuple(r) for r in sdf.collect()])[0] == digest(rel.columns, rel.fetchall())[0]


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR=SMOKE, BENCH_CPUS="2")
    out = subprocess.run([sys.executable, "bench.py", "csv_nulls", "sql_source"], cwd=root, env=env,
                         capture_output=True, text=True, timeout=600)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1, out.stdout
    result = json.loads(lines[0])
    assert result["unit"] == "sec" and set(result["queries"]) == {"csv_nulls", "sql_source"} and result["sf"] == 0.001
