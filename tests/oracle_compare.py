"""Compare each registered Spark query with its DuckDB oracle (local check).

Mirrors the driver's gate: row count, column names and an order-insensitive
hash of the values with columns sorted by name.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    return v


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main(argv):
    import duckdb

    from __spark_entry__ import oracle_sql, queries
    from sluice.session import local_session

    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = local_session()
    for kv in os.environ.get("ORACLE_SPARK_CONF", "").split(","):
        if "=" in kv:
            k, v = kv.split("=", 1)
            spark.conf.set(k, v)
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    qs, oracle = queries(), oracle_sql()
    ok = True
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf)
            s_cols = sdf.columns
            s_rows = [tuple(r) for r in sdf.collect()]
        except Exception as exc:  # noqa: BLE001
            print(f"{name}: SPARK ERROR {type(exc).__name__}: {str(exc)[:300]}")
            ok = False
            continue
        ts = time.time() - t0
        if name not in oracle:
            print(f"{name}: rows={len(s_rows)} (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(oracle[name])
            d_cols = rel.columns
            d_rows = rel.fetchall()
        except Exception as exc:  # noqa: BLE001
            print(f"{name}: DUCKDB ERROR {str(exc)[:300]}")
            ok = False
            continue
        hs, ls = digest(s_cols, s_rows)
        hd, ld = digest(d_cols, d_rows)
        same = sorted(s_cols) == sorted(d_cols) and len(s_rows) == len(d_rows) and hs == hd
        ok &= same
        print(f"{name}: {'OK ' if same else 'MISMATCH'} rows spark={len(s_rows)} duck={len(d_rows)} {ts:.1f}s")
        if not same:
            if sorted(s_cols) != sorted(d_cols):
                print("   cols", sorted(s_cols), sorted(d_cols))
            only_s = sorted(set(ls) - set(ld))[:3]
            only_d = sorted(set(ld) - set(ls))[:3]
            for x in only_s:
                print("   spark:", x[:300])
            for x in only_d:
                print("   duck: ", x[:300])
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
