"""Compare every registered Spark query with its DuckDB oracle (local check).

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from graphweave.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if isinstance(v, list):
        return tuple(norm(x) for x in v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    if os.environ.get("PLAIN_SESSION"):  # a bare session like the driver's
        from pyspark.sql import SparkSession

        spark = (
            SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
            .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate()
        )
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session(8, 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t = time.time()
        try:
            df = qs[name](spark, sf)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t
        if name not in sqls:
            print(f"{name:28s} rows={len(srows)} (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(sqls[name])
            ocols = [d[0] for d in res.description]
            orows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:28s} SQL ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ok_cols = sorted(scols) == sorted(ocols)
        a, b = rows_of(scols, srows), rows_of(ocols, orows)
        ok = ok_cols and a == b
        if not ok:
            bad += 1
            print(f"{name:28s} MISMATCH cols_ok={ok_cols} spark={len(a)} oracle={len(b)} {ts:.1f}s")
            if not ok_cols:
                print("   spark cols", scols, "oracle cols", ocols)
            else:
                sa, sb = set(a), set(b)
                print("   only spark:", list(sa - sb)[:3])
                print("   only oracle:", list(sb - sa)[:3])
        else:
            print(f"{name:28s} ok rows={len(a)} {ts:.1f}s")
    print("bad", bad)


if __name__ == "__main__":
    main()
