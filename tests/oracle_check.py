"""Run Spark queries and their DuckDB oracle side by side and compare.

usage: python tests/oracle_check.py [sf_dir] [key ...]
"""
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, __import__("decimal").Decimal):
        return round(float(v), 6)
    return v


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    import __spark_entry__ as E
    from pricefold.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if only and k not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = sorted(df.columns)
            srows = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in orc:
            print(f"rows {k}: {len(srows)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            res = con.execute(orc[k])
            ocols = [d[0] for d in res.description]
            orows_raw = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(ocols) != cols:
            print(f"FAIL {k}: columns spark={cols} oracle={sorted(ocols)}")
            bad += 1
            continue
        idx = [ocols.index(c) for c in cols]
        orows = sorted((tuple(norm(r[i]) for i in idx) for r in orows_raw), key=repr)
        if srows == orows:
            print(f"ok   {k}: {len(srows)} rows ({ts:.1f}s)")
        else:
            bad += 1
            print(f"FAIL {k}: spark {len(srows)} rows vs oracle {len(orows)}")
            ss, oo = set(srows), set(orows)
            for r in list(ss - oo)[:3]:
                print("   spark only :", r)
            for r in list(oo - ss)[:3]:
                print("   oracle only:", r)
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
