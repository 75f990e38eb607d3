"""Run each catalogue query on Spark and its SQL on DuckDB; compare row
counts, column names and an order-insensitive hash of the values.

    python scripts/check_oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def canon(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, int):
        return str(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(canon(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest(), lines


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    from perfmart.plans.catalog import ORACLE, QUERIES
    from perfmart.session import get_session

    spark = get_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for key, fn in QUERIES.items():
        if only and key not in only:
            continue
        t0 = time.time()
        df = fn(spark, sf_dir)
        scols = df.columns
        srows = [tuple(r) for r in df.collect()]
        t1 = time.time()
        if key not in ORACLE:
            print(f"{key:28s} spark={len(srows):7d} (no oracle) {t1 - t0:.1f}s", flush=True)
            continue
        res = con.execute(ORACLE[key])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        sh, sl = digest(scols, srows)
        oh, ol = digest(ocols, orows)
        ok = sorted(scols) == sorted(ocols) and len(srows) == len(orows) and sh == oh
        bad += not ok
        print(f"{key:28s} spark={len(srows):7d} oracle={len(orows):7d} "
              f"{'OK ' if ok else 'BAD'} {t1 - t0:.1f}s", flush=True)
        if not ok:
            if sorted(scols) != sorted(ocols):
                print("   cols spark-only:", sorted(set(scols) - set(ocols)),
                      "oracle-only:", sorted(set(ocols) - set(scols)))
            else:
                a, b = set(sl), set(ol)
                print("   sorted cols:", sorted(scols))
                for x in list(a - b)[:3]:
                    print("   spark only :", x[:400])
                for x in list(b - a)[:3]:
                    print("   oracle only:", x[:400])
    print("mismatches:", bad)


if __name__ == "__main__":
    main()
