"""Run a registered query in Spark and its oracle SQL in DuckDB and compare
row count, column names and an order-insensitive multiset of rows.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def duck_con(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, key: str, sf_dir: str) -> dict:
    from __spark_entry__ import oracle_sql, queries

    q = queries()[key]
    osql = oracle_sql().get(key)
    t = time.time()
    sdf = q(spark, sf_dir)
    cols = sdf.columns
    srows = [tuple(norm(v) for v in r) for r in sdf.collect()]
    st = time.time() - t
    res = {"key": key, "spark_rows": len(srows), "spark_sec": round(st, 2)}
    if osql is None:
        res["oracle"] = "none"
        return res
    cur = con.execute(osql)
    ocols = [d[0] for d in cur.description]
    orows = [tuple(norm(v) for v in r) for r in cur.fetchall()]
    res["oracle_rows"] = len(orows)
    res["cols_match"] = sorted(cols) == sorted(ocols)
    if not res["cols_match"]:
        res["cols_diff"] = (sorted(set(cols) - set(ocols)), sorted(set(ocols) - set(cols)))
        return res
    idx = [ocols.index(c) for c in cols]
    orows = [tuple(r[i] for i in idx) for r in orows]
    cs, co = Counter(srows), Counter(orows)
    res["values_match"] = cs == co
    if not res["values_match"]:
        only_s = list((cs - co).elements())[:3]
        only_o = list((co - cs).elements())[:3]
        res["sample_spark_only"] = only_s
        res["sample_oracle_only"] = only_o
        # first differing column
        if only_s and only_o:
            res["diff_cols"] = [c for c, a, b in zip(cols, only_s[0], only_o[0]) if a != b]
    return res


def main():
    from ledgerlake.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = local_session(8)
    con = duck_con(sf_dir)
    from __spark_entry__ import queries

    keys = keys or list(queries())
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, k, sf_dir)
        except Exception as e:  # report and continue
            r = {"key": k, "error": repr(e)[:800]}
        ok = r.get("values_match") and r.get("spark_rows") == r.get("oracle_rows")
        if r.get("oracle") == "none":
            ok = True
        bad += 0 if ok else 1
        print(("OK  " if ok else "FAIL"), r, flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
