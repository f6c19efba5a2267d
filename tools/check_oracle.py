"""Run registered queries in Spark and their SQL oracles in DuckDB; compare row multisets.

usage: python tools/check_oracle.py [sf_dir] [name-prefix ...]"""
from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from stratum.proxies.registry import load_all  # noqa: E402
from stratum.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, bool):
        return v
    return v


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "smallint": "SMALLINT", "tinyint": "TINYINT",
                 "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE"}


def spark_type(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper().replace(" ", "")
    return SPARK_TO_DUCK.get(t, t.upper())


def type_diffs(df, description):
    st = {n: spark_type(t) for n, t in df.dtypes}
    dt_ = {d[0]: str(d[1]).replace(" ", "") for d in description}
    return {n: (st[n], dt_.get(n)) for n in st if n in dt_ and st[n].replace(" ", "") != dt_[n]}


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and sys.argv[1].startswith("/") else "/root/testdata/sf0.01"
    prefixes = [a for a in sys.argv[1:] if not a.startswith("/")]
    queries, oracle = load_all()
    extra = {"spark.sql.session.timeZone": os.environ["CHECK_TZ"]} if os.environ.get("CHECK_TZ") else None
    spark = build_session("local[8]", 8, extra=extra)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    ok = bad = 0
    for name in sorted(queries):
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            df = queries[name](spark, sf)
            cols = df.columns
            rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            traceback.print_exc(limit=3)
            continue
        ts = time.time() - t0
        if name not in oracle:
            print(f"SKIP {name}: no oracle ({len(rows)} rows, {ts:.1f}s)")
            continue
        try:
            r = con.execute(oracle[name])
            ocols = [d[0] for d in r.description]
            orows = r.fetchall()
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            continue
        msgs = []
        td = type_diffs(df, r.description)
        if td:
            msgs.append(f"types {td}")
        if sorted(cols) != sorted(ocols):
            msgs.append(f"columns spark={sorted(cols)} oracle={sorted(ocols)}")
        if len(rows) != len(orows):
            msgs.append(f"rows spark={len(rows)} oracle={len(orows)}")
        if not msgs:
            a, b = canon(cols, rows), canon(ocols, orows)
            if a != b:
                diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                msgs.append(f"values differ, e.g. {diff}")
        if msgs:
            bad += 1
            print(f"FAIL {name} ({ts:.1f}s): " + "; ".join(msgs))
        else:
            ok += 1
            print(f"ok   {name} ({len(rows)} rows, {ts:.1f}s)")
    print(f"passed {ok}, failed {bad}")


if __name__ == "__main__":
    main()
