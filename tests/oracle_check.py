"""Run registered queries against their DuckDB oracles (like the driver does).

    python tests/oracle_check.py [sf_dir] [query ...]

Compares row count, column names and the multiset of rows (floats compared
to 12 significant digits; an exact mismatch is reported separately).
"""

from __future__ import annotations

import json
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, exact: bool):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if exact else float(f"{v:.12g}")
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, exact) for x in v)
    return v


def rows_of(cols, rows, exact):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], exact) for i in order) for r in rows]
    return sorted(out, key=repr)


SPARK_TO_DUCK = {"IntegerType": "INTEGER", "LongType": "BIGINT", "ShortType": "SMALLINT",
                 "FloatType": "FLOAT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
                 "BooleanType": "BOOLEAN", "ByteType": "TINYINT"}


def spark_types(df):
    return {f.name: SPARK_TO_DUCK.get(type(f.dataType).__name__, f.dataType.simpleString())
            for f in df.schema.fields}


def compare(spark, sf_dir: str, names=None) -> dict:
    import __spark_entry__ as E
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or sorted(qs):
        t0 = time.time()
        rec = {}
        try:
            df = qs[name](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
            rec["spark_s"] = round(time.time() - t0, 2)
            rec["rows"] = len(s_rows)
            if name in os_:
                t1 = time.time()
                rel = con.sql(os_[name])
                d_cols = list(rel.columns)
                d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
                d_rows = rel.fetchall()
                s_types = spark_types(df)
                rec["type_diff"] = {c: [s_types.get(c), d_types.get(c)] for c in d_cols
                                    if s_types.get(c) != d_types.get(c)}
                if not rec["type_diff"]:
                    del rec["type_diff"]
                rec["duck_s"] = round(time.time() - t1, 2)
                rec["oracle_rows"] = len(d_rows)
                rec["cols_ok"] = sorted(s_cols) == sorted(d_cols)
                rec["ok"] = rec["cols_ok"] and rows_of(s_cols, s_rows, False) == rows_of(d_cols, d_rows, False)
                rec["exact"] = rec["cols_ok"] and rows_of(s_cols, s_rows, True) == rows_of(d_cols, d_rows, True)
                if not rec["ok"]:
                    a = rows_of(s_cols, s_rows, False)
                    b = rows_of(d_cols, d_rows, False)
                    sa, sb = set(a), set(b)
                    rec["spark_only"] = [repr(x)[:300] for x in a if x not in sb][:3]
                    rec["oracle_only"] = [repr(x)[:300] for x in b if x not in sa][:3]
                    rec["cols"] = [s_cols, d_cols]
            else:
                rec["ok"] = None
        except Exception as e:  # report and go on
            rec["error"] = f"{type(e).__name__}: {str(e)[:800]}"
            rec["ok"] = False
        report[name] = rec
        print(name, json.dumps(rec), flush=True)
    return report


if __name__ == "__main__":
    from shardload.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = get_spark("local[8]", 8)
    rep = compare(spark, sf, names)
    bad = [k for k, v in rep.items() if v.get("ok") is False]
    print("FAILED:", bad)
    print("passed", sum(1 for v in rep.values() if v.get("ok")), "of", len(rep))
