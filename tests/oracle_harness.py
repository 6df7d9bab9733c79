"""Local stand-in for the driver's correctness gate.

Runs each registered Spark query and its DuckDB oracle on the same parquet
tables and compares row count, column names, column types and the multiset
of rows.  Usage:  python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tablekit.sources.tables import DRIVER_TABLES  # noqa: E402

SPARK_TO_DUCK = {
    "IntegerType": "INTEGER", "LongType": "BIGINT", "ShortType": "SMALLINT", "ByteType": "TINYINT",
    "StringType": "VARCHAR", "DoubleType": "DOUBLE", "FloatType": "FLOAT", "BooleanType": "BOOLEAN",
    "DateType": "DATE", "TimestampNTZType": "TIMESTAMP", "TimestampType": "TIMESTAMP WITH TIME ZONE",
    "BinaryType": "BLOB",
}


def spark_type_name(dt_) -> str:
    name = type(dt_).__name__
    if name == "DecimalType":
        return f"DECIMAL({dt_.precision},{dt_.scale})"
    if name == "ArrayType":
        return spark_type_name(dt_.elementType) + "[]"
    return SPARK_TO_DUCK.get(name, name)


def duck_con(sf_dir: str):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = [spark_type_name(f.dataType) for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(s_rows), spark_s=round(t1 - t0, 2))
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    d_types = [str(t) for t in con.execute(f"DESCRIBE {sql}").fetchall() and
               [r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()]]
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"cols spark={s_cols} duck={d_cols}")
    else:
        st = dict(zip(s_cols, s_types))
        dtp = dict(zip(d_cols, d_types))
        bad = {c: (st[c], dtp[c]) for c in s_cols if st[c] != dtp[c]}
        if bad:
            problems.append(f"types {bad}")
    if len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    if not problems:
        order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        dorder = [d_cols.index(s_cols[i]) for i in order]
        a = sorted((tuple(norm(r[i]) for i in order) for r in s_rows), key=_key)
        b = sorted((tuple(norm(r[i]) for i in dorder) for r in d_rows), key=_key)
        if a != b:
            diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
            problems.append(f"values differ, e.g. {diff}")
    return dict(name=name, ok=not problems, rows=len(s_rows), spark_s=round(t1 - t0, 2),
                problems=problems)


def main(argv):
    sf_dir = "/root/testdata/sf0.01"
    names = []
    for a in argv:
        if a.startswith("/"):
            sf_dir = a
        else:
            names.append(a)
    from tablekit.session import build_session
    import __spark_entry__ as E
    if os.environ.get("TABLEKIT_PLAIN_SESSION"):   # a session with Spark's defaults only
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = build_session()
    if os.environ.get("TABLEKIT_SESSION_TZ"):      # robustness: results must not depend on it
        spark.conf.set("spark.sql.session.timeZone", os.environ["TABLEKIT_SESSION_TZ"])
    if os.environ.get("TABLEKIT_ANSI"):             # e.g. "false": results must not depend on it
        spark.conf.set("spark.sql.ansi.enabled", os.environ["TABLEKIT_ANSI"])
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck_con(sf_dir)
    n_ok = n_bad = 0
    for name, fn in qs.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        try:
            r = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as ex:  # report and keep going
            r = dict(name=name, ok=False, problems=[f"{type(ex).__name__}: {str(ex)[:400]}"])
        if r["ok"] is False:
            n_bad += 1
        else:
            n_ok += 1
        print(r, flush=True)
    print(f"OK {n_ok}  FAIL {n_bad}")
    return n_bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
