"""Spark-vs-DuckDB parity: same column names, same row count, same multiset
of rows (order-insensitive).  Values are normalised to text per type so a
DECIMAL, a TIMESTAMP or a DOUBLE compares by value, not by Python class."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v.to_integral_value() else str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE",
          "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}


def spark_type_as_duck(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper().replace(" ", "")
    return _TYPES.get(t, t.upper())


def type_mismatches(sdf, res) -> list[str]:
    s_types = {f.name: spark_type_as_duck(f.dataType.simpleString()) for f in sdf.schema.fields}
    d_types = {d[0]: str(d[1]).replace(" ", "") for d in res.description}
    return [f"{c}: spark {s_types[c]} vs oracle {d_types.get(c)}" for c in s_types
            if c in d_types and s_types[c] != d_types[c]]


def compare(spark, sf_dir: str, name: str, fn, sql: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows), "spark_sec": round(t1 - t0, 2)}
    out["columns_match"] = sorted(s_cols) == sorted(d_cols)
    out["type_mismatches"] = type_mismatches(sdf, res)
    if not out["columns_match"]:
        out["detail"] = f"spark {sorted(s_cols)} vs oracle {sorted(d_cols)}"
        out["ok"] = False
        return out
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    out["ok"] = a == b
    if not out["ok"]:
        sa, sb = set(a), set(b)
        out["detail"] = f"only spark {sorted(sa - sb)[:3]} only oracle {sorted(sb - sa)[:3]}"
    return out


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as e
    from tierline.session import get_spark

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = get_spark()
    con = duck(sf_dir)
    q, o = e.queries(), e.oracle_sql()
    bad = 0
    for name, fn in q.items():
        if only and name not in only:
            continue
        if name not in o:
            df = fn(spark, sf_dir)
            print(f"{name:24s} rows-only {df.count()}")
            continue
        try:
            r = compare(spark, sf_dir, name, fn, o[name], con)
        except Exception as ex:  # noqa: BLE001
            r = {"name": name, "ok": False, "detail": repr(ex)[:400]}
        bad += not r["ok"]
        print(f"{name:24s} {'OK ' if r['ok'] else 'BAD'} {r.get('spark_rows')}/{r.get('oracle_rows')} "
              f"{r.get('spark_sec', '')}s {r.get('detail', '')} {r.get('type_mismatches') or ''}", flush=True)
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
