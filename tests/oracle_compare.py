"""Run a Spark query and its DuckDB oracle on the same tables and compare them.

Checks, like the driver: the same column names, compatible types, the same
row count and the same multiset of rows (order-insensitive, exact values).
Usable from pytest and as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb
import pyarrow as pa

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _type_family(t: pa.DataType) -> str:
    if pa.types.is_integer(t):
        return f"int{t.bit_width}"
    if pa.types.is_floating(t):
        return "double"
    if pa.types.is_decimal(t):
        return f"decimal({t.precision},{t.scale})"
    if pa.types.is_string(t) or pa.types.is_large_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    if pa.types.is_date(t):
        return "date"
    if pa.types.is_boolean(t):
        return "bool"
    return str(t)


def _norm(v):
    if isinstance(v, float):
        return ("f", 0.0 if v == 0 else v) if not math.isnan(v) else ("f", "nan")
    if isinstance(v, decimal.Decimal):
        return ("d", v.normalize())
    if isinstance(v, dt.datetime):
        return ("t", v.replace(tzinfo=None))
    return ("v", v)


def _rows(table: pa.Table) -> list[tuple]:
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    rows = [tuple(_norm(v) for v in r) for r in zip(*data)]
    return sorted(rows, key=repr)


def compare(spark_df, sql: str, con: duckdb.DuckDBPyConnection) -> dict:
    t0 = time.time()
    s = spark_df.toArrow()
    t1 = time.time()
    d = con.sql(sql).to_arrow_table()
    t2 = time.time()
    out = {"rows_spark": s.num_rows, "rows_oracle": d.num_rows, "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    sc, dc = sorted(s.column_names), sorted(d.column_names)
    out["columns_ok"] = sc == dc
    if not out["columns_ok"]:
        out["columns"] = (sc, dc)
        out["ok"] = False
        return out
    st = {c: _type_family(s.schema.field(c).type) for c in sc}
    dtp = {c: _type_family(d.schema.field(c).type) for c in dc}
    out["types_ok"] = st == dtp
    if not out["types_ok"]:
        out["types"] = {c: (st[c], dtp[c]) for c in sc if st[c] != dtp[c]}
    rs, rd = _rows(s), _rows(d)
    out["values_ok"] = rs == rd
    if not out["values_ok"]:
        only_s = [r for r in rs if r not in set(rd)][:3]
        only_d = [r for r in rd if r not in set(rs)][:3]
        out["diff"] = {"spark_only": only_s, "oracle_only": only_d, "columns": sc}
    out["ok"] = out["columns_ok"] and out["types_ok"] and out["values_ok"] and s.num_rows == d.num_rows
    return out


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in keys or list(qs):
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print(f"{name:28s} rows-only {df.count()} rows", flush=True)
            continue
        try:
            res = compare(qs[name](spark, sf_dir), sqls[name], con)
        except Exception as e:  # report and go on with the next key
            res = {"ok": False, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        bad += not res["ok"]
        print(f"{name:28s} {'OK ' if res['ok'] else 'BAD'} {res}", flush=True)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
