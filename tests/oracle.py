"""Compare registered queries with their SQL twins in DuckDB.

    python tests/oracle.py [--large] [sf_dir] [query ...]

With --large every size check says "too large for one task", so the small
tables take the routes of large ones.
"""

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return ""
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return f"{float(v):.9g}"
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """None when equal, else a short account of the difference."""
    got = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = _rows(df.columns, got), _rows(names, want)
    for x, y in zip(a, b):
        if x != y:
            return f"first difference\n   spark {x}\n   sql   {y}\n   cols  {sorted(names)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    sql_types = {d[0]: str(d[1]) for d in cur.description}
    off = {c: (t, sql_types[c]) for c, t in df.dtypes if t in kinds and kinds[t] != sql_types[c]}
    return f"types {off}" if off else None


def force_large_routes():
    from vintage.functions import ordering

    ordering.SINGLE_TASK_ROWS = ordering.EXACT_ROWS = ordering.BROADCAST_ROWS = 0


def main():
    from pyspark.sql import SparkSession

    from __spark_entry__ import oracle_sql, queries

    args = [a for a in sys.argv[1:] if a != "--large"]
    if "--large" in sys.argv:
        force_large_routes()
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(queries())
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names:
        t0 = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            sql = oracle_sql().get(name)
            note = compare(df, con, sql) if sql else f"no SQL, {len(df.collect())} rows"
        except Exception as e:  # noqa: BLE001
            note = f"{type(e).__name__}: {str(e)[:600]}"
        bad = note is not None and not note.startswith("no SQL")
        failed += bad
        print(f"{'FAIL' if bad else 'ok  '} {name:32s} {time.time() - t0:6.2f}s {note or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
