"""Run registered queries on Spark and their checking SQL on DuckDB and compare all values.

    python tests/compare.py [data folder] [query name parts ...]
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import time
from decimal import Decimal

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def spark_session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, Decimal):
        return format(v.normalize() + 0, "f")
    if isinstance(v, float):
        return repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return repr(v) if isinstance(v, bool) else str(v)


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    started = time.time()
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    spent = time.time() - started
    started = time.time()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows_of(names, cursor.fetchall())
    note = f"{len(got)} rows, spark {spent:.2f} s, duckdb {time.time() - started:.2f} s"
    if sorted(df.columns) != sorted(names):
        return False, f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    if len(got) != len(want):
        return False, f"rows differ: spark {len(got)} duckdb {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            diff = [(n, a, b) for n, a, b in zip(sorted(names), g, w) if a != b]
            return False, f"values differ: {diff[:4]}"
    return True, note


def main() -> int:
    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    parts = args[1:]
    spark, con, sql = spark_session(), duck(sf_dir), entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        try:
            if name in sql:
                ok, note = compare(spark, con, name, query, sql[name], sf_dir)
            else:
                ok, note = True, f"{len(query(spark, sf_dir).collect())} rows, no checking SQL"
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:500]}"
        bad += not ok
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print(f"{bad} failed")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
