"""Compares registered queries with their SQL on DuckDB; ``python tests/oracle.py [name...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _value(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x)
    return x if x is None or isinstance(x, (str, bool)) else str(x)


def rows_of(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> tuple[int, int, list[str]]:
    """(rows, expected rows, differences)"""
    got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    problems = []
    if sorted(df.columns) != sorted(names):
        problems.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    elif got != expected:
        missing = [r for r in expected if r not in set(got)][:3]
        extra = [r for r in got if r not in set(expected)][:3]
        problems.append(f"missing {missing} extra {extra}")
    return len(got), len(expected), problems


def main(names: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name, build in e.queries().items():
        if names and name not in names:
            continue
        begin = time.time()
        try:
            sql = e.oracle_sql().get(name)
            df = build(spark, sf_dir)
            if sql is None:
                print(f"{name}: {df.count()} rows, no SQL, {time.time() - begin:.1f}s")
                continue
            got, expected, problems = compare(df, con, sql)
            bad += bool(problems)
            print(f"{name}: {'FAIL' if problems else 'ok'} {got}/{expected} {time.time() - begin:.1f}s {problems or ''}")
        except Exception as error:
            bad += 1
            print(f"{name}: ERROR {str(error)[:1500]}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
