"""Run queries on Spark and their SQL on DuckDB and compare whole results.

    python tests/compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=_key)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return columns, rows_of(columns, result.fetchall())


def difference(got, want):
    """None if equal, else what differs first."""
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        for x, y in zip(a, b):
            nan = isinstance(x, float) and math.isnan(x) or isinstance(y, float) and math.isnan(y)
            if nan or x != y or type(x) is not type(y):
                return f"{a} != {b}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    from verdance.registry import QUERIES
    from verdance.session import get_session

    spark = get_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name in names or QUERIES:
        q = QUERIES[name]
        started = time.time()
        try:
            df = q(spark, sf_dir)
            got = spark_rows(df)
            took = time.time() - started
            if q.sql is None:
                print(f"{name:28} {len(got):8} rows {took:6.2f}s (no SQL)")
                continue
            columns, want = duck_rows(con, q.oracle())
            wrong = difference(got, want)
            if sorted(columns) != sorted(df.columns):
                wrong = f"columns {df.columns} != {columns}"
            if not want:
                wrong = wrong or "EMPTY"
        except Exception as error:  # report and go on with the next query
            wrong, took, got = f"{type(error).__name__}: {str(error)[:1500]}", 0, []
        failed += wrong is not None
        print(f"{name:28} {len(got):8} rows {took:6.2f}s {'ok' if wrong is None else 'DIFF ' + wrong}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1], sys.argv[2:])))
