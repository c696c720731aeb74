"""Run catalogue queries in Spark and DuckDB on the same folder and compare the rows.

``python tests/compare.py [folder] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
conversations""".split()


def duck(folder: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def _plain(value):
    return float(value) if type(value).__name__ == "Decimal" else value


def duck_rows(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())
    return sorted(columns), rows


def spark_rows(frame) -> tuple[list[str], Counter]:
    columns = sorted(frame.columns)
    return columns, Counter(tuple(_plain(v) for v in r) for r in frame.select(*[f"`{c}`" for c in columns]).collect())


def main(folder: str, wanted: list[str]) -> int:
    from weftline import plans
    from weftline.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("OFF")
    connection = duck(folder)
    oracle, bad = plans.oracle_sql(), 0
    for key, run in plans.queries().items():
        if wanted and key not in wanted:
            continue
        try:
            begun = time.time()
            columns, got = spark_rows(run(spark, folder))
            took = time.time() - begun
            if key not in oracle:
                print(f"{key}: {sum(got.values())} rows, no oracle, {took:.1f}s", flush=True)
                continue
            sql_columns, expected = duck_rows(connection, oracle[key])
            took_duck = time.time() - begun - took
            same = columns == sql_columns and got == expected
            bad += not same
            print(f"{key}: {'ok' if same else 'DIFFERENT'} {sum(got.values())}/{sum(expected.values())} rows, {took:.1f}s duck {took_duck:.1f}s", flush=True)
            if not same:
                print("  columns", columns, sql_columns)
                print("  only spark", list((got - expected).items())[:4])
                print("  only sql  ", list((expected - got).items())[:4])
        except Exception as problem:  # report and go on with the next query
            bad += 1
            print(f"{key}: FAILED {type(problem).__name__} {str(problem).splitlines()[0][:600]}", flush=True)
    return bad


if __name__ == "__main__":
    place = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    sys.exit(1 if main(place, sys.argv[2:]) else 0)
