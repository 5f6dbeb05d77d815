"""Runs the queries against DuckDB and reports differences.

Usage: python -m checks.compare [folder] [query ...]
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

from checks.oracles import ORACLES
from checks.queries import QUERIES
from vitarium.session import local_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    def cell(value):
        if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and value != value):
            return ""
        if isinstance(value, float):
            return f"{value:.6g}" if value != int(value) else str(int(value))
        return str(value)
    return sorted(tuple(cell(v) for v in row) for row in frame.itertuples(index=False, name=None))


def differences(spark, connection, sf_dir: str, name: str) -> tuple[list[str], int, float]:
    start = time.time()
    got = QUERIES[name](spark, sf_dir).toPandas()
    spent = time.time() - start
    wanted = connection.execute(ORACLES[name]).df()
    if sorted(got.columns) != sorted(wanted.columns):
        return [f"columns {sorted(got.columns)} / {sorted(wanted.columns)}"], len(got), spent
    a, b = canonical(got), canonical(wanted)
    notes = []
    if a != b:
        only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
        notes.append(f"{len(a)} / {len(b)} rows; only in Spark {len(only_a)}: {only_a[:2]}; "
                     f"only in SQL {len(only_b)}: {only_b[:2]}")
    return notes, len(got), spent


def main() -> None:
    arguments = sys.argv[1:]
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    bad = 0
    for name in arguments[1:] or QUERIES:
        try:
            notes, rows, spent = differences(spark, connection, sf_dir, name)
        except Exception as problem:
            notes, rows, spent = [f"{type(problem).__name__}: {str(problem)[:600]}"], -1, 0.0
        bad += bool(notes)
        print(f"{'DIFF' if notes else 'same'} {name}: {rows} rows, {spent:.1f} s {' '.join(notes)}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main()
