"""Compare every registered query with its SQL: ``python tests/check_oracle.py [folder] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from tickloom.session import build_session  # noqa: E402


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        found = f"{file}/*.parquet" if file.is_dir() else file
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{found}'")
    return connection


def lines(frame: pd.DataFrame) -> list[str]:
    """Rows as sorted text, columns in name order."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[name]):
            frame[name] = frame[name].astype("datetime64[us]").astype(str)
        elif frame[name].dtype == object:
            frame[name] = frame[name].map(lambda v: str(v)[:10] if hasattr(v, "year") else v)
    return sorted(map(str, frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None)))


def compare(spark, connection, name: str, folder: str) -> str:
    start = time.time()
    ours = contract.queries()[name](spark, folder)
    result = ours.toPandas()
    spent = f"{time.time() - start:6.2f}s {len(result):>7} rows"
    sql = contract.oracle_sql().get(name)
    if sql is None:
        return f"rows only {spent}"
    relation = connection.sql(sql)
    expected = relation.df()
    kinds = dict(zip(relation.columns, map(str, relation.types)))
    if sorted(kinds) != sorted(ours.columns):
        return f"COLUMNS {spent} {sorted(kinds)} {sorted(ours.columns)}"
    for column in kinds:
        if kinds[column] == "DATE":
            expected[column] = expected[column].dt.date.astype(object).where(expected[column].notna(), None)
    a, b = lines(result), lines(expected)
    if a != b:
        wrong = [pair for pair in zip(a, b) if pair[0] != pair[1]][:3]
        return f"DIFFERS {spent} vs {len(expected)}: {wrong}"
    types = {n: (t, kinds[n]) for n, t in ours.dtypes if TYPES.get(t) != kinds[n]}
    return f"ok {spent} {types or ''}"


TYPES = {"string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER",
         "timestamp": "TIMESTAMP", "date": "DATE"}

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        try:
            verdict = compare(spark, duck(folder), name, folder)
        except Exception as problem:  # noqa: BLE001 - reported per query
            verdict = f"ERROR {str(problem)[:600]}"
        bad += not verdict.startswith(("ok", "rows"))
        print(f"{name:24} {verdict}", flush=True)
    print("bad:", bad)
    sys.exit(bool(bad))
