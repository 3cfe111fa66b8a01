"""Side-by-side run of a query in Spark and of its SQL in DuckDB."""

from __future__ import annotations

import datetime
import math
import pathlib
import sys

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.15g}")
    return value


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    result = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(result, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def spark_rows(df):
    return normal_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(connection, sql: str):
    result = connection.execute(sql)
    return normal_rows([c[0] for c in result.description], result.fetchall())


def duck_types(connection, sql: str) -> dict[str, str]:
    result = connection.execute(f"DESCRIBE {sql}")
    return {row[0]: row[1] for row in result.fetchall()}


def differences(spark_side, duck_side, show: int = 3) -> str:
    """Empty when both sides hold the same rows, else what differs."""
    if spark_side[0] != duck_side[0]:
        return f"columns {spark_side[0]} / {duck_side[0]}"
    if len(spark_side[1]) != len(duck_side[1]):
        return f"rows {len(spark_side[1])} / {len(duck_side[1])}"
    wrong = [(a, b) for a, b in zip(*(side[1] for side in (spark_side, duck_side))) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[:show]}" if wrong else ""
