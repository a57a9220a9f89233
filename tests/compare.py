"""Order-insensitive comparison of a Spark result with DuckDB on the same tables."""

import math
from collections import Counter
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _normalised(columns: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        Counter(tuple(_plain(row[i]) for i in order) for row in rows),
    )


def spark_result(frame: DataFrame) -> tuple[list[str], Counter]:
    return _normalised(frame.columns, frame.collect())


def duckdb_result(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    return _normalised([c[0] for c in cursor.description], cursor.fetchall())


def differences(left: tuple[list[str], Counter], right: tuple[list[str], Counter]) -> str:
    """Empty when equal, else a short account of what differs."""
    if left[0] != right[0]:
        return f"columns {left[0]} against {right[0]}"
    only_left, only_right = left[1] - right[1], right[1] - left[1]
    if not only_left and not only_right:
        return ""
    return (
        f"{sum(left[1].values())} rows against {sum(right[1].values())}; "
        f"only left {list(only_left)[:3]}; only right {list(only_right)[:3]}"
    )
