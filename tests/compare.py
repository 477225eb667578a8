"""Order-insensitive comparison of a Spark result with the same query in SQL."""

from __future__ import annotations

import datetime as dt
import math
from decimal import Decimal
from pathlib import Path

import duckdb

NUMBER_DIGITS = 9


def normal(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.{NUMBER_DIGITS}g}") + 0.0
    if isinstance(value, Decimal):
        return f"decimal {value}"
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(normal(v) for v in value)
    return value


def row_key(row):
    return [(v is None, type(v).__name__, v if v is not None else "") for v in row]


def normal_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=row_key)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def sql_result(con, sql: str):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), normal_rows(columns, cursor.fetchall())


def spark_result(df):
    return sorted(df.columns), normal_rows(df.columns, [tuple(r) for r in df.collect()])
