"""Compare a Spark result with the SQL oracle's, as multisets of rows."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    return format(value, "f") if isinstance(value, Decimal) else str(value)


def rows(columns: list[str], data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in data)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if equal, else what differs."""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = rows(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    actual = rows(df.columns, df.collect())
    if actual == expected:
        return ""
    extra, lost = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows, expected {sum(expected.values())};"
        f" extra {list(extra)[:2]}; missing {list(lost)[:2]}"
    )
