"""Run a registered query and its SQL on the same folder and compare the results as multisets."""

from __future__ import annotations

import datetime as dt
import decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


def _cell(value: object) -> object:
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime) and value.time() == dt.time():
        return value.date()
    return value


def _rows(names: list[str], rows: list) -> list[str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(_cell(row[i]) for i in order)) for row in rows)


# Spark type to SQL type name, for the types results may have.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def differences(actual: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty where names, types, row counts and values agree."""
    schema = {row[0]: row[1] for row in connection.execute(f"describe {sql}").fetchall()}
    if {name: TYPES.get(kind, kind) for name, kind in actual.dtypes} != schema:
        return [f"columns {actual.dtypes} against {schema}"]
    names, expected = list(schema), connection.execute(sql).fetchall()
    got, wanted = _rows(actual.columns, actual.collect()), _rows(names, expected)
    found = []
    if len(got) != len(wanted):
        found.append(f"{len(got)} rows against {len(wanted)}")
    pairs = [(a, b) for a, b in zip(got, wanted) if a != b]
    return found + [f"{a} against {b}" for a, b in pairs[:3]]
