"""Compare a query's rows with its SQL run by DuckDB on the same files."""

from __future__ import annotations

import duckdb

from weirstone.schemas import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def kinds(schema) -> dict[str, str]:
    return {f.name: str(f.type).replace("large_", "") for f in schema}


def rows(table, columns) -> list[str]:
    return sorted(str(tuple(r.values())) for r in table.select(columns).to_pylist())


def differences(df, con, sql: str) -> list[str]:
    """Empty when row sets and column types agree."""
    got, want = df.toArrow(), con.execute(sql).to_arrow_table()
    columns = sorted(got.column_names)
    if columns != sorted(want.column_names):
        return [f"columns {columns} <> {sorted(want.column_names)}"]
    found = []
    if kinds(got.schema) != kinds(want.schema):
        found.append(f"types {kinds(got.schema)} <> {kinds(want.schema)}")
    a, b = rows(got, columns), rows(want, columns)
    if a != b:
        only_a, only_b = set(a) - set(b), set(b) - set(a)
        found.append(f"{len(a)} rows <> {len(b)}; e.g. {sorted(only_a)[:2]} <> {sorted(only_b)[:2]}")
    return found
