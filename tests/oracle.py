"""Rows of a query against rows of its SQL in DuckDB."""

from pathlib import Path

import duckdb


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).iterdir():
        con.execute(f"create view {path.name.split('.')[0]} as select * from '{path}'")
    return con


def rows_of(df) -> tuple[list[str], list[str]]:
    columns = sorted(df.columns)
    return columns, sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())


def expected(con, sql: str) -> tuple[list[str], list[str]]:
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(repr(tuple(r[i] for i in order)) for r in found.fetchall())
