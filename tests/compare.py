"""Runs registered queries against their SQL oracle."""

from __future__ import annotations

import math
import pathlib

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """DuckDB with a view per Parquet table."""
    con = duckdb.connect()
    for path in sorted(pathlib.Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return round(value, 9)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return names, sorted(table, key=repr)


def differences(frame, con, sql) -> str | None:
    """None when both sides hold the same rows, else what differs first."""
    got = _sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = con.execute(sql)
    wanted = _sorted_rows([d[0] for d in result.description], result.fetchall())
    if got[0] != wanted[0]:
        return f"columns {got[0]} != {wanted[0]}"
    if len(got[1]) != len(wanted[1]):
        return f"{len(got[1])} rows != {len(wanted[1])} rows"
    for mine, theirs in zip(got[1], wanted[1]):
        if mine != theirs:
            return f"{mine} != {theirs}"
        if [type(a) for a in mine] != [type(b) for b in theirs]:
            return f"types {mine!r} != {theirs!r}"
    return None
