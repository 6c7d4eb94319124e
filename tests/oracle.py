"""Run a query and its SQL twin over the same files and compare the rows, ignoring order."""

from __future__ import annotations

import datetime
import glob
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark, con, query, sql, folder) -> str | None:
    """None if equal, else what differs."""
    df = query(spark, folder)
    got_cols, got = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want_cols, want = _sorted_rows(rel.columns, rel.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    diff = [(g, w) for g, w in zip(got, want) if g != w or list(map(type, g)) != list(map(type, w))]
    return f"{len(diff)} rows differ, first {str(diff[0])[:600]}" if diff else None
