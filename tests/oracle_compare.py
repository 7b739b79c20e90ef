"""Compare a Spark result with DuckDB's answer to its SQL, ignoring row and column order."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r)
    )


def differences(frame, con, sql: str) -> str | None:
    """None when equal, else a short account of the first difference."""
    answer = con.sql(sql)
    want_names, want = rows_of(answer.columns, answer.fetchall())
    got_names, got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if got_names != want_names:
        return f"columns {got_names} instead of {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows instead of {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"row {g} instead of {w}"
    return None
