"""Runs registered queries next to their SQL in DuckDB and compares all values."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def compare(spark, con, function, sql, sf_dir):
    """Difference between a query and its SQL as text, None if there is none, and the seconds taken."""
    start = time.time()
    df = function(spark, sf_dir)
    names, rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - start
    if sql is None:
        return (None if rows else "no rows"), seconds, len(rows)
    result = con.execute(sql)
    want_names, want = _rows([d[0] for d in result.description], result.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}", seconds, len(rows)
    if len(rows) != len(want):
        return f"{len(rows)} rows, SQL has {len(want)}", seconds, len(rows)
    for mine, theirs in zip(rows, want):
        if mine != theirs:
            return f"{mine} != {theirs}", seconds, len(rows)
        kinds = [(type(a), type(b)) for a, b in zip(mine, theirs) if a is not None and type(a) is not type(b)]
        if kinds:
            return f"types differ: {kinds} in {mine}", seconds, len(rows)
    return None, seconds, len(rows)
