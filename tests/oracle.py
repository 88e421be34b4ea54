"""Comparison of a query with its SQL on the same tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


def _plain(value):
    if isinstance(value, float):
        return "null" if math.isnan(value) else f"{value:.6f}"
    return "null" if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, db, query, sql, sf_dir):
    """(columns match, rows match, Spark rows, SQL rows)."""
    frame = query(spark, sf_dir)
    answer = db.execute(sql)
    names = [d[0] for d in answer.description]
    ours, theirs = rows_of(frame.columns, frame.collect()), rows_of(names, answer.fetchall())
    return sorted(frame.columns) == sorted(names), ours == theirs, ours, theirs
