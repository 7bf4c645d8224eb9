"""Runs one query on Spark and its SQL on DuckDB and compares names, types and rows."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, sql: str, folder: str) -> list[str]:
    found = connect(folder).execute(sql)
    theirs_names = [d[0] for d in found.description]
    theirs_types = {d[0]: str(d[1]) for d in found.description}
    theirs = _rows(theirs_names, found.fetchall())
    ours = _rows(spark_df.columns, spark_df.collect())
    problems = []
    if sorted(spark_df.columns) != sorted(theirs_names):
        return [f"columns {sorted(spark_df.columns)} vs {sorted(theirs_names)}"]
    for name, kind in spark_df.dtypes:
        if KINDS.get(kind) != theirs_types[name]:
            problems.append(f"type of {name}: {kind} vs {theirs_types[name]}")
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} vs {len(theirs)}")
    elif ours != theirs:
        bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
        problems.append(f"{len(bad)} rows differ in {sorted(theirs_names)}, first {bad[0]}")
    if not theirs:
        problems.append("no rows")
    return problems
