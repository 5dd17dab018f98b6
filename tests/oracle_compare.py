"""Compare a Spark result with its SQL twin, value by value."""

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


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("DECIMAL", str(value))
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple((k, plain(v)) for k, v in value.items())
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    mine = rows_of(spark_df.columns, [tuple(x) for x in spark_df.collect()])
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    other = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    if len(mine) != len(other):
        return f"rows {len(mine)} != {len(other)}"
    kinds = [{type(v) for row in side for v in [row[i]] if v is not None} for side in (mine, other) for i in range(len(names))]
    for i, name in enumerate(sorted(names)):
        a, b = kinds[i], kinds[i + len(names)]
        if a != b:
            return f"type of {name}: {a} != {b}"
    bad = [(a, b) for a, b in zip(mine, other) if a != b]
    if bad:
        return f"{len(bad)} of {len(mine)} rows differ; first: {sorted(names)}\n  spark {bad[0][0]}\n  sql   {bad[0][1]}"
    return None
