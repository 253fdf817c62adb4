"""Compare a Spark result with a SQL result on the same tables, order-insensitively."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(folder, f"{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    return repr(v)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_table(df):
    return table_of(df.columns, [tuple(r) for r in df.collect()])


def sql_table(con, sql):
    res = con.execute(sql)
    return table_of([d[0] for d in res.description], res.fetchall())


def difference(spark_side, sql_side) -> str | None:
    (c1, r1), (c2, r2) = spark_side, sql_side
    if c1 != c2:
        return f"columns {c1} / {c2}"
    if len(r1) != len(r2):
        return f"{len(r1)} rows / {len(r2)} rows"
    if r1 != r2:
        bad = [(a, b) for a, b in zip(r1, r2) if a != b]
        return f"{len(bad)} rows differ, first: {bad[0]}"
    return None
