"""Side-by-side run of a query and its SQL counterpart."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if value is None:
        return "~null"
    if isinstance(value, float):
        return "~nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return str(value)
    return str(value)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(tuple(_cell(r[n]) for n in names) for r in df.collect())


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    names = sorted(columns)
    order = [columns.index(n) for n in names]
    return names, sorted(tuple(_cell(r[i]) for i in order) for r in cursor.fetchall())


def difference(df, con, sql) -> str | None:
    """None when both agree, otherwise a short account of the first difference."""
    left_names, left = spark_rows(df)
    right_names, right = sql_rows(con, sql)
    if left_names != right_names:
        return f"columns {left_names} vs {right_names}"
    if left == right:
        return None
    only_left = [r for r in left if r not in set(right)][:3]
    only_right = [r for r in right if r not in set(left)][:3]
    return f"rows {len(left)} vs {len(right)}; only spark {only_left}; only sql {only_right}"
