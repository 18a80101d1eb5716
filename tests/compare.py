"""Run a registered query in Spark and its SQL in DuckDB, and compare the rows as bags."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def bag(rows, columns) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_bag(df) -> Counter:
    return bag(df.collect(), df.columns)


def duck_bag(con, sql) -> tuple[Counter, list[str], list[str]]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    return bag(result.fetchall(), columns), columns, types
