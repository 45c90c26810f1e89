"""Comparison of a Spark result with the SQL that should give the same rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def sql_rows(con, sql: str):
    cursor = con.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def normal(columns, rows):
    """Rows as sorted tuples with the columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    tuples = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(tuples, key=repr)


def spark_rows(df):
    return df.columns, [tuple(r) for r in df.collect()]
