"""Running a query and its SQL twin side by side."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("dec", str(value))
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return (type(value).__name__, value)


def rows(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in data)


_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}


def _sql_type(spark_type: str) -> str:
    return _TYPES.get(spark_type, spark_type.upper())


def differences(spark_df, db, sql: str) -> str:
    """Empty when both sides agree in columns, types as Python sees them, and rows."""
    mine = spark_df.collect()
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    mine_types = {n: _sql_type(t) for n, t in spark_df.dtypes}
    their_types = {d[0]: str(d[1]) for d in cursor.description}
    if mine_types != their_types:
        return f"types {sorted(set(mine_types.items()) ^ set(their_types.items()))}"
    a, b = rows(spark_df.columns, mine), rows(names, theirs)
    if a == b:
        return ""
    return f"rows {len(mine)} vs {len(theirs)}; only ours {list((a - b).items())[:3]}; only SQL {list((b - a).items())[:3]}"
