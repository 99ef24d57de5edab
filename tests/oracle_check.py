"""Row-by-row comparison of a registered query with its oracle."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return Counter(tuple(_plain(row[k]) for k in order) for row in rows)


def differences(df, connection, sql: str) -> list[str]:
    """Empty if both sides have the same columns and the same rows."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    found = _rows(df.columns, df.collect())
    extra, absent = found - expected, expected - found
    if not extra and not absent:
        return [] if found else ["no rows on either side"]
    report = [f"{sum(found.values())} rows, oracle {sum(expected.values())}"]
    report += [f"only in Spark:  {r}" for r in list(extra)[:4]]
    report += [f"only in oracle: {r}" for r in list(absent)[:4]]
    return report
