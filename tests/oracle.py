"""Runs a registered query and its SQL side by side and compares rows as multisets."""

from __future__ import annotations

import datetime
import decimal
import pathlib
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        path = pathlib.Path(folder) / f"{table}.parquet"
        if path.exists():
            files = path / "*.parquet" if path.is_dir() else path
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{files}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return ("dec", str(value))
    if isinstance(value, datetime.datetime):
        return ("ts", value.replace(tzinfo=None).isoformat())
    if isinstance(value, float):
        return ("f", repr(value))
    if isinstance(value, bool):
        return ("b", value)
    return value


def multiset(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


SAME_TYPE = {
    "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "BOOLEAN": "boolean",
    "DATE": "date", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz",
}


def type_differences(frame, relation) -> list[str]:
    told = {
        name: SAME_TYPE.get(str(kind), str(kind).lower())
        for name, kind in zip(relation.columns, relation.types)
    }
    return [f"{n}: {k} / {told.get(n)}" for n, k in frame.dtypes if told.get(n) != k]


def compare(spark, con, query, sql: str, folder: str) -> tuple[list[str], int]:
    frame = query(spark, folder)
    got = frame.collect()
    relation = con.sql(sql)
    problems = []
    if sorted(frame.columns) != sorted(relation.columns):
        return [f"columns {frame.columns} / {relation.columns}"], len(got)
    problems += type_differences(frame, relation)
    left, right = multiset(frame.columns, got), multiset(relation.columns, relation.fetchall())
    if left != right:
        problems.append(
            f"rows {sum(left.values())} / {sum(right.values())}; "
            f"spark only {list((left - right).items())[:3]}; "
            f"sql only {list((right - left).items())[:3]}"
        )
    return problems, len(got)
