"""Runs registered queries against their SQL counterparts: ``python tests/oracle_check.py sf0.01 [name ...]``."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import oracle_sql, queries  # noqa: E402

TYPES = {"tinyint": "TINYINT", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "boolean": "BOOLEAN"}
RAW = "region nation customer supplier part orders lineitem documents pages benchmark labels".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in RAW:
        connection.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return connection


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.date() if value.time() == dt.time() else value
    return value


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, connection, name: str, sf_dir: str) -> str | None:
    """None if equal, otherwise a description of the first difference."""
    df = queries()[name](spark, sf_dir)
    actual = canonical(df.columns, df.collect())
    cursor = connection.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    expected = canonical(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    theirs = {d[0]: str(d[1]) for d in cursor.description}
    differ = {c: (kind, theirs[c]) for c, kind in df.dtypes if TYPES[kind] != theirs[c]}
    if differ:
        return f"types differ: {differ}"
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    return next((f"{a} != {e}" for a, e in zip(actual, expected) if a != e), None)


if __name__ == "__main__":
    from salescast.session import local_session

    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/{sys.argv[1]}"
    database = duck(folder)
    for key in sys.argv[2:] or queries():
        start = time.perf_counter()
        if key in oracle_sql():
            result = compare(session, database, key, folder) or "equal"
        else:
            result = f"{len(queries()[key](session, folder).collect())} rows, no SQL"
        print(f"{key:28s} {time.perf_counter() - start:7.2f} s  {result}", flush=True)
