"""Compare a Spark result with DuckDB on the same files."""

from __future__ import annotations

import datetime
import decimal

import duckdb

from newsroster.catalog.landed import BASE

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN",
         "double": "DOUBLE", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "array<string>": "VARCHAR[]"}


def connect(folder: str):
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _rows(rows, order):
    return sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows),
        key=lambda r: tuple((v is not None, str(type(v)), v) for v in r))


def differences(df, con, sql: str) -> list[str]:
    """What differs between the two results; empty if nothing."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = [str(d[1]) for d in cursor.description]
    expected = cursor.fetchall()
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    ours = dict(df.dtypes)
    for name, kind in zip(names, kinds):
        if TYPES.get(ours[name], ours[name]) != kind:
            found.append(f"type of {name}: {ours[name]} != {kind}")
    actual = df.collect()
    left = _rows(actual, [df.columns.index(n) for n in sorted(names)])
    right = _rows(expected, [names.index(n) for n in sorted(names)])
    if len(left) != len(right):
        found.append(f"rows {len(left)} != {len(right)}")
    if left != right:
        only_left = [r for r in left if r not in set(right)][:2]
        only_right = [r for r in right if r not in set(left)][:2]
        found.append(f"spark only {only_left}\n   sql only {only_right}")
    if not left:
        found.append("no rows")
    return found
