"""Runs a registered query and its SQL side by side and compares the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def spark_rows(df):
    return sorted(df.columns), _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    return sorted(columns), _sorted_rows(columns, cursor.fetchall())


_KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def type_differences(df, con, sql):
    """Columns whose type differs between the two sides."""
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    theirs = {row[0]: row[1] for row in described}
    return {
        name: (kind, theirs.get(name))
        for name, kind in df.dtypes
        if _KINDS.get(kind, kind) != theirs.get(name)
    }
