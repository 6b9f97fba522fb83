"""Value-by-value comparison of a Spark result with DuckDB over the same sample files."""

import math
import os

import duckdb

SAMPLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in SAMPLES.split():
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def _sortable(row):
    return tuple((value is None, str(type(value)), str(value)) for value in row)


def rows_of(columns, rows, ordered=False):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return plain if ordered else sorted(plain, key=_sortable)


def differences(df, sql: str, folder: str, ordered: bool = False) -> list[str]:
    cursor = connect(folder).execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall(), ordered)
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()], ordered)
    found = []
    if sorted(names) != sorted(df.columns):
        found.append(f"columns {sorted(df.columns)} instead of {sorted(names)}")
    if len(expected) != len(actual):
        found.append(f"{len(actual)} rows instead of {len(expected)}")
    for a, e in zip(actual, expected):
        if a != e or [type(v) for v in a] != [type(v) for v in e]:
            found.append(f"{a} instead of {e}")
    return found
