"""Compares a Spark result with DuckDB's by values, whatever the order of rows and columns."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connected(directory: str):
    c = duckdb.connect()
    for t in TABLES:
        path = f"{directory}/{t}.parquet"
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return c


def shown(value) -> str:
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, list | tuple):
        return "[" + ",".join(map(shown, value)) + "]"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(shown(r[i]) for i in order) for r in rows)


def same(df, connection, sql: str) -> None:
    ours = rows_of(df.columns, df.collect())
    connection.execute(sql)
    names = [x[0] for x in connection.description]
    assert sorted(df.columns) == sorted(names)
    theirs = rows_of(names, connection.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs
