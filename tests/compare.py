"""Compare a query's rows with those of its SQL in DuckDB."""

from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def open_tables(folder):
    database = duckdb.connect()
    for name in TABLES:
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return database


def _plain(value):
    if isinstance(value, Decimal):
        return format(value, "f")
    return repr(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def in_order(names, rows):
    """Like ``rows_of``, in the order in which the rows came."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_plain(row[i]) for i in order) for row in rows]


def spark_rows(frame):
    return rows_of(frame.columns, [tuple(r) for r in frame.collect()])


def sql_rows(database, sql):
    result = database.execute(sql)
    return rows_of([c[0] for c in result.description], result.fetchall())
