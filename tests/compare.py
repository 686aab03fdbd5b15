"""Run the registered queries in Spark and their SQL in DuckDB, side by side.

``python -m tests.compare [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()[:10]
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, connection, query, sql: str, sf_dir: str) -> str | None:
    """None if both engines agree, else what differs."""
    result = query(spark, sf_dir)
    found = rows_of(result.columns, [tuple(r) for r in result.collect()])
    relation = connection.sql(sql)
    types = dict(zip(relation.columns, (str(t) for t in relation.types)))
    for name, kind in result.dtypes:
        if types.get(name) != _TYPES.get(kind, kind):
            return f"column {name}: {kind} / {types.get(name)}"
    if set(types) != set(result.columns):
        return f"columns {sorted(result.columns)} / {sorted(types)}"
    wanted = rows_of(relation.columns, relation.fetchall())
    if len(found) != len(wanted):
        return f"{len(found)} / {len(wanted)} rows"
    for left, right in zip(found, wanted):
        if left != right:
            return f"{left} / {right}"
    if not found:
        return "no rows"
    return None


if __name__ == "__main__":
    from tests.conftest import make_session
    from __spark_entry__ import oracle_sql, queries

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    chosen = sys.argv[2:] or list(queries())
    spark, connection = make_session(), connect(sf_dir)
    for name in chosen:
        started = time.time()
        try:
            problem = compare(spark, connection, queries()[name], oracle_sql()[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - started:.1f}s "
              f"{problem or ''}", flush=True)
