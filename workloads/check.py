"""Run the queries against their SQL: ``python -m workloads.check [sf_dir] [name ...]``."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

from feedmill.session import build_session
from workloads.catalog import ENTRIES


def views(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    """NaN compares unequal to itself; give it a text instead."""
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def sorted_rows(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    """Columns by name and rows in one order, so that only content is compared."""
    places = sorted(range(len(names)), key=lambda place: names[place])
    ordered = [tuple(plain(row[place]) for place in places) for row in rows]
    return [names[place] for place in places], sorted(ordered, key=repr)


def duck_rows(connection: duckdb.DuckDBPyConnection, sql: str):
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    return sorted_rows(names, cursor.fetchall())


TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def duck_types(connection: duckdb.DuckDBPyConnection, sql: str) -> dict[str, str]:
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    return {row[0]: TYPES.get(row[1], row[1]) for row in described}


def differs(spark, connection, sf_dir: str, name: str) -> str | None:
    """What is wrong with a query, or None."""
    item = ENTRIES[name]
    frame = item.run(spark, sf_dir)
    names, rows = sorted_rows(frame.columns, frame.collect())
    if item.sql is None:
        return None if rows else "no rows"
    types = {field.name: field.dataType.simpleString() for field in frame.schema}
    expected_types = duck_types(connection, item.sql)
    if types != expected_types:
        return f"columns {types} against {expected_types}"
    _, expected = duck_rows(connection, item.sql)
    if len(rows) != len(expected):
        return f"{len(rows)} rows against {len(expected)}"
    for row, other in zip(rows, expected):
        if row != other:
            return f"{row} against {other}"
    return None


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    chosen = arguments[1:] or list(ENTRIES)
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = views(sf_dir), 0
    for name in chosen:
        start = time.perf_counter()
        try:
            problem = differs(spark, connection, sf_dir, name)
        except Exception as error:  # a broken query must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:30s} {time.perf_counter() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{len(chosen) - failed} of {len(chosen)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
