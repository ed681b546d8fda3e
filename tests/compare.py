"""Run registered queries against DuckDB on the same files and report differences.

    python tests/compare.py <folder> [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def difference(frame, connection, sql: str) -> str | None:
    """None where both sides hold the same rows, else a short description."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = _rows(names, result.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    actual = _rows(frame.columns, [tuple(row) for row in frame.collect()])
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    if not actual:
        return "no rows"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} of {len(actual)} rows differ, e.g. {wrong[0]}" if wrong else None


def main(folder: str, names: list[str]) -> int:
    sys.path.insert(0, __file__.rsplit("/", 2)[0])
    from candlewick.plans.registry import ENTRIES
    from candlewick.session import build_session

    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                              "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    bad = 0
    for name, item in ENTRIES.items():
        if names and not any(name.startswith(wanted) for wanted in names):
            continue
        started = time.time()
        try:
            frame = item.build(spark, folder)
            problem = f"no SQL, {frame.count()} rows" if item.sql is None else difference(frame, connection, item.sql)
            bad += bool(problem) and item.sql is not None
        except Exception as error:  # report and go on with the next query
            problem, bad = f"{type(error).__name__}: {str(error)[:600]}", bad + 1
        print(f"{name:28s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
