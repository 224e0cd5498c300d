"""Compare registered queries with DuckDB on the same files; also runnable by hand."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def canonical(columns, rows):
    """Columns by name, rows in one order, values as comparable text with their type."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(repr(_plain(row[i])) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table)


def spark_side(frame):
    return canonical(frame.columns, [tuple(row) for row in frame.collect()])


def duck_side(connection, sql):
    result = connection.execute(sql)
    return canonical([c[0] for c in result.description], result.fetchall())


# Spark and DuckDB names of the same column type.
SAME_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def type_differences(frame, connection, sql):
    duck = {row[0]: row[1] for row in connection.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        (name, kind, duck.get(name))
        for name, kind in frame.dtypes
        if SAME_TYPES.get(kind) != duck.get(name)
    ]


LOCAL = {"spark.ui.enabled": "false", "spark.driver.memory": "8g"}


def main() -> None:
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries

    from tripfold.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("oracle-check", "local[8]", 8, **LOCAL)
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracle = connect(sf_dir), oracle_sql()
    failed = 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            frame = run(spark, sf_dir)
            got, expected = spark_side(frame), duck_side(connection, oracle[name])
            types = type_differences(frame, connection, oracle[name])
        except Exception as error:
            failed += 1
            print(f"{name:32} ERROR {str(error)[:600]}")
            continue
        same = got == expected
        failed += not same or bool(types)
        label = "ok" if same else "DIFFERENT"
        print(f"{name:32} {label} rows={len(got[1])} {time.time() - started:.2f}s {types or ''}")
        if not same:
            if got[0] != expected[0]:
                print("  columns", got[0], expected[0])
            only_spark = sorted(set(got[1]) - set(expected[1]))
            only_duck = sorted(set(expected[1]) - set(got[1]))
            print("  rows", len(got[1]), len(expected[1]), len(only_spark), len(only_duck))
            print("  ", only_spark[:2], "\n  ", only_duck[:2])
    print("failed:", failed)


if __name__ == "__main__":
    main()
