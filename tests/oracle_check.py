"""Run every registered query against its SQL: python tests/oracle_check.py [folder] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations")

# Spark type -> the type DuckDB should return
KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
    "float": "FLOAT", "date": "DATE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return connection


def rows_of(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows as text, columns by name, in a fixed order."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, connection, name: str, folder: str) -> str | None:
    """None when equal, else what differs."""
    import __spark_entry__ as entry

    result = entry.queries()[name](spark, folder)
    got = [tuple(row) for row in result.collect()]
    cursor = connection.execute(entry.oracle_sql()[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    want = cursor.fetchall()
    if sorted(result.columns) != sorted(types):
        return f"columns {sorted(result.columns)} / {sorted(types)}"
    wrong = {c: (t, types[c]) for c, t in result.dtypes if KINDS.get(t) != types[c]}
    if wrong:
        return f"types {wrong}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    a, b = rows_of(result.columns, got), rows_of(list(types), want)
    if a != b:
        return f"values {[x for x in zip(a, b) if x[0] != x[1]][:2]}"
    if not len(got):
        return "no rows"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from carelake.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session("oracle-check", 8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    names = sys.argv[2:] or list(entry.queries())
    failed = 0
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, connection, name, folder) if name in entry.oracle_sql() else "no SQL"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")
    return failed


if __name__ == "__main__":
    sys.exit(main())
