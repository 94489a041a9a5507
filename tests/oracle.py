"""Compare every query with its oracle on the given tables.

    python -m tests.oracle [directory] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(names, rows) -> list[str]:
    """Rows as text, columns by name, sorted; -0.0 and 0.0 are one value, ints are not floats."""
    order = sorted(range(len(names)), key=lambda i: names[i])

    def show(value):
        return repr(value + 0.0) if isinstance(value, float) else repr(value)

    return sorted("|".join(show(row[i]) for i in order) for row in rows)


# Types by what their values are, so that a different type is a difference.
KINDS = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def difference(spark_df, connection, sql: str) -> str | None:
    """None if columns, types and rows agree; else what differs."""
    cursor = connection.execute(sql)
    types = {d[0]: str(d[1]) for d in cursor.description}
    expected = canonical(list(types), cursor.fetchall())
    found_types = {name: KINDS.get(kind, kind) for name, kind in spark_df.dtypes}
    if found_types != types:
        return f"types {sorted(set(found_types.items()) ^ set(types.items()))}"
    found = canonical(spark_df.columns, spark_df.collect())
    if len(found) != len(expected):
        return f"{len(found)} rows, expected {len(expected)}"
    wrong = [(a, b) for a, b in zip(found, expected) if a != b]
    return f"{len(wrong)} of {len(found)} rows differ, first {wrong[0]}" if wrong else None


def main() -> int:
    import __spark_entry__ as entry
    from lamina.session import get_spark

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("oracle", {"spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = connect(sf_dir), 0
    for name in sys.argv[2:] or entry.queries():
        if name not in entry.oracle_sql():
            continue
        start = time.time()
        df = entry.queries()[name](spark, sf_dir)
        problem = difference(df, connection, entry.oracle_sql()[name])
        failed += problem is not None
        print(f"{name:26s} {'ok' if problem is None else 'DIFFERS: ' + problem}  {time.time() - start:.1f}s", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main())
