"""Compare registered queries with their SQL, value by value, in DuckDB."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


def connect(sf_dir: str):
    import duckdb

    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return connection


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return v if v is None else str(v)


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def difference(spark, connection, sf_dir: str, query, sql: str) -> str | None:
    """None if equal, else a short description."""
    frame = query(spark, sf_dir)
    cursor = connection.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    if sorted(frame.columns) != sorted(expected_columns):
        return f"columns differ: {set(frame.columns) ^ set(expected_columns)}"
    expected = bag(expected_columns, cursor.fetchall())
    actual = bag(frame.columns, [tuple(r) for r in frame.collect()])
    if actual == expected:
        return None
    missing, extra = expected - actual, actual - expected
    text = f"{sum(actual.values())} rows, expected {sum(expected.values())}"
    for label, rest in (("missing", missing), ("extra", extra)):
        if rest:
            text += f"; {label} {sum(rest.values())} such as {next(iter(rest))}"
    return text


def main(sf_dir: str, names: list[str]) -> int:
    import __spark_entry__ as registry
    from claimstar.functions.session import session

    spark = session("compare", "local[8]", 8, {"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    queries, sqls = registry.queries(), registry.oracle_sql()
    failed = 0
    for name in names or queries:
        start = time.time()
        problem = difference(spark, connection, sf_dir, queries[name], sqls[name])
        failed += problem is not None
        print(f"{name:40s} {time.time() - start:6.1f}s {problem or 'equal'}"[:700], flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
