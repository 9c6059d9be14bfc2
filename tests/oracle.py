"""Compare registered queries with their SQL run by DuckDB on the same files.

    python -m tests.oracle /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sys
import time

import duckdb


def connect(folder: str):
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[:-len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.date() if value.time() == datetime.time(0) else value
    if isinstance(value, decimal.Decimal):
        return float(value)
    return value


def normal(columns, rows):
    """Rows with columns in name order, in a stable order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(plain(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(values, key=repr)


def kinds(pairs):
    """Comparable type names of (name, type) pairs."""
    alike = {"integer": "int", "varchar": "string", "bool": "boolean", "float": "double"}
    return {name: alike.get(kind.lower(), kind.lower()) for name, kind in pairs}


def compare(frame, connection, sql) -> str | None:
    """None when both results are equal, else what differs."""
    result = connection.execute(sql)
    described = [(d[0], str(d[1])) for d in result.description]
    left_columns, left = normal(frame.columns, [tuple(row) for row in frame.collect()])
    right_columns, right = normal([d[0] for d in described], result.fetchall())
    if left_columns != right_columns:
        return f"columns {left_columns} <> {right_columns}"
    left_kinds, right_kinds = kinds(frame.dtypes), kinds(described)
    if left_kinds != right_kinds:
        return f"types {sorted(set(left_kinds.items()) ^ set(right_kinds.items()))}"
    if left != right:
        only_left = [row for row in left if row not in set(right)][:3] if len(left) < 5000 else left[:1]
        only_right = [row for row in right if row not in set(left)][:3] if len(right) < 5000 else right[:1]
        return f"{len(left)} rows <> {len(right)} rows; Spark {only_left}; SQL {only_right}"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from klinark.session import local_session
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, connection = local_session(8), connect(folder)
    oracles, failed = oracle_sql(), 0
    for name, function in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = (compare(function(spark, folder), connection, oracles[name]) if name in oracles
                       else f"no SQL, {len(function(spark, folder).collect())} rows")
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:900]}"
        failed += problem is not None and not problem.startswith("no SQL")
        print(f"{'ok' if problem is None else 'DIFF':5} {time.time() - start:6.2f}s {name} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
