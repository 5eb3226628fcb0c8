"""Run queries and their SQL side by side: ``python tests/compare.py SF_DIR [query ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def difference(spark_df, connection, sql: str) -> str:
    """Empty if columns and rows agree."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    expected = rows_of(names, result.fetchall())
    found = rows_of(spark_df.columns, (tuple(r) for r in spark_df.collect()))
    if expected == found:
        return ""
    extra, missing = found - expected, expected - found
    return (
        f"{sum(found.values())} rows vs {sum(expected.values())}; only Spark {sum(extra.values())}: "
        f"{str(list(extra)[:2])[:400]}; only SQL {sum(missing.values())}: {str(list(missing)[:2])[:400]}"
    )


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from reviewmill.session import local_session

    sf_dir, chosen = sys.argv[1], sys.argv[2:]
    spark, connection, oracles, failed = local_session(8), duck(sf_dir), oracle_sql(), 0
    for name, query in queries().items():
        if name not in oracles or (chosen and name not in chosen):
            continue
        started = time.time()
        try:
            problem = difference(query(spark, sf_dir), connection, oracles[name])
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name:26s} {time.time() - started:6.2f}s {problem}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
