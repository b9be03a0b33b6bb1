"""Compare queries with their SQL twins: python tests/oracle_check.py [sf] [name ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir) -> str | None:
    """None when equal, otherwise what differs."""
    frame = query(spark, sf_dir)
    left = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    right = rows_of(columns, cursor.fetchall())
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)}"
    if not left:
        return "no rows"
    bad = [(a, b) for a, b in zip(left, right) if a != b or list(map(type, a)) != list(map(type, b))]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main() -> int:
    import __spark_entry__ as entry
    from ratewise.session import get_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session(
        "oracle-check", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
           "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or list(queries):
        started = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, name, queries[name], oracle[name], sf_dir)
            else:
                problem = None if queries[name](spark, sf_dir).count() else "no rows"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        failed += problem is not None
        kind = "oracle" if name in oracle else "rows"
        print(f"{name:32s} {kind:6s} {time.time() - started:6.1f}s {problem or 'ok'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
