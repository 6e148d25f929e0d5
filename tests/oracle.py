"""Run registered queries against their SQL: ``python -m tests.oracle [sf_dir] [query ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(df, con, sql: str) -> tuple[int, str | None]:
    """(number of rows, what differs or None)."""
    result = con.execute(sql)
    expected_columns = [c[0] for c in result.description]
    expected = _rows(expected_columns, result.fetchall())
    found = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(expected_columns):
        return len(found), f"columns {sorted(df.columns)} instead of {sorted(expected_columns)}"
    if len(found) != len(expected):
        return len(found), f"{len(found)} rows instead of {len(expected)}"
    for a, b in zip(found, expected, strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return len(found), f"{a} instead of {b}"
    return len(found), None


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark, con, sqls, bad = make_session(), connect(sf_dir), oracle_sql(), 0
    for name, run in queries().items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            rows, problem = (
                compare(df, con, sqls[name]) if name in sqls else (df.count(), None)
            )
        except Exception as e:  # noqa: BLE001
            rows, problem = -1, f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:28s} {rows:8d} rows {time.time() - started:6.2f} s  {problem or 'ok'}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
