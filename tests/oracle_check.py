"""Compare registered queries with their DuckDB text: ``python tests/oracle_check.py <folder> [names]``."""

from __future__ import annotations

import datetime
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def _rows(columns: list[str], rows: list) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def _kind(dtype: str) -> str:
    kinds = {"string": "varchar", "int": "integer", "timestamp_ntz": "timestamp"}
    return kinds.get(dtype, dtype)


def difference(df, con, text: str) -> str | None:
    """None when names, types and rows agree; else what differs."""
    con.execute(text)
    theirs = {d[0]: str(d[1]).lower() for d in con.description}
    ours = {name: _kind(dtype) for name, dtype in df.dtypes}
    if ours != theirs:
        return f"schema {sorted(ours.items())} != {sorted(theirs.items())}"
    _, expected = _rows(list(theirs), con.fetchall())
    _, actual = _rows(df.columns, df.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} of {len(actual)} rows differ, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    import __spark_entry__ as spark_entry
    from pricelake.session import build_session

    folder, names = sys.argv[1], sys.argv[2:]
    session, con = build_session(), connect(folder)
    texts, failed = spark_entry.oracle_sql(), 0
    for name, build in spark_entry.queries().items():
        if name not in texts or names and name not in names:
            continue
        start = time.time()
        try:
            found = difference(build(session, folder), con, texts[name])
        except Exception as error:  # show every broken query, not the first one only
            found = f"{type(error).__name__}: {str(error)[:600]}"
        failed += found is not None
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{failed} failed")
