"""Run registered queries against their SQL; used by the tests and by hand.

    python tests/compare.py [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    return v


def _rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


def difference(df, con, sql: str) -> str | None:
    """None when both sides agree, else a short description."""
    result = con.execute(sql)
    expected_columns = [d[0] for d in result.description]
    expected = _rows(expected_columns, result.fetchall())
    actual = _rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(expected_columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} expected {sorted(expected_columns)}"
    if not expected:
        return "no rows"
    if actual == expected:
        return None
    only = [r for r in actual if r not in set(expected)][:3]
    missing = [r for r in expected if r not in set(actual)][:3]
    return f"{len(actual)} rows, expected {len(expected)}\n   got  {only}\n   want {missing}"


if __name__ == "__main__":
    import __spark_entry__ as contract
    from ticktide.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = local_session("compare"), connect(sf)
    oracles, bad = contract.oracle_sql(), 0
    for name, build in contract.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            df = build(spark, sf)
            problem = difference(df, con, oracles[name]) if name in oracles else (
                None if df.count() else "no rows")
        except Exception as error:  # noqa: BLE001 - report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} {time.time() - began:.2f}s {'' if name in oracles else '(rows only) '}"
              f"{problem or ''}", flush=True)
    print(f"{bad} failed")
