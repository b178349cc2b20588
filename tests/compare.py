"""Run registered queries next to their SQL counterparts.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(table) -> tuple[list[tuple[str, str]], list[tuple]]:
    """Columns by name with a coarse type, and sorted rows."""
    table = table.select(sorted(table.column_names))
    columns = [(f.name, _kind(str(f.type))) for f in table.schema]
    values = [c.to_pylist() for c in table.columns]
    rows = [tuple(_plain(v) for v in row) for row in zip(*values, strict=True)]
    return columns, sorted(rows, key=repr)


def _kind(name: str) -> str:
    return "string" if "string" in name or name == "large_utf8" else name


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def compare(spark, con, sf_dir: str, name: str, query, sql: str | None) -> tuple[str, int]:
    result = query(spark, sf_dir).toArrow()
    if sql is None:
        return "rows only", result.num_rows
    expected = con.sql(sql).to_arrow_table()
    have, want = canonical(result), canonical(expected)
    if have[0] != want[0]:
        return f"SCHEMA {sorted(set(have[0]) ^ set(want[0]))}", result.num_rows
    if len(have[1]) != len(want[1]):
        return f"ROWS {len(have[1])} != {len(want[1])}", result.num_rows
    for a, b in zip(have[1], want[1], strict=True):
        if a != b:
            return f"VALUES {a} != {b}", result.num_rows
    return "equal", result.num_rows


def main() -> None:
    import __spark_entry__ as driver
    from lendframe.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    oracles = driver.oracle_sql()
    for name, query in driver.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            verdict, rows = compare(spark, con, sf_dir, name, query, oracles.get(name))
        except Exception as error:
            verdict, rows = f"ERROR {type(error).__name__}: {str(error)[:600]}", -1
        print(f"{name:28s} {time.time() - start:6.2f}s {rows:8d} {verdict}", flush=True)


if __name__ == "__main__":
    main()
