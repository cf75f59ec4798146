"""Compare every registered query with its SQL twin.

Usage: python tests/compare.py [folder of the tables] [query ...]
"""

from __future__ import annotations

import sys
import tempfile
import time
from pathlib import Path

import duckdb
import pyarrow as pa

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normalised(table: pa.Table) -> list[tuple]:
    """Rows as comparable text, columns by name, rows sorted."""
    names = sorted(table.column_names)

    def text(value) -> str:
        if value is None or (isinstance(value, float) and value != value):
            return "NULL"
        return repr(value + 0.0) if isinstance(value, float) else str(value)

    columns = [[text(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns))


def kinds(table: pa.Table) -> dict[str, str]:
    def kind(t: pa.DataType) -> str:
        return "timestamp" if pa.types.is_timestamp(t) else "string" if pa.types.is_large_string(t) else str(t)

    return {n: kind(table.schema.field(n).type) for n in sorted(table.column_names)}


def differences(got: pa.Table, expected: pa.Table) -> str | None:
    if sorted(got.column_names) != sorted(expected.column_names):
        return f"columns {sorted(set(got.column_names) ^ set(expected.column_names))}"
    if got.num_rows != expected.num_rows:
        return f"rows {got.num_rows} != {expected.num_rows}"
    left, right = normalised(got), normalised(expected)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    if bad:
        first = [(n, x, y) for n, x, y in zip(sorted(got.column_names), *bad[0]) if x != y]
        return f"{len(bad)} of {len(left)} rows differ, first {first[:4]}"
    if kinds(got) != kinds(expected):
        left, right = kinds(got), kinds(expected)
        return f"types differ: {[(c, left[c], right[c]) for c in left if left[c] != right[c]]}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from lavoura.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session("compare", 8, tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    con = oracle_connection(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, run in queries.items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            got = run(spark, sf_dir).toArrow()
            took = time.time() - started
            problem = differences(got, con.sql(oracle[name]).to_arrow_table()) if name in oracle else "no SQL twin"
        except Exception as error:
            took, problem = time.time() - started, f"{type(error).__name__}: {str(error)[:600]}"
            got = ()
        failed += bool(problem) and problem != "no SQL twin"
        print(f"{name:24s} {took:6.2f}s rows={len(got):6d} {problem or 'ok'}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
