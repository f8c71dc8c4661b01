"""Compare registered queries with their SQL, value by value and type by type.

Run as a script: ``python tests/oracle_check.py [sf_dir] [query ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v) for v in row)


def compare(spark_df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    expected = result.fetchall()
    columns = sorted(names)
    if columns != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {columns}"
    types = dict(spark_df.dtypes)
    bad = {c: (types[c], kinds[c]) for c in columns if KINDS.get(kinds[c]) != types[c]}
    if bad:
        return f"types {bad}"
    place = [names.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in place) for r in expected), key=_key)
    got = sorted((tuple(r) for r in spark_df.select(*[f"`{c}`" for c in columns]).collect()), key=_key)
    if len(want) != len(got):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        same = all(a == b or (isinstance(a, float) and isinstance(b, float) and math.isclose(a, b, abs_tol=1e-9)) for a, b in zip(g, w))
        if not same:
            return f"row {dict(zip(columns, g))} != {dict(zip(columns, w))}"
    return None


def main() -> int:
    import __spark_entry__ as entry
    from citeloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con = local_session(8), connect(sf_dir)
    statements, failed = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = compare(run(spark, sf_dir), con, statements[name]) if name in statements else "no SQL"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
