"""Copies of the test tables in which single keys hold a third of all rows."""

from __future__ import annotations

import os
import sys

import duckdb

# In a third of the rows the column takes one value; which rows is decided by a digest.
HOT = {
    "lineitem": {"l_orderkey": "1", "l_suppkey": "2", "l_partkey": "4"},
    "orders": {"o_custkey": "7", "o_orderpriority": "'1-URGENT'", "o_totalprice": "50000.0"},
    "events": {"user_id": "5", "event_type": "'click'"},
    "documents": {"text": "'the same text'"},
    "customer": {"c_nationkey": "3"},
}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def skewed_tables(source: str, target: str) -> str:
    os.makedirs(target, exist_ok=True)
    con = duckdb.connect()
    for table in TABLES:
        parts = []
        for n, (column, value) in enumerate(HOT.get(table, {}).items()):
            kind = con.execute(f"SELECT typeof({column}) FROM '{source}/{table}.parquet' LIMIT 1").fetchall()[0][0]
            parts.append(f"CASE WHEN hash(_row * 10 + {n}) % 3 = 0 THEN CAST({value} AS {kind}) ELSE {column} END AS {column}")
        replaced = f"REPLACE ({', '.join(parts)})" if parts else ""
        con.execute(
            f"COPY (SELECT * EXCLUDE (_row) {replaced} FROM (SELECT *, row_number() OVER () AS _row FROM '{source}/{table}.parquet'))"
            f" TO '{target}/{table}.parquet' (FORMAT parquet)"
        )
    return target


if __name__ == "__main__":
    print(skewed_tables(sys.argv[1], sys.argv[2]))
