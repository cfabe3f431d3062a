"""Run registered queries next to their SQL and compare: python tests/check.py [sf] [name ...]"""

from __future__ import annotations

import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def compare(df, relation) -> str | None:
    """None if columns, types and rows agree, else what differs."""
    names = sorted(df.columns)
    if names != sorted(relation.columns):
        return f"columns {names} vs {sorted(relation.columns)}"
    mine = Counter(tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect())
    other = Counter(relation.project(", ".join(f'"{n}"' for n in names)).fetchall())
    types = {n: t for n, t in df.dtypes}, dict(zip(relation.columns, map(str, relation.types), strict=True))
    if any(TYPES.get(types[0][n], types[0][n]) != types[1][n] for n in names):
        return f"types {types}"
    if mine == other:
        return None
    extra, lacking = list((mine - other).items()), list((other - mine).items())
    return f"{sum(mine.values())} vs {sum(other.values())} rows; extra {extra[:2]}; lacking {lacking[:2]}"


if __name__ == "__main__":
    import __spark_entry__ as e
    from tests.conftest import make_session

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    spark, con = make_session(), connect(folder)
    queries, sql = e.queries(), e.oracle_sql()
    print(len(queries), "queries;", "without SQL:", sorted(set(queries) - set(sql)), "SQL only:", sorted(set(sql) - set(queries)))
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            relation = con.sql(sql[name])
            problem = compare(df, relation)
        except Exception as x:  # noqa: BLE001
            problem = f"{type(x).__name__}: {str(x)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("bad:", bad)
