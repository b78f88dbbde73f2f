"""Order-independent comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _bag(rows, names) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both results have the same columns and the same bag of rows."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    ours = _bag(df.collect(), df.columns)
    theirs = _bag(cursor.fetchall(), names)
    if not theirs:
        return ["no rows to compare"]
    missing, extra = theirs - ours, ours - theirs
    return [f"missing {r}" for r in list(missing)[:3]] + [f"extra {r}" for r in list(extra)[:3]]
