"""Compare a query's rows with the rows its SQL gives in DuckDB."""

from __future__ import annotations

import math
import os
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    if hasattr(value, "as_tuple"):
        return round(float(value), 6)
    if hasattr(value, "isoformat"):
        return value.isoformat(" ")
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda c: columns[c])
    return Counter(tuple(_plain(row[c]) for c in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None when both give the same columns and the same bag of rows."""
    relation = con.execute(sql)
    sql_columns = [d[0] for d in relation.description]
    if sorted(df.columns) != sorted(sql_columns):
        return f"columns {sorted(df.columns)} != {sorted(sql_columns)}"
    expected = rows_of(sql_columns, relation.fetchall())
    actual = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if actual == expected:
        return None
    missing, extra = expected - actual, actual - expected
    return (
        f"rows spark={sum(actual.values())} sql={sum(expected.values())} "
        f"only-sql={sum(missing.values())} {[str(x)[:300] for x in list(missing)[:2]]} "
        f"only-spark={sum(extra.values())} {[str(x)[:300] for x in list(extra)[:2]]}"
    )
