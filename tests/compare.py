"""Runs a registered query on Spark and its SQL on DuckDB and compares names, types and rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def differences(df, con, sql: str) -> list[str]:
    """What differs, nothing when all is equal."""
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    expected_rows = result.fetchall()
    found = []
    spark_types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    if spark_types != types:
        found.append(f"types differ: {sorted(set(spark_types.items()) ^ set(types.items()))}")
    if set(spark_types) != set(types):
        return found
    names, order = sorted(types), list(types)
    picks = [order.index(n) for n in names]
    expected = Counter(tuple(plain(row[i]) for i in picks) for row in expected_rows)
    actual = Counter(tuple(plain(row[n]) for n in names) for row in df.collect())
    if expected != actual:
        more, less = actual - expected, expected - actual
        found.append(
            f"rows differ: spark {sum(actual.values())}, sql {sum(expected.values())}, "
            f"only spark {sum(more.values())} e.g. {dict(zip(names, min(more, key=str)))if more else None}, "
            f"only sql e.g. {dict(zip(names, min(less, key=str))) if less else None}"
        )
    return found
