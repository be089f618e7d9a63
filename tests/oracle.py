"""Comparing a Spark result with DuckDB: names, types and rows as a bag."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

# How each Spark type must come out of DuckDB.
SAME_TYPE = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(root).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def mismatch(result: DataFrame, root: str, sql: str) -> str | None:
    """None when equal, otherwise what differs."""
    con = connect(root)
    found = con.execute(sql)
    types = {d[0]: str(d[1]) for d in found.description}
    spark_types = {f.name: f.dataType.simpleString() for f in result.schema}
    if set(types) != set(spark_types):
        return f"names: {sorted(spark_types)} / {sorted(types)}"
    wrong = {
        n: (t, types[n]) for n, t in spark_types.items() if SAME_TYPE.get(t) != types[n]
    }
    if wrong:
        return f"types: {wrong}"
    names = sorted(types)
    order = [list(types).index(n) for n in names]
    expected = Counter(tuple(row[i] for i in order) for row in found.fetchall())
    actual = Counter(tuple(row) for row in result.select(*names).collect())
    if not expected and not actual:
        return "both empty"
    if expected != actual:
        extra, lacking = actual - expected, expected - actual
        return (
            f"rows: {sum(actual.values())} / {sum(expected.values())}; "
            f"extra {list(extra.items())[:2]}; lacking {list(lacking.items())[:2]}"
        )
    return None
