"""Compare a Spark result with the DuckDB result of the same query."""

from __future__ import annotations

from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, Decimal)):
        return Decimal(value).normalize() + 0
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(frame: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both results are the same bag of rows under the same column names."""
    done = con.execute(sql)
    names = [d[0] for d in done.description]
    want = _rows(names, done.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(names)}"
    have = _rows(frame.columns, frame.collect())
    if have == want:
        return None
    return (f"{have.total()} against {want.total()} rows; only Spark {list((have - want).items())[:3]}; "
            f"only SQL {list((want - have).items())[:3]}")
