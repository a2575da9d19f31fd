"""Compare a query with its SQL: same columns, same types, same rows in any order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TYPE_NAMES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
              "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"create view {path.stem} as select * from read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def difference(df, con, sql: str) -> str | None:
    """What differs, or None."""
    names = sorted(df.columns)
    got_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    result = con.execute(sql)
    wanted_types = {d[0]: str(d[1]) for d in result.description}
    if names != sorted(wanted_types):
        return f"columns: {names} != {sorted(wanted_types)}"
    for name in names:
        got = got_types[name]
        expected = TYPE_NAMES.get(got, got.upper())
        if expected != wanted_types[name]:
            return f"type of {name}: {got} != {wanted_types[name]}"
    order = list(wanted_types)
    want = Counter(tuple(_plain(row[order.index(n)]) for n in names) for row in result.fetchall())
    have = Counter(tuple(_plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())
    if want != have:
        extra, missing = list((have - want).items())[:2], list((want - have).items())[:2]
        return f"{sum(have.values())} rows, SQL {sum(want.values())}; only here {extra}; only SQL {missing}"
    return None
