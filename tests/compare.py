"""Order-free comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, datetime) and value.time() == datetime.min.time():
        return value.date()
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


# Spark type -> the DuckDB types that hold the same values
SAME = {
    "string": {"VARCHAR"}, "int": {"INTEGER"}, "bigint": {"BIGINT"}, "double": {"DOUBLE"}, "float": {"FLOAT"},
    "boolean": {"BOOLEAN"}, "date": {"DATE"}, "timestamp": {"TIMESTAMP"}, "timestamp_ntz": {"TIMESTAMP"},
}


def differences(df, con, sql: str) -> list[str]:
    """What differs, empty when the results agree in names, types and values."""
    result = con.sql(sql)
    spark_types, duck_types = dict(df.dtypes), dict(zip(result.columns, map(str, result.types)))
    names, left = rows_of(df.columns, [tuple(r) for r in df.collect()])
    other, right = rows_of(result.columns, result.fetchall())
    if names != other:
        return [f"columns {names} != {other}"]
    out = [f"type of {c}: {t} != {duck_types[c]}" for c, t in spark_types.items()
           if duck_types[c] not in SAME.get(t, {t.upper()})]
    if left != right:
        out.append(f"rows {sum(left.values())} and {sum(right.values())}; only Spark {list((left - right))[:3]}; "
                   f"only SQL {list((right - left))[:3]}")
    return out
