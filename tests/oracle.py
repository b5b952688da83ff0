"""Compare a query with its SQL in DuckDB: rows, columns, types, values."""

from __future__ import annotations

import duckdb
from pyspark.sql import types as T

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SIMPLE = {
    T.StringType: "VARCHAR",
    T.LongType: "BIGINT",
    T.IntegerType: "INTEGER",
    T.DoubleType: "DOUBLE",
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.TimestampNTZType: "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def type_name(dtype: T.DataType) -> str:
    if isinstance(dtype, T.DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    return SIMPLE[type(dtype)]


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda row: tuple((value is None, str(value)) for value in row),
    )


def differences(df, con, sql: str) -> list[str]:
    """What differs; empty if the query and the SQL agree."""
    rows = [tuple(row) for row in df.collect()]
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    types = {column[0]: str(column[1]) for column in result.description}
    expected = result.fetchall()
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    for field in df.schema.fields:
        if type_name(field.dataType) != types[field.name]:
            found.append(f"{field.name}: {type_name(field.dataType)} against {types[field.name]}")
    if len(rows) != len(expected):
        found.append(f"{len(rows)} rows against {len(expected)}")
    ours, theirs = normal(rows, df.columns), normal(expected, names)
    for a, b in zip(ours, theirs):
        if a != b:
            found.append(f"first difference {a} against {b}")
            break
    return found
