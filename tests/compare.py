"""Order-insensitive comparison of a Spark frame with a SQL result."""

from __future__ import annotations

SPARK_TO_SQL = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def sort_key(row):
    return tuple((value is not None, str(value)) for value in row)


def spark_rows(df):
    names = sorted(df.columns)
    return sorted((tuple(row) for row in df.select(*names).collect()), key=sort_key)


def sql_rows(connection, sql):
    relation = connection.sql(sql)
    names = sorted(relation.columns)
    picked = ", ".join(f'"{name}"' for name in names)
    return sorted(connection.sql(f"SELECT {picked} FROM ({sql}) q").fetchall(), key=sort_key)


def assert_same(df, connection, sql):
    relation = connection.sql(sql)
    types = {name: SPARK_TO_SQL.get(kind, kind) for name, kind in df.dtypes}
    assert types == {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    assert spark_rows(df) == sql_rows(connection, sql)
