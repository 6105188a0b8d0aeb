"""Run a registered query and its SQL side by side, as the driver does."""

import duckdb

from stellate.queries.inputs import BASE_TABLES

SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    connection = duckdb.connect()
    for table in BASE_TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def differences(df, connection, sql):
    """An empty list when column names, types and rows agree."""
    relation = connection.sql(sql)
    expected_types = {c: str(t) for c, t in zip(relation.columns, relation.types)}
    actual_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
    found = []
    if actual_types != expected_types:
        found.append(
            {
                c: (actual_types.get(c), expected_types.get(c))
                for c in actual_types | expected_types
                if actual_types.get(c) != expected_types.get(c)
            }
        )
    columns = sorted(expected_types)
    if sorted(actual_types) != columns:
        return found
    actual = sorted(repr(tuple(r)) for r in df.select(*(f"`{c}`" for c in columns)).collect())
    names = ", ".join(f'"{c}"' for c in columns)
    expected = sorted(repr(r) for r in connection.sql(f"SELECT {names} FROM ({sql})").fetchall())
    if actual != expected:
        extra = [r for r in actual if r not in set(expected)][:3]
        missing = [r for r in expected if r not in set(actual)][:3]
        found.append((len(actual), len(expected), extra, missing))
    return found
