"""Run a registered query and its SQL counterpart on the same tables and compare them."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    """What differs between the two results; empty when they agree."""
    cursor = con.execute(sql)
    sql_types = {d[0]: str(d[1]) for d in cursor.description}
    sql_rows = cursor.fetchall()
    rows = df.collect()
    found = []
    for field in df.schema.fields:
        expected = SAME_TYPE[field.dataType.simpleString()]
        if sql_types.get(field.name) != expected:
            found.append(f"column {field.name}: {expected} against {sql_types.get(field.name)}")
    if set(sql_types) != set(df.columns):
        found.append(f"columns {sorted(df.columns)} against {sorted(sql_types)}")
        return found
    if len(rows) != len(sql_rows):
        found.append(f"{len(rows)} rows against {len(sql_rows)}")
    ours, theirs = _sorted_rows(df.columns, rows), _sorted_rows(list(sql_types), sql_rows)
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if unequal:
        found.append(f"{len(unequal)} rows differ, first: {str(unequal[0])[:600]}")
    return found
