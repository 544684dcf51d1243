"""Compare a query with its SQL: names, types, row count and every value."""

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_value(row[i]) for i in order) for row in rows)


def compare(df, con, sql):
    """Null when equal, else a short description of the first difference."""
    relation = con.execute(sql)
    names = [d[0] for d in relation.description]
    kinds = {d[0]: str(d[1]) for d in relation.description}
    expected = normalised(names, relation.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    spark_kinds = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for name, kind in df.dtypes:
        if spark_kinds[kind] != kinds[name]:
            return f"type of {name}: {kind} != {kinds[name]}"
    actual = normalised(df.columns, [tuple(r) for r in df.collect()])
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None
