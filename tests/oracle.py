"""Compares a query's rows with its SQL run by DuckDB over the same files."""

import glob
import os
from collections import Counter
from decimal import Decimal

import duckdb

from __spark_entry__ import oracle_sql, queries


def connection(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return f"{value:.6f}"
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def kind(name):
    """Engine-neutral type names."""
    name = str(name).lower().replace(" ", "")
    return {"varchar": "string", "integer": "int", "timestamp_ntz": "timestamp"}.get(name, name)


def differences(spark, con, name, sf_dir):
    df = queries()[name](spark, sf_dir)
    result = con.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    found = []
    if sorted(df.columns) != sorted(columns):
        return [f"columns {sorted(df.columns)} vs {sorted(columns)}"]
    types = {d[0]: kind(d[1]) for d in result.description}
    for field in df.schema.fields:
        if kind(field.dataType.simpleString()) != types[field.name]:
            found.append(f"type {field.name}: {field.dataType.simpleString()} vs {types[field.name]}")
    ours, theirs = rows_of(df.columns, df.collect()), rows_of(columns, expected)
    if ours != theirs:
        found.append(f"{sum(ours.values())} vs {sum(theirs.values())} rows; only ours "
                     f"{list((ours - theirs).items())[:3]}; only theirs {list((theirs - ours).items())[:3]}")
    return found
