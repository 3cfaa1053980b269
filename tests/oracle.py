"""Run a registered query and its SQL twin and compare names, types and values."""

from __future__ import annotations

import math
import os

import duckdb
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

TYPES = {
    T.IntegerType: {"INTEGER"}, T.LongType: {"BIGINT"}, T.StringType: {"VARCHAR"},
    T.DoubleType: {"DOUBLE"}, T.BooleanType: {"BOOLEAN"}, T.TimestampNTZType:
        {"TIMESTAMP", "TIMESTAMP_NS", "TIMESTAMP_MS"}, T.DateType: {"DATE"},
}


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(sf_dir, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _rows(rows, order):
    out = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(df, con, sql):
    """List of differences; empty when the two agree exactly."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    problems = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for field in df.schema:
        wanted = TYPES.get(type(field.dataType))
        if wanted is None or kinds[field.name].upper() not in wanted:
            problems.append(f"{field.name}: {field.dataType.simpleString()} != {kinds[field.name]}")
    columns = sorted(df.columns)
    actual = _rows(df.select(*columns).collect(), range(len(columns)))
    expected = _rows(expected, [names.index(c) for c in columns])
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows != {len(expected)}")
    wrong = [(a, e) for a, e in zip(actual, expected) if a != e]
    if wrong:
        problems.append(f"{len(wrong)} of {len(actual)} rows differ, first: {str(wrong[0])[:600]}")
    return problems
