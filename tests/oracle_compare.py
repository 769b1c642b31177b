"""Compare a query with its SQL text on the same tables, by columns, types and rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb

DUCK_TYPES = {
    "BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz", "INTEGER": "int",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and (math.isnan(value) or value == 0):
        return "nan" if math.isnan(value) else 0.0
    return value


def _rows(rows, order):
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, con, sql: str) -> list[str]:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    types = [str(c[1]) for c in result.description]
    theirs = result.fetchall()
    ours = [tuple(r) for r in df.collect()]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} against {sorted(names)}"]
    problems = []
    spark_types = dict(df.dtypes)
    for name, duck in zip(names, types):
        if DUCK_TYPES.get(duck, duck) != spark_types[name]:
            problems.append(f"type of {name}: {spark_types[name]} against {duck}")
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows against {len(theirs)}")
    wanted = sorted(names)
    a = _rows(ours, [df.columns.index(n) for n in wanted])
    b = _rows(theirs, [names.index(n) for n in wanted])
    if a != b:
        pairs = [(x, y) for x, y in zip(a, b) if x != y]
        problems.append(f"{len(pairs)} rows differ, first {wanted}: {pairs[:1]}")
    return problems
