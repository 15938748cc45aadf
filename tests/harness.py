"""Runs a check query in Spark and its SQL in DuckDB and reports every difference."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        return (2, "nan" if math.isnan(value) else repr(value + 0.0 if value else 0.0))
    if isinstance(value, int):
        return (2, repr(float(value)))
    return (3, str(value))


KINDS = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "long", "double": "double", "string": "str", "boolean": "bool",
         "TINYINT": "int", "SMALLINT": "int", "INTEGER": "int", "BIGINT": "long", "DOUBLE": "double", "VARCHAR": "str", "BOOLEAN": "bool"}


def compare(df, con, sql: str) -> list[str]:
    names = sorted(df.columns)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = df.select(*names).collect()
    want = con.execute(sql)
    have = [d[0] for d in want.description]
    problems = []
    if sorted(have) != names:
        return [f"columns {names} != {sorted(have)}"]
    types = {d[0]: str(d[1]) for d in want.description}
    for n in names:
        if KINDS.get(kinds[n], kinds[n]) != KINDS.get(types[n], types[n]):
            problems.append(f"type of {n}: {kinds[n]} vs {types[n]}")
    order = [have.index(n) for n in names]
    theirs = sorted(tuple(_cell(r[i]) for i in order) for r in want.fetchall())
    ours = sorted(tuple(_cell(v) for v in r) for r in rows)
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    if not ours:
        problems.append("no rows")
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} of {len(ours)} rows differ, first: {wrong[0]}")
    return problems
