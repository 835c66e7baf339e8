"""Compare a registered query with its SQL, run by DuckDB on the same files."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

FAMILY = {
    "bigint": "bigint",
    "int": "int",
    "integer": "int",
    "double": "double",
    "string": "string",
    "varchar": "string",
    "boolean": "boolean",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def compare(df, sql: str, con) -> list[str]:
    """Differences; an empty list means the same schema, row count and values."""
    rel = con.sql(sql)
    want = {c: FAMILY.get(str(t).lower(), str(t).lower()) for c, t in zip(rel.columns, rel.types)}
    have = {c: FAMILY.get(t, t) for c, t in df.dtypes}
    if want != have:
        return [f"schema: spark {have} sql {want}"]
    names = sorted(have)
    mine = sorted(tuple(_plain(r[c]) for c in names) for r in df.select(*names).collect())
    place = [rel.columns.index(c) for c in names]
    theirs = sorted(tuple(_plain(r[i]) for i in place) for r in rel.fetchall())
    if len(mine) != len(theirs):
        return [f"rows: spark {len(mine)} sql {len(theirs)}"]
    bad = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return [f"{len(bad)} of {len(mine)} rows differ, {names}: {bad[:2]}"] if bad else []
