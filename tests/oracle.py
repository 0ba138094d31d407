"""Compare a registered query with its SQL, the way the gate does: columns by name, rows as a bag."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


_KINDS = {
    "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER",
    "date": "DATE",
}


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Rows of the Spark result, and a list of differences (empty when equal)."""
    names = sorted(df.columns)
    relation = con.sql(sql)
    columns, kinds = list(relation.columns), dict(zip(relation.columns, map(str, relation.types)))
    if sorted(columns) != names:
        return -1, [f"columns {names} against {sorted(columns)}"]
    types = dict(df.dtypes)
    problems = [f"{n}: {types[n]} against {kinds[n]}" for n in names if _KINDS.get(types[n]) != kinds[n]]
    place = [columns.index(n) for n in names]
    expected = sorted((tuple(r[i] for i in place) for r in relation.fetchall()), key=repr)
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
    if got != expected:
        ours, theirs = set(got), set(expected)
        extra = [r for r in got if r not in theirs][:3]
        lacking = [r for r in expected if r not in ours][:3]
        problems.append(f"{len(got)} rows against {len(expected)}; only here {extra}; only there {lacking}")
    return len(got), problems
