"""Row-by-row comparison of a job with its DuckDB answer."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _kind(name: str) -> str:
    name = name.upper()
    for wide, short in (("BIGINT", "BIGINT"), ("INT", "INTEGER"), ("STRING", "VARCHAR")):
        if name == wide:
            return short
    return name


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when columns, types and the multiset of rows agree."""
    relation = con.sql(sql)
    want_types = dict(zip(relation.columns, [str(t) for t in relation.types]))
    have_types = {f.name: _kind(f.dataType.simpleString()) for f in spark_df.schema.fields}
    if want_types != have_types:
        return [f"types: have {have_types}, want {want_types}"]
    columns = sorted(have_types)
    have = sorted(repr([row[c] for c in columns]) for row in spark_df.collect())
    index = [relation.columns.index(c) for c in columns]
    want = sorted(repr([row[i] for i in index]) for row in relation.fetchall())
    if have == want:
        return []
    extra = [r for r in have if r not in set(want)][:3]
    missing = [r for r in want if r not in set(have)][:3]
    return [f"{len(have)} rows, want {len(want)}; extra {extra}; missing {missing}"]
