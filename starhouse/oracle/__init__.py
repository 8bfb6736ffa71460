"""Reference answers: one DuckDB query per key, written independently of the plans."""

from starhouse.oracle.answers import oracle_sql

__all__ = ["oracle_sql"]
