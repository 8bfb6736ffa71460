"""Counts of constraint violations: required columns and unique keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.parallel import dealt


def violations(
    df: DataFrame,
    table: str,
    required: list[str],
    key: list[str],
    rules: dict[str, Column] | None = None,
) -> DataFrame:
    """Rows (table_name, constraint_name, n_violations); zero where the constraint holds.

    One pass: rows and broken tests are counted per key, and the counts summed up. Repeated
    keys count as surplus rows. Of a large table keys are hardly ever equal within a task, so its
    rows are dealt by key first, over tasks by their number.
    """
    broken = {f"not_null:{c}": F.col(c).isNull() for c in required} | (rules or {})
    unique = f"unique:{','.join(key)}"
    per_key = dealt(df, df.count(), *key).groupBy(*key).agg(
        (F.count("*") - 1).alias(unique), *[F.count_if(test).alias(name) for name, test in broken.items()]
    )
    names = [*broken, unique]
    return (
        per_key.agg(*[F.coalesce(F.sum(f"`{name}`"), F.lit(0)).alias(name) for name in names])
        .unpivot([], [F.col(f"`{name}`") for name in names], "constraint_name", "n_violations")
        .select(F.lit(table).alias("table_name"), "constraint_name", "n_violations")
    )


def stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
