"""Parameterised data-quality checks. Each takes a DataFrame and returns a small report.

Counts come from single-pass aggregates with map-side combine; reference checks
are anti joins; listings are bounded by a limit, which Spark turns into a top-k.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def null_counts(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row: for each column, how many rows lack it. ``columns`` maps column -> result name."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(name) for c, name in columns.items()])


def orphans(df: DataFrame, dim: DataFrame, key: str, name: str, small_dim: bool = False) -> DataFrame:
    """Rows whose key is absent from the dimension (a null key counts as absent)."""
    keys = dim.select(key)
    missing = df.join(F.broadcast(keys) if small_dim else keys, key, "left_anti")
    return missing.agg(F.count("*").alias(name))


def duplicates(df: DataFrame, key: list[str], limit: int) -> DataFrame:
    """The most repeated keys."""
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("n_dups"))
        .filter(F.col("n_dups") > 1)
        .orderBy(F.desc("n_dups"), *key)
        .limit(limit)
    )


def value_range(df: DataFrame, column: str, low: str, high: str, distinct: str | None = None) -> DataFrame:
    parts = [F.min(column).alias(low), F.max(column).alias(high)]
    if distinct:
        parts.append(F.count_distinct(column).alias(distinct))
    return df.agg(*parts)


def count_where(df: DataFrame, condition: Column, name: str) -> DataFrame:
    return df.filter(condition).agg(F.count("*").alias(name))


def inverted() -> Column:
    """Both bounds present, in the wrong order."""
    return F.coalesce(F.col("low_ci") > F.col("high_ci"), F.lit(False))


def coverage(df: DataFrame, group: str) -> DataFrame:
    both = F.col("low_ci").isNotNull() & F.col("high_ci").isNotNull()
    return df.groupBy(group).agg(
        F.count("*").alias("total_rows"),
        F.count_if(both).alias("with_ci"),
        F.count_if(~both).alias("without_ci"),
    )


def repair_inverted(df: DataFrame) -> DataFrame:
    """Swap the bounds of inverted rows; every other row is left as it is.

    ``least``/``greatest`` keep both original values, and a row with a missing
    bound is not touched (they would otherwise skip the null and copy the other).
    """
    both = F.col("low_ci").isNotNull() & F.col("high_ci").isNotNull()
    low, high = F.col("low_ci"), F.col("high_ci")
    return df.withColumns(
        {
            "low_ci": F.when(both, F.least(low, high)).otherwise(low),
            "high_ci": F.when(both, F.greatest(low, high)).otherwise(high),
        }
    )
