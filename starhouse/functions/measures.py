"""Ratio and interval functions, as Column expressions and as SQL functions.

The SQL functions are expression bodies that Catalyst inlines, so calling them
costs the same as writing the arithmetic out.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_ARGUMENT = "decimal(18,6)"
_RESULT = "decimal(10,2)"
# 16 integer digits; leaves 12 fractional digits in the quotient of two of them.
_OPERAND = "decimal(22,6)"


def safe_pct(num: Column, den: Column) -> Column:
    """100 * num / den at two places; null when either side is null or den is 0."""
    n, d = num.cast(_ARGUMENT), den.cast(_ARGUMENT)
    return F.round(F.lit(100) * n / F.nullif(d, F.lit(0).cast(_ARGUMENT)), 2).cast(_RESULT)


def ci_width(low: Column, high: Column) -> Column:
    """high - low at two places; null when either bound is null."""
    return F.round(high.cast(_ARGUMENT) - low.cast(_ARGUMENT), 2).cast(_RESULT)


def quotient(num: Column, den: Column, digits: int) -> Column:
    """num / den in exact decimals, rounded once; null when den is 0."""
    n, d = num.cast(_OPERAND), den.cast(_OPERAND)
    return F.round(n / F.nullif(d, F.lit(0).cast(_OPERAND)), digits)


def percent(num: Column, den: Column, digits: int) -> Column:
    """num as a percentage of den in exact decimals, rounded once."""
    n, d = num.cast(_OPERAND), den.cast(_OPERAND)
    return F.round(F.lit(100) * n / F.nullif(d, F.lit(0).cast(_OPERAND)), digits)


SQL_FUNCTIONS = {
    "fn_safe_pct": """
        CREATE OR REPLACE TEMPORARY FUNCTION fn_safe_pct(num DECIMAL(18,6), den DECIMAL(18,6))
        RETURNS DECIMAL(10,2)
        RETURN CAST(ROUND(100 * num / NULLIF(den, CAST(0 AS DECIMAL(18,6))), 2) AS DECIMAL(10,2))
    """,
    "fn_ci_width": """
        CREATE OR REPLACE TEMPORARY FUNCTION fn_ci_width(low DECIMAL(18,6), high DECIMAL(18,6))
        RETURNS DECIMAL(10,2)
        RETURN CAST(ROUND(high - low, 2) AS DECIMAL(10,2))
    """,
}


def register_sql_functions(spark: SparkSession) -> None:
    for statement in SQL_FUNCTIONS.values():
        spark.sql(statement)
