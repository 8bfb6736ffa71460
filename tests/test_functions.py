from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starhouse.functions import (
    ci_width,
    clean_text,
    is_number,
    is_year,
    percent,
    quotient,
    register_sql_functions,
    safe_pct,
)
from starhouse.functions.text import to_number


def evaluate(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(expression(F.col("x"))).collect()]


def test_clean_text(spark):
    raw = ["Africa\r", "Africa \r", " \tAf\x00rica\x7f ", "Türkiye", "", None, "a b"]
    want = ["Africa", "Africa", "Africa", "Türkiye", "", "", "a b"]
    assert evaluate(spark, raw, clean_text) == want


@pytest.mark.parametrize(
    ("text", "ok"),
    [("2021", True), ("21", False), ("19x5", False), ("", False), ("20211", False), ("2021\n", False)],
)
def test_is_year(spark, text, ok):
    assert evaluate(spark, [text], is_year) == [ok]


def test_is_number(spark):
    good = ["1", "-5.0", "0012.340"]
    bad = ["", "None", "1e5", "+3", ".5", "5.", "1.2.3", "1\n"]
    assert evaluate(spark, good + bad, is_number) == [True] * 3 + [False] * 8


def test_to_number_rounds_and_rejects_overflow(spark):
    got = evaluate(spark, ["10.005", "9" * 30, "x"], lambda c: to_number(c, "decimal(18,2)"))
    assert got == [Decimal("10.01"), None, None]


PCT = [(25, 200, "12.50"), (100, 0, None), (None, 100, None), (1, None, None), (-1, 3, "-33.33")]
WIDTH = [("70.5", "72.3", "1.80"), (None, "72.3", None), ("1", None, None), ("3", "1", "-2.00")]


def _dec(value):
    return None if value is None else Decimal(value)


def test_safe_pct_both_ways(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([(_dec(n), _dec(d)) for n, d, _ in PCT], "n decimal(18,6), d decimal(18,6)")
    rows = df.select(safe_pct(F.col("n"), F.col("d")), F.expr("fn_safe_pct(n, d)")).collect()
    assert [r[0] for r in rows] == [r[1] for r in rows] == [_dec(w) for *_, w in PCT]


def test_ci_width_both_ways(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([(_dec(a), _dec(b)) for a, b, _ in WIDTH], "a decimal(18,6), b decimal(18,6)")
    rows = df.select(ci_width(F.col("a"), F.col("b")), F.expr("fn_ci_width(a, b)")).collect()
    assert [r[0] for r in rows] == [r[1] for r in rows] == [_dec(w) for *_, w in WIDTH]


def test_sql_function_literals(spark):
    register_sql_functions(spark)
    row = spark.sql(
        "SELECT fn_safe_pct(25, 200), fn_safe_pct(100, 0), fn_safe_pct(NULL, 100),"
        " fn_ci_width(70.5, 72.3), fn_ci_width(NULL, 72.3)"
    ).first()
    assert list(row) == [Decimal("12.50"), None, None, Decimal("1.80"), None]


def test_sql_functions_are_inlined(spark):
    register_sql_functions(spark)
    plan = spark.range(3).selectExpr("fn_safe_pct(id, 3)")._jdf.queryExecution().optimizedPlan().toString()
    assert "fn_safe_pct" not in plan.split("AS")[0]


def test_percent_and_quotient(spark):
    df = spark.sql("SELECT CAST(1 AS DECIMAL(28,2)) n, CAST(8 AS DECIMAL(28,2)) d, CAST(0 AS DECIMAL(28,2)) z")
    row = df.select(
        percent(F.col("n"), F.col("d"), 1),
        quotient(F.col("n"), F.col("d"), 2),
        percent(F.col("n"), F.col("z"), 1),
    ).first()
    assert list(row) == [Decimal("12.5"), Decimal("0.13"), None]
