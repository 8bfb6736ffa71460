"""Every key against its DuckDB answer, on whole tables."""

from __future__ import annotations

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

import __spark_entry__ as driver
from starhouse import oracle, registry
from starhouse.sources import order_tables

KEYS = sorted(registry.jobs())
ANSWERS = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_key_has_an_answer():
    assert set(ANSWERS) == set(KEYS)
    assert len(KEYS) == 117
    assert set(KEYS) <= set(driver.queries()) and set(KEYS) <= set(driver.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_matches(key, spark, sf_dir, con):
    assert differences(registry.jobs()[key](spark, sf_dir), con, ANSWERS[key]) == []


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_staging_holds_every_order_line(spark, sf_dir):
    """All quantities of lineitem reach communicable staging; two priorities have one year only."""
    groups = order_tables._comm_groups(spark, sf_dir)
    total = registry.read_table(spark, sf_dir, "lineitem").agg(F.sum("l_quantity").cast("decimal(28,2)")).first()[0]
    assert groups.agg(F.sum("value").cast("decimal(28,2)")).first()[0] == total
    late = groups.filter("category IN ('4-NOT SPECIFIED', '5-LOW')")
    assert [r.yr for r in late.select("yr").distinct().collect()] == [2000]
