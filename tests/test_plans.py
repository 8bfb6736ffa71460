"""What the plans must look like to hold at scale."""

from __future__ import annotations

import re

import pytest

from starhouse import parallel, registry
from starhouse.operators.constraints import violations
from starhouse.plans.catalog import PLANS, QUESTIONS
from starhouse.schemas import STG_COMM, STG_HEALTH, STG_NCD
from starhouse.sources.order_tables import stage


def formatted(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final(df) -> str:
    """The executed plan of a finished query, without the initial one."""
    df.collect()
    return physical(df).split("Initial Plan")[0]


@pytest.fixture(scope="module")
def retail(spark, sf_dir):
    return registry.warehouse(spark, sf_dir)


def test_year_prunes_folders_and_codes_reach_the_scan(retail):
    text = formatted(QUESTIONS["q03_top10"](retail))
    scan = next(part for part in text.split("\n\n") if "Scan parquet" in part and "metric_value" in part)
    assert re.search(r"PartitionFilters: \[.*year_val.* (=|IN) ", scan)
    assert "EqualTo(indicator_code,ECONOMY)" in scan and "EqualTo(sex_code,N)" in scan
    columns = re.search(r"ReadSchema: struct<(.*)>", scan).group(1)
    assert "low_ci" not in columns and "fact_id" not in columns and "created_at" not in columns


def test_top_n_filters_before_the_shuffle(retail):
    for name in ("q04_top3_per_region", "q12_top_cause", "q16_latest_top5"):
        assert "WindowGroupLimit" in physical(QUESTIONS[name](retail)), name
    for name in ("q03_top10", "q06_indicator_pair", "q14_cross_fact", "q19_total_burden", "q20_double_burden", "rp20_double15"):
        assert "TakeOrderedAndProject" in physical(PLANS[name](retail)), name


def test_violations_scan_a_table_once(retail):
    text = physical(violations(retail.health, "t", ["country_code", "metric_value"], ["country_code", "year_val"]))
    assert text.count("FileScan") == 1


def test_the_double_burden_reduces_facts_before_it_aggregates(retail):
    text = retail.spark._jvm.PythonSQLUtils.explainString(PLANS["q20_double_burden"](retail)._jdf.queryExecution(), "simple")
    assert text.count("LeftSemi") >= 2


def test_two_years_or_indicators_cost_one_scan_of_the_fact(retail):
    for name in ("q06_indicator_pair", "q07_region_improvement", "q10_decliners"):
        assert len(re.findall(r"FileScan parquet \[[^]]*metric_value", physical(QUESTIONS[name](retail)))) == 1, name


@pytest.mark.parametrize("table", [STG_HEALTH, STG_NCD, STG_COMM])
def test_staging_passes_over_lineitem_once(spark, sf_dir, table):
    plan = final(stage(spark, sf_dir, table))
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 1
    assert "Reused" in plan


def test_the_left_join_of_the_double_burden_becomes_inner(retail):
    plan = QUESTIONS["q20_double_burden"](retail)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan


def test_no_python_and_no_cross_product_of_tables(retail):
    for name, plan in PLANS.items():
        text = physical(plan(retail))
        assert "Python" not in text and "Pandas" not in text, name
        assert "CartesianProduct" not in text, name


def test_without_broadcast_the_country_join_shuffles(spark, retail):
    """Beyond the broadcast threshold the country dimension joins by key, on both sides."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = physical(PLANS["vw_health_enriched"](retail))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin [country_code" in text
    assert text.count("BroadcastHashJoin") == 2  # the literal dimensions


def test_top_rows_go_to_the_country_dimension(spark, retail):
    """Few rows are broadcast to the dimension; the dimension itself is not shuffled."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("q03_top10", "q06_indicator_pair", "q14_cross_fact", "q16_latest_top5", "q19_total_burden"):
            text = physical(QUESTIONS[name](retail))
            assert re.search(r"BroadcastHashJoin \[country_code[^]]*\], \[country_code[^]]*\], Inner, BuildLeft", text), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_loading_code_stays_small_enough_to_compile(spark, retail):
    """The JVM does not compile methods above 8,000 bytes of bytecode."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = PLANS["etl_fct_health"](retail)
        text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


@pytest.mark.parametrize("table", [STG_NCD, STG_COMM])
def test_lines_and_orders_are_dealt_by_their_number(spark, sf_dir, table, monkeypatch):
    """A task's share of the join does not grow with the tables, and the rows stay the same."""
    plain = stage(spark, sf_dir, table)
    n = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    monkeypatch.setattr(parallel, "ROWS_A_TASK", -(-n // 50))
    many = stage(spark, sf_dir, table)
    text = physical(many)
    assert re.search(r"hashpartitioning\(l_orderkey#\d+L, 50\)", text)
    assert many.exceptAll(plain).count() == 0 == plain.exceptAll(many).count()


def test_rows_are_dealt_by_key_before_violations_are_counted(spark, monkeypatch):
    rows = [(i % 40 if i % 9 else None, i % 2, None if i % 7 else 1) for i in range(90)]
    df = spark.createDataFrame(rows, "a int, b int, v int")
    plain = violations(df, "t", ["a", "v"], ["a", "b"]).collect()
    monkeypatch.setattr(parallel, "ROWS_A_TASK", 3)
    many = violations(df, "t", ["a", "v"], ["a", "b"])
    before, after = physical(many).rsplit("hashpartitioning(a#", 1)
    assert re.match(r"\d+, b#\d+, 30\)", after) and "HashAggregate" not in after
    assert sorted(many.collect()) == sorted(plain)
