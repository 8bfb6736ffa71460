"""Whole tables in which one supplier, one part and one order hold a third of all lines."""

from __future__ import annotations

import duckdb
import pytest
from compare import TABLES, connect, differences

import __spark_entry__ as driver

BASE = "/root/testdata/sf0.001"
KEYS = [
    "etl_fct_health",
    "etl_fct_ncd",
    "etl_fct_comm",
    "etl_reconcile",
    "etl_surrogate_key",
    "vw_region_yearly_kpi",
    "q08_concentration",
    "q09_dense_rank",
    "q16_latest_top5",
    "q19_total_burden",
    "rp09_region_box",
    "dq_dups_health",
    "fn_safe_pct",
    "src_json_pages",
]


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for table in TABLES:
        source = f"SELECT * FROM read_parquet('{BASE}/{table}.parquet')"
        if table == "lineitem":
            hot = "(l_orderkey * 7 + l_linenumber + l_partkey) % 3 = 0"
            source = f"""
                SELECT * REPLACE (
                    CASE WHEN {hot} THEN 1 ELSE l_orderkey END AS l_orderkey,
                    CASE WHEN {hot} THEN 1 ELSE l_partkey END AS l_partkey,
                    CASE WHEN {hot} THEN 1 ELSE l_suppkey END AS l_suppkey)
                FROM ({source})"""
        con.execute(f"COPY ({source}) TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.fixture(scope="module")
def shuffled(spark):
    """No broadcasts by size, so joins take the paths of large tables."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("key", KEYS)
def test_matches_under_skew(key, shuffled, skewed):
    result = driver.queries()[key](shuffled, skewed)
    assert differences(result, connect(skewed), driver.oracle_sql()[key]) == []
