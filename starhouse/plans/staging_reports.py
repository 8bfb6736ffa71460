"""Profiles and parse checks of raw staging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.functions.text import clean_text, has_control_chars, is_blank, is_number, is_year
from starhouse.operators.constraints import stacked
from starhouse.plans.warehouse import Warehouse
from starhouse.schemas import (
    STG_COMM,
    STG_COUNTRY,
    STG_HEALTH,
    STG_NCD,
    staging_columns,
)

TABLES = (STG_HEALTH, STG_NCD, STG_COMM, STG_COUNTRY)


def row_counts(wh: Warehouse) -> DataFrame:
    return stacked(
        [
            wh.stg(t).agg(F.count("*").alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
            for t in TABLES
        ]
    )


def as_records(df: DataFrame, table: str) -> DataFrame:
    """A staging table as (table_name, record): all its columns in order, joined by '|'."""
    return df.select(
        F.lit(table).alias("table_name"),
        F.concat_ws("|", *staging_columns(table)).alias("record"),
    )


def samples(wh: Warehouse, n: int = 10) -> DataFrame:
    """The first n records of each table in text order."""
    return stacked([as_records(wh.stg(t), t).orderBy("record").limit(n) for t in TABLES])


def frequency(wh: Warehouse, table: str, column: str) -> DataFrame:
    return wh.stg(table).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def text_year_range(wh: Warehouse) -> DataFrame:
    """Smallest and largest year as *text*, exactly as staged."""
    return wh.stg(STG_HEALTH).agg(F.min("raw_year").alias("min_year"), F.max("raw_year").alias("max_year"))


def _bad_year() -> Column:
    return ~is_year(clean_text(F.col("raw_year")))


def _bad_value() -> Column:
    return ~is_number(clean_text(F.col("raw_numeric_value")))


def _bad_bound(column: str) -> Column:
    text = clean_text(F.col(column))
    return ~is_number(text) & ~text.isin("", "None")


def health_checks() -> dict[str, Column]:
    return {
        "bad_year": _bad_year(),
        "bad_numeric_value": _bad_value(),
        "bad_low": _bad_bound("raw_low"),
        "bad_high": _bad_bound("raw_high"),
        "empty_country_code": is_blank(F.col("raw_country_code")),
        "empty_sex_code": is_blank(F.col("raw_sex_code")),
    }


def ncd_checks() -> dict[str, Column]:
    return {
        "bad_year": _bad_year(),
        "bad_numeric_value": _bad_value(),
        "empty_cause_code": is_blank(F.col("raw_cause_code")),
        "empty_country_code": is_blank(F.col("raw_country_code")),
    }


def comm_checks() -> dict[str, Column]:
    return {
        "bad_year": _bad_year(),
        "bad_numeric_value": _bad_value(),
        "empty_disease_name": is_blank(F.col("raw_disease_name")),
    }


def _counted(stg: DataFrame, checks: dict[str, Column]) -> DataFrame:
    return stg.agg(*[F.count_if(check).alias(name) for name, check in checks.items()])


def parse_health(wh: Warehouse) -> DataFrame:
    return _counted(wh.stg(STG_HEALTH), health_checks())


def parse_ncd(wh: Warehouse) -> DataFrame:
    return _counted(wh.stg(STG_NCD), ncd_checks())


def parse_comm(wh: Warehouse) -> DataFrame:
    return _counted(wh.stg(STG_COMM), comm_checks())


def missing_region(wh: Warehouse) -> DataFrame:
    lost = is_blank(F.col("raw_region_code")) | is_blank(F.col("raw_region_name"))
    return wh.stg(STG_COUNTRY).filter(lost).select("raw_country_code", "raw_country_name")


def control_characters(wh: Warehouse) -> DataFrame:
    """Country columns holding invisible characters: how many rows, and one value in hex."""
    columns = staging_columns(STG_COUNTRY)
    return (
        wh.stg(STG_COUNTRY)
        .unpivot([], columns, "column_name", "value")
        .filter(has_control_chars(F.col("value")))
        .groupBy("column_name")
        .agg(F.count("*").alias("n_rows"), F.hex(F.min("value")).alias("sample_hex"))
    )
