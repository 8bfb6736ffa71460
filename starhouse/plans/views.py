"""Semantic views: facts with their labels, and the KPIs derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starhouse.functions.measures import percent, register_sql_functions
from starhouse.plans.warehouse import Warehouse
from starhouse.schemas import CSV_COLUMNS, FACTS


def health_enriched(wh: Warehouse) -> DataFrame:
    return (
        wh.health.join(F.broadcast(wh.dim("dim_indicator")), "indicator_code")
        .join(F.broadcast(wh.dim("dim_sex")), "sex_code")
        .join(wh.country(), "country_code")
        .select(
            "fact_id",
            "indicator_code",
            "indicator_name",
            "unit",
            "country_code",
            "country_name",
            "region_code",
            "region_name",
            "year_val",
            "sex_code",
            "sex_name",
            "metric_value",
            "low_ci",
            "high_ci",
            F.round(F.col("high_ci") - F.col("low_ci"), 4).alias("ci_width"),
        )
    )


def deaths_enriched(wh: Warehouse) -> DataFrame:
    return (
        wh.ncd.join(F.broadcast(wh.dim("dim_cause")), "cause_code")
        .join(F.broadcast(wh.dim("dim_sex")), "sex_code")
        .join(wh.country(), "country_code")
        .select(
            "fact_id",
            "cause_code",
            "cause_name",
            "country_code",
            "country_name",
            "region_code",
            "region_name",
            "year_val",
            "sex_code",
            "sex_name",
            "death_count",
            "low_ci",
            "high_ci",
        )
    )


def communicable_enriched(wh: Warehouse) -> DataFrame:
    return (
        wh.comm.join(F.broadcast(wh.dim("dim_disease").drop("disease_type")), "disease_code")
        .join(wh.country(), "country_code")
        .select(
            "fact_id",
            "disease_code",
            "disease_name",
            "country_code",
            "country_name",
            "region_code",
            "region_name",
            "year_val",
            "death_count",
            "low_ci",
            "high_ci",
        )
    )


def yearly_kpi(wh: Warehouse) -> DataFrame:
    """Aggregated on codes; labels are joined to the few result rows."""
    value = F.col("metric_value")
    return labelled_kpi(
        wh,
        wh.health.groupBy("indicator_code", "year_val", "sex_code").agg(
            F.count("*").alias("n_countries"),
            F.round(F.avg(value), 2).alias("avg_value"),
            F.round(F.min(value), 2).alias("min_value"),
            F.round(F.max(value), 2).alias("max_value"),
            F.round(F.stddev_pop(value).cast("decimal(38,10)"), 2).alias("stddev_value"),
        ),
    )


def labelled_kpi(wh: Warehouse, groups: DataFrame) -> DataFrame:
    return (
        groups.join(F.broadcast(wh.dim("dim_indicator")), "indicator_code")
        .join(F.broadcast(wh.dim("dim_sex")), "sex_code")
        .select(
            "indicator_code",
            "indicator_name",
            "unit",
            "year_val",
            "sex_name",
            "n_countries",
            "avg_value",
            "min_value",
            "max_value",
            "stddev_value",
        )
    )


def region_yearly_kpi(wh: Warehouse) -> DataFrame:
    per_region = (
        wh.health.filter(F.col("sex_code") == wh.profile.both_sexes)
        .join(wh.country().select("country_code", "region_name"), "country_code")
        .groupBy("indicator_code", "year_val", "region_name")
        .agg(
            F.count_distinct("country_code").alias("n_countries"),
            F.round(F.avg("metric_value"), 2).alias("avg_value"),
        )
    )
    return with_region_share(wh, per_region)


def with_region_share(wh: Warehouse, per_region: DataFrame) -> DataFrame:
    # The window runs over aggregated rows: one per region of an indicator and year.
    total = F.sum("avg_value").over(Window.partitionBy("indicator_code", "year_val"))
    return (
        per_region.withColumn("region_share_pct", percent(F.col("avg_value"), total, 2))
        .join(F.broadcast(wh.dim("dim_indicator").drop("unit")), "indicator_code")
        .select(
            "indicator_code",
            "indicator_name",
            "year_val",
            "region_name",
            "n_countries",
            "avg_value",
            "region_share_pct",
        )
    )


def yearly_deaths_by_cause(wh: Warehouse) -> DataFrame:
    return labelled_deaths(
        wh,
        wh.ncd.filter(F.col("sex_code") == wh.profile.both_sexes)
        .groupBy("cause_code", "year_val")
        .agg(
            F.sum("death_count").alias("total_deaths"),
            F.count_distinct("country_code").alias("n_countries"),
            F.round(F.avg("death_count"), 0).alias("avg_deaths_per_country"),
        ),
    )


def labelled_deaths(wh: Warehouse, groups: DataFrame) -> DataFrame:
    return groups.join(F.broadcast(wh.dim("dim_cause")), "cause_code").select(
        "cause_code", "cause_name", "year_val", "total_deaths", "n_countries", "avg_deaths_per_country"
    )


VIEWS: dict[str, Callable[[Warehouse], DataFrame]] = {
    "vw_health_enriched": health_enriched,
    "vw_yearly_kpi": yearly_kpi,
    "vw_region_yearly_kpi": region_yearly_kpi,
    "vw_deaths_enriched": deaths_enriched,
    "vw_yearly_deaths_by_cause": yearly_deaths_by_cause,
    "vw_communicable_enriched": communicable_enriched,
}


def publish_views(wh: Warehouse, staging: bool = False) -> list[str]:
    """Make tables, views and functions available to SQL by name, replacing older ones."""
    tables = {spec.name: wh.fact(spec) for spec in FACTS} | wh.dims()
    if staging:
        tables |= {name: wh.stg(name) for name in CSV_COLUMNS}
    for name, df in (tables | {name: view(wh) for name, view in VIEWS.items()}).items():
        df.createOrReplaceTempView(name)
    register_sql_functions(wh.spark)
    return list(VIEWS)
