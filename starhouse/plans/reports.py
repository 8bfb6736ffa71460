"""Report datasets: variants of the analysis questions shaped for presentation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.functions.measures import percent
from starhouse.operators.ordering import group_quantiles
from starhouse.plans import analytics as A
from starhouse.plans.warehouse import Warehouse


def rp02_yoy_signed(wh: Warehouse) -> DataFrame:
    """Years with a defined change, classed by its sign."""
    sign = F.when(F.col("yoy_change_pct") < 0, "decrease").otherwise("increase")
    return (
        A.yearly_change(wh)
        .dropna(subset=["yoy_change_pct"])
        .withColumn("direction", sign)
        .orderBy("year_val")
    )


def rp06_pair_all(wh: Warehouse) -> DataFrame:
    """The indicator pair of every country, joined on country, year and sex."""
    p = wh.profile
    kind = F.col("indicator_code")
    pairs = (
        A.health_slice(wh, [p.life_expectancy, p.adult_mortality], [p.late_year])
        .groupBy("country_code", "year_val", "sex_code")
        .agg(
            F.round(F.max(A.only(kind == p.life_expectancy, A.metric())), 1).alias("life_expectancy"),
            F.round(F.max(A.only(kind == p.adult_mortality, A.metric())), 1).alias("adult_mortality"),
        )
        .dropna(subset=["life_expectancy", "adult_mortality"])
    )
    return A.with_country(pairs, wh, "country_name", "region_name").select(
        "country_name", "region_name", "life_expectancy", "adult_mortality"
    )


def rp08_concentration20(wh: Warehouse) -> DataFrame:
    return (
        A.mortality_concentration(wh, 20)
        .select("country_name", "adult_mortality", "rn", "cumulative_pct")
        .orderBy("rn")
    )


def rp09_region_box(wh: Warehouse) -> DataFrame:
    """Box statistics of the rounded value per region, best median first."""
    p = wh.profile
    rows = A.with_country(
        A.health_slice(wh, [p.healthy_life], [p.late_year]), wh, "region_name"
    ).select("region_name", F.round(A.metric(), 1).alias("hale"))
    box = {"min_hale": "0", "q1_hale": "0.25", "median_hale": "0.5", "q3_hale": "0.75", "max_hale": "1"}
    return group_quantiles(rows, "region_name", "hale", box).orderBy(
        F.desc("median_hale"), "region_name"
    )


def rp10_decliners15(wh: Warehouse) -> DataFrame:
    p = wh.profile
    order = [F.asc("le_change"), A.code()]
    worst = A.decliners(wh).orderBy(*order).limit(15)
    return (
        A.few_with_country(worst, wh, "country_name", "region_name")
        .orderBy(*order)
        .select(
            "country_name", "region_name", f"le_{p.base_year}", f"le_{p.late_year}", "le_change"
        )
    )


def rp12_top_cause20(wh: Warehouse) -> DataFrame:
    p = wh.profile
    kind = F.when(F.col("cause_code") == p.cardiovascular, "Cardiovascular").otherwise("Other")
    return A.top_cause(wh, 20).select(
        "country_name",
        "region_name",
        "cause_name",
        f"deaths_{p.deaths_year}",
        kind.alias("cause_class"),
    )


def rp13_share_matrix(wh: Warehouse) -> DataFrame:
    """Regions by causes, percentages; a cause without deaths is 0."""
    causes = [name for _, name in wh.profile.causes]
    return (
        A.region_cause_shares(wh)
        .groupBy("region_name")
        .pivot("cause_name", causes)
        .agg(F.max("pct_of_region"))
        .fillna(0)
        .orderBy("region_name")
    )


def rp14_cross_fact_labels(wh: Warehouse) -> DataFrame:
    """All country pairs of the cross-fact question; the five largest are flagged."""
    pairs = A.cross_fact(wh).select(
        "country_code",
        F.round(A.metric(), 1).alias("life_expectancy"),
        F.round(A.death_count(), 0).alias("cv_deaths"),
    )
    largest = (
        pairs.orderBy(F.desc("cv_deaths"), A.code())
        .limit(5)
        .select("country_code", F.lit(True).alias("labelled"))
    )
    flagged = pairs.join(F.broadcast(largest), "country_code", "left").withColumn(
        "labelled", F.coalesce("labelled", F.lit(False))
    )
    return A.with_country(flagged, wh, "country_name", "region_name").select(
        "country_name", "region_name", "life_expectancy", "cv_deaths", "labelled"
    )


def rp17_type_matrix(wh: Warehouse) -> DataFrame:
    """Regions by kind of death, with the total and the communicable share."""
    total = F.col("ncd_deaths") + F.col("communicable_deaths")
    kind = F.col("disease_type")
    deaths = F.col("total_deaths")
    return (
        A.deaths_by_region(wh, [wh.profile.deaths_year])
        .groupBy("region_name")
        .agg(
            F.coalesce(F.sum(F.when(kind == "NCD", deaths)), F.lit(0)).alias("ncd_deaths"),
            F.coalesce(F.sum(F.when(kind == "Communicable", deaths)), F.lit(0)).alias(
                "communicable_deaths"
            ),
        )
        .withColumn("total", total)
        .withColumn(
            "pct_communicable",
            F.coalesce(percent(F.col("communicable_deaths"), F.col("total"), 2), F.lit(0)),
        )
        .orderBy("total", "region_name")
    )


def rp18_ratio_by_year(wh: Warehouse) -> DataFrame:
    """Both years' ratios side by side; 0 for a year the region has no row in."""
    p = wh.profile
    year = F.col("year_val")

    def ratio(y: int):
        present = F.max(F.when(year == y, 1))
        return (
            F.when(present.isNull(), F.lit(0))
            .otherwise(F.max(F.when(year == y, F.col("ncd_to_comm_ratio"))))
            .alias(f"ratio_{y}")
        )

    return (
        A.transition_ratio(wh)
        .groupBy("region_name")
        .agg(ratio(p.deaths_base_year), ratio(p.deaths_year))
        .orderBy("region_name")
    )


def rp19_burden20(wh: Warehouse) -> DataFrame:
    return A.total_burden(wh, 20)


def rp20_double15(wh: Warehouse) -> DataFrame:
    share = F.coalesce(percent(F.col("communicable_deaths"), F.col("total_deaths"), 2), F.lit(0))
    return A.double_burden(wh, 15, share)


REPORTS = {
    f.__name__: f
    for f in (
        rp02_yoy_signed,
        rp06_pair_all,
        rp08_concentration20,
        rp09_region_box,
        rp10_decliners15,
        rp12_top_cause20,
        rp13_share_matrix,
        rp14_cross_fact_labels,
        rp17_type_matrix,
        rp18_ratio_by_year,
        rp19_burden20,
        rp20_double15,
    )
}
