"""The twenty analysis questions.

Conventions that keep the plans lean at scale:

* filters are on codes and years stored in the facts, so they reach the scan
  (folder pruning by year, Parquet statistics on codes);
* two indicators or two years of the same fact are read in one pass with
  conditional aggregates, since the business key is unique at load;
* labels are joined after the aggregate or after the top-n, not before;
* the country dimension grows with the data and carries no broadcast hint, so
  Spark chooses its join by measured size; only results bounded by a limit or by
  a static dimension are hinted.

Rankings use the country code as the last sort key, so ties have one answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.functions.measures import percent, quotient, safe_pct
from starhouse.operators.ordering import concentration, top_n_per_group, with_dense_rank
from starhouse.plans.warehouse import Warehouse

def metric() -> Column:
    return F.col("metric_value")


def death_count() -> Column:
    return F.col("death_count")


def code() -> Column:
    return F.col("country_code")


# --- slices and labels -------------------------------------------------------


def health_slice(wh: Warehouse, indicators: list[str], years: list[int] | None = None) -> DataFrame:
    """Both-sexes rows of some indicators, optionally of some years."""
    rows = wh.health.filter(
        F.col("indicator_code").isin(indicators) & (F.col("sex_code") == wh.profile.both_sexes)
    )
    return rows.filter(F.col("year_val").isin(years)) if years else rows


def ncd_slice(wh: Warehouse, years: list[int] | None = None) -> DataFrame:
    """Both-sexes rows only: the communicable fact has no sex axis to compare with."""
    rows = wh.ncd.filter(F.col("sex_code") == wh.profile.both_sexes)
    return rows.filter(F.col("year_val").isin(years)) if years else rows


def comm_slice(wh: Warehouse, years: list[int]) -> DataFrame:
    return wh.comm.filter(F.col("year_val").isin(years))


def with_country(df: DataFrame, wh: Warehouse, *columns: str) -> DataFrame:
    return df.join(wh.country().select("country_code", *columns), "country_code")


def few_with_country(top: DataFrame, wh: Warehouse, *columns: str) -> DataFrame:
    """The same for the result of a limit: those few rows are sent to the country
    dimension, which is read in place and never shuffled."""
    return with_country(F.broadcast(top), wh, *columns)


def with_label(df: DataFrame, wh: Warehouse, dim: str, code: str, label: str) -> DataFrame:
    """Label from a static dimension (a few literal rows)."""
    return df.join(F.broadcast(wh.dim(dim).select(code, label)), code)


def only(condition: Column, value: Column) -> Column:
    return F.when(condition, value)


# --- health estimates --------------------------------------------------------


def q01_yearly_trend(wh: Warehouse) -> DataFrame:
    return (
        health_slice(wh, [wh.profile.life_expectancy])
        .groupBy("year_val")
        .agg(
            F.round(F.avg(metric()), 2).alias("avg_life_expectancy"),
            F.count_distinct("country_code").alias("n_countries"),
        )
        .orderBy("year_val")
    )


def yearly_change(wh: Warehouse) -> DataFrame:
    """Average per year with the previous one; the average is rounded before it is compared."""
    yearly = (
        health_slice(wh, [wh.profile.life_expectancy])
        .groupBy("year_val")
        .agg(F.round(F.avg(metric()), 4).alias("avg_le"))
    )
    # One row per year, and the load admits two centuries of years: a small window.
    previous = F.lag("avg_le").over(Window.orderBy("year_val"))
    return yearly.withColumn("prev_year_le", previous).withColumn(
        "yoy_change_pct", percent(F.col("avg_le") - F.col("prev_year_le"), F.col("prev_year_le"), 3)
    )


def q02_yoy_change(wh: Warehouse) -> DataFrame:
    return yearly_change(wh).orderBy("year_val")


def q03_top10(wh: Warehouse) -> DataFrame:
    p = wh.profile
    top = (
        health_slice(wh, [p.life_expectancy], [p.late_year])
        .select("country_code", "metric_value")
        .orderBy(metric().desc(), code())
        .limit(10)
    )
    return (
        few_with_country(top, wh, "country_name", "region_name")
        .orderBy(metric().desc(), code())
        .select(
            "country_name", "region_name", F.round(metric(), 1).alias(f"life_expectancy_{p.late_year}")
        )
    )


def q04_top3_per_region(wh: Warehouse) -> DataFrame:
    p = wh.profile
    rows = with_country(
        health_slice(wh, [p.life_expectancy], [p.late_year]), wh, "country_name", "region_name"
    )
    ranked = top_n_per_group(rows, "region_name", [metric().desc(), code()], 3)
    return ranked.select(
        "region_name", "country_name", F.round(metric(), 1).alias("life_expectancy"), "rn"
    ).orderBy("region_name", "rn")


def q05_gap_pivot(wh: Warehouse) -> DataFrame:
    p = wh.profile
    rows = wh.health.filter(
        (F.col("indicator_code") == p.life_expectancy)
        & (F.col("year_val") == p.late_year)
        & F.col("sex_code").isin(p.female, p.male)
    )
    sex = F.col("sex_code")
    return (
        with_country(rows, wh, "region_name")
        .groupBy("region_name")
        .agg(
            F.round(F.avg(only(sex == p.female, metric())), 2).alias("female_le"),
            F.round(F.avg(only(sex == p.male, metric())), 2).alias("male_le"),
        )
        .withColumn("gender_gap", F.round(F.col("female_le") - F.col("male_le"), 2))
        .orderBy(F.desc_nulls_last("gender_gap"), "region_name")
    )


def indicator_pairs(wh: Warehouse) -> DataFrame:
    """Life expectancy and adult mortality per country, where both exist."""
    p = wh.profile
    kind = F.col("indicator_code")
    return (
        health_slice(wh, [p.life_expectancy, p.adult_mortality], [p.late_year])
        .groupBy("country_code")
        .agg(
            F.round(F.max(only(kind == p.life_expectancy, metric())), 1).alias("life_expectancy"),
            F.round(F.max(only(kind == p.adult_mortality, metric())), 1).alias("adult_mortality"),
        )
        .dropna()
    )


def q06_indicator_pair(wh: Warehouse) -> DataFrame:
    order = [F.desc("life_expectancy"), code()]
    top = indicator_pairs(wh).orderBy(*order).limit(20)
    return (
        few_with_country(top, wh, "country_name", "region_name")
        .orderBy(*order)
        .select("country_name", "region_name", "life_expectancy", "adult_mortality")
    )


def q07_region_improvement(wh: Warehouse) -> DataFrame:
    p = wh.profile
    year = F.col("year_val")
    early, late = F.col(f"avg_le_{p.base_year}"), F.col(f"avg_le_{p.late_year}")
    rows = health_slice(wh, [p.life_expectancy], [p.base_year, p.late_year])
    return (
        with_country(rows, wh, "region_name")
        .groupBy("region_name")
        .agg(
            F.round(F.avg(only(year == p.base_year, metric())), 2).alias(f"avg_le_{p.base_year}"),
            F.round(F.avg(only(year == p.late_year, metric())), 2).alias(f"avg_le_{p.late_year}"),
        )
        .filter(early.isNotNull() & late.isNotNull())
        .withColumn("improvement", F.round(late - early, 2))
        .withColumn("improvement_pct", percent(late - early, early, 2))
        .orderBy(F.desc("improvement"), "region_name")
    )


def mortality_concentration(wh: Warehouse, n: int) -> DataFrame:
    p = wh.profile
    rows = health_slice(wh, [p.adult_mortality], [p.late_year]).select("country_code", "metric_value")
    top = concentration(rows, "country_code", "metric_value", n)
    return few_with_country(top, wh, "country_name", "region_name").select(
        "country_name",
        "region_name",
        F.round(metric(), 1).alias("adult_mortality"),
        percent(metric(), F.col("grand_total"), 2).alias("pct_of_total"),
        percent(F.col("running_total"), F.col("grand_total"), 2).alias("cumulative_pct"),
        "rn",
    )


def q08_concentration(wh: Warehouse) -> DataFrame:
    return mortality_concentration(wh, 10).orderBy("rn").drop("rn")


def q09_dense_rank(wh: Warehouse) -> DataFrame:
    p = wh.profile
    rows = with_country(
        health_slice(wh, [p.healthy_life], [p.late_year]).select("country_code", "metric_value"),
        wh,
        "country_name",
        "region_name",
    )
    return (
        with_dense_rank(rows, "region_name", "metric_value", "region_rank")
        .orderBy("region_name", "region_rank", code())
        .select("region_name", "country_name", F.round(metric(), 1).alias(f"hale_{p.late_year}"), "region_rank")
    )


def decliners(wh: Warehouse) -> DataFrame:
    p = wh.profile
    year = F.col("year_val")
    return (
        health_slice(wh, [p.life_expectancy], [p.base_year, p.late_year])
        .groupBy("country_code")
        .agg(
            F.max(only(year == p.base_year, metric())).alias("_early"),
            F.max(only(year == p.late_year, metric())).alias("_late"),
        )
        .filter(F.col("_late") < F.col("_early"))
        .select(
            "country_code",
            F.round("_early", 1).alias(f"le_{p.base_year}"),
            F.round("_late", 1).alias(f"le_{p.late_year}"),
            F.round(F.col("_late") - F.col("_early"), 2).alias("le_change"),
        )
    )


def q10_decliners(wh: Warehouse) -> DataFrame:
    p = wh.profile
    return (
        with_country(decliners(wh), wh, "country_name", "region_name")
        .orderBy("le_change", code())
        .select(
            "country_name", "region_name", f"le_{p.base_year}", f"le_{p.late_year}", "le_change"
        )
    )


# --- deaths by cause ---------------------------------------------------------


def q11_cause_trend(wh: Warehouse) -> DataFrame:
    totals = (
        ncd_slice(wh)
        .groupBy("year_val", "cause_code")
        .agg(F.round(F.sum(death_count()), 0).alias("total_deaths"))
    )
    return (
        with_label(totals, wh, "dim_cause", "cause_code", "cause_name")
        .select("year_val", "cause_name", "total_deaths")
        .orderBy("year_val", F.desc("total_deaths"), "cause_name")
    )


def top_cause(wh: Warehouse, n: int) -> DataFrame:
    """The leading cause of each country, for the n countries where it is largest."""
    p = wh.profile
    rows = ncd_slice(wh, [p.deaths_year]).select("country_code", "cause_code", "death_count")
    leading = top_n_per_group(rows, "country_code", [death_count().desc(), F.col("cause_code")], 1)
    deaths = F.col(f"deaths_{p.deaths_year}")
    top = (
        leading.select("country_code", "cause_code", F.round(death_count(), 0).alias(f"deaths_{p.deaths_year}"))
        .orderBy(deaths.desc(), code())
        .limit(n)
    )
    labelled = with_label(top, wh, "dim_cause", "cause_code", "cause_name")
    return few_with_country(labelled, wh, "country_name", "region_name").orderBy(
        deaths.desc(), code()
    )


def q12_top_cause(wh: Warehouse) -> DataFrame:
    return top_cause(wh, 30).select(
        "country_name", "region_name", "cause_name", f"deaths_{wh.profile.deaths_year}"
    )


def region_cause_shares(wh: Warehouse) -> DataFrame:
    rows = with_country(ncd_slice(wh, [wh.profile.deaths_year]), wh, "region_name")
    totals = rows.groupBy("region_name", "cause_code").agg(
        F.round(F.sum(death_count()), 0).alias("total_deaths")
    )
    # Aggregated rows: as many per region as there are causes.
    of_region = F.sum("total_deaths").over(Window.partitionBy("region_name"))
    shares = totals.withColumn("pct_of_region", percent(F.col("total_deaths"), of_region, 1))
    return with_label(shares, wh, "dim_cause", "cause_code", "cause_name")


def q13_cause_share(wh: Warehouse) -> DataFrame:
    return (
        region_cause_shares(wh)
        .select("region_name", "cause_name", "total_deaths", "pct_of_region")
        .orderBy("region_name", F.desc("pct_of_region"), "cause_name")
    )


def cross_fact(wh: Warehouse) -> DataFrame:
    """Life expectancy next to cardiovascular deaths: two facts on country, year and sex."""
    p = wh.profile
    keys = ["country_code", "year_val", "sex_code"]
    life = health_slice(wh, [p.life_expectancy], [p.deaths_year]).select(*keys, "metric_value")
    deaths = (
        ncd_slice(wh, [p.deaths_year])
        .filter(F.col("cause_code") == p.cardiovascular)
        .select(*keys, "death_count")
    )
    return life.join(deaths, keys)


def q14_cross_fact(wh: Warehouse) -> DataFrame:
    order = [death_count().desc(), code()]
    top = cross_fact(wh).orderBy(*order).limit(20)
    return (
        few_with_country(top, wh, "country_name", "region_name")
        .orderBy(*order)
        .select(
            "country_name",
            "region_name",
            F.round(metric(), 1).alias("life_expectancy"),
            F.round(death_count(), 0).alias("cardiovascular_deaths"),
        )
    )


# --- communicable deaths -----------------------------------------------------


def q15_disease_trend(wh: Warehouse) -> DataFrame:
    totals = wh.comm.groupBy("year_val", "disease_code").agg(
        F.round(F.sum(death_count()), 0).alias("total_deaths"),
        F.count_distinct("country_code").alias("n_countries"),
    )
    return (
        with_label(totals, wh, "dim_disease", "disease_code", "disease_name")
        .select("year_val", "disease_name", "total_deaths", "n_countries")
        .orderBy("year_val", F.desc("total_deaths"), "disease_name")
    )


def q16_latest_top5(wh: Warehouse) -> DataFrame:
    latest = wh.comm.groupBy("disease_code").agg(F.max("year_val").alias("year_val"))
    # One row per disease, and diseases are a static dimension.
    rows = wh.comm.join(F.broadcast(latest), ["disease_code", "year_val"])
    top = top_n_per_group(
        rows.select("disease_code", "country_code", "year_val", "death_count"),
        "disease_code",
        [death_count().desc(), code()],
        5,
    )
    labelled = with_label(top, wh, "dim_disease", "disease_code", "disease_name")
    return (
        few_with_country(labelled, wh, "country_name", "region_name")
        .orderBy("disease_name", "rn")
        .select(
            "disease_name", "country_name", "region_name", "year_val", F.round(death_count(), 0).alias("deaths")
        )
    )


# --- both kinds of deaths ----------------------------------------------------


def deaths_by_region(wh: Warehouse, years: list[int]) -> DataFrame:
    """(region_name, year_val, disease_type, total_deaths) of both facts, stacked."""

    def totals(rows: DataFrame, kind: str) -> DataFrame:
        return (
            with_country(rows.select("country_code", "year_val", "death_count"), wh, "region_name")
            .groupBy("region_name", "year_val")
            .agg(F.round(F.sum(death_count()), 0).alias("total_deaths"))
            .withColumn("disease_type", F.lit(kind))
        )

    return totals(ncd_slice(wh, years), "NCD").unionByName(
        totals(comm_slice(wh, years), "Communicable")
    )


def q17_union_share(wh: Warehouse) -> DataFrame:
    # Aggregated rows: two per region.
    of_region = F.sum("total_deaths").over(Window.partitionBy("region_name"))
    return (
        deaths_by_region(wh, [wh.profile.deaths_year])
        .withColumn("pct_of_region", percent(F.col("total_deaths"), of_region, 1))
        .select("region_name", "disease_type", "total_deaths", "pct_of_region")
        .orderBy("region_name", "disease_type")
    )


def transition_ratio(wh: Warehouse) -> DataFrame:
    p = wh.profile
    kind, total = F.col("disease_type"), F.col("total_deaths")
    return (
        deaths_by_region(wh, [p.deaths_base_year, p.deaths_year])
        .groupBy("region_name", "year_val")
        .agg(
            F.sum(F.when(kind == "NCD", total).otherwise(0)).alias("ncd_deaths"),
            F.sum(F.when(kind == "Communicable", total).otherwise(0)).alias("comm_deaths"),
        )
        .withColumn("ncd_to_comm_ratio", quotient(F.col("ncd_deaths"), F.col("comm_deaths"), 1))
    )


def q18_transition_ratio(wh: Warehouse) -> DataFrame:
    return transition_ratio(wh).orderBy("region_name", "year_val")


def deaths_per_country(rows: DataFrame, name: str) -> DataFrame:
    return rows.groupBy("country_code").agg(F.round(F.sum(death_count()), 0).alias(name))


def total_burden(wh: Warehouse, n: int) -> DataFrame:
    """Life expectancy and both death totals per country; a missing total counts as 0."""
    p = wh.profile
    life = health_slice(wh, [p.life_expectancy], [p.deaths_year]).select(
        "country_code", F.round(metric(), 1).alias("life_expectancy")
    )
    ncd = deaths_per_country(ncd_slice(wh, [p.deaths_year]), "_ncd")
    comm = deaths_per_country(comm_slice(wh, [p.deaths_year]), "_comm")
    order = [F.desc("total_deaths"), code()]
    top = (
        life.join(ncd, "country_code", "left")
        .join(comm, "country_code", "left")
        .select(
            "country_code",
            "life_expectancy",
            F.coalesce("_ncd", F.lit(0)).alias("ncd_deaths"),
            F.coalesce("_comm", F.lit(0)).alias("communicable_deaths"),
        )
        .withColumn("total_deaths", F.col("ncd_deaths") + F.col("communicable_deaths"))
        .orderBy(*order)
        .limit(n)
    )
    return (
        few_with_country(top, wh, "country_name", "region_name")
        .orderBy(*order)
        .select(
            "country_name",
            "region_name",
            "life_expectancy",
            "ncd_deaths",
            "communicable_deaths",
            "total_deaths",
        )
    )


def q19_total_burden(wh: Warehouse) -> DataFrame:
    return total_burden(wh, 25)


def double_burden(wh: Warehouse, n: int, share: Column) -> DataFrame:
    """Countries of the focus region with deaths of both kinds, and the communicable share.

    The facts are reduced to the region before they are aggregated, and nothing stands
    between order and limit, so only the first rows of each task are sorted and moved.
    """
    p = wh.profile
    region = (
        wh.country()
        .filter(F.col("region_name") == p.focus_region)
        .select("country_code", "country_name")
    )

    def deaths(rows: DataFrame, name: str) -> DataFrame:
        return deaths_per_country(rows.join(region, "country_code", "left_semi"), name)

    communicable = F.coalesce("_comm", F.lit(0))
    order = [F.desc("total_deaths"), code()]
    return (
        region.join(deaths(ncd_slice(wh, [p.deaths_year]), "ncd_deaths"), "country_code")
        .join(deaths(comm_slice(wh, [p.deaths_year]), "_comm"), "country_code", "left")
        .filter(communicable > 0)
        .withColumn("communicable_deaths", communicable)
        .withColumn("total_deaths", F.col("ncd_deaths") + F.col("communicable_deaths"))
        .withColumn("pct_communicable", share)
        .select("country_code", "country_name", "ncd_deaths", "communicable_deaths", "total_deaths", "pct_communicable")
        .orderBy(*order)
        .limit(n)
        .orderBy(*order)
        .drop("country_code")
    )


def q20_double_burden(wh: Warehouse) -> DataFrame:
    return double_burden(wh, 20, percent(F.col("communicable_deaths"), F.col("total_deaths"), 1))


# --- functions on real data --------------------------------------------------


def region_vs_global(wh: Warehouse) -> DataFrame:
    """Each region's average as a percentage of the average over all countries."""
    p = wh.profile
    rows = health_slice(wh, [p.life_expectancy], [p.late_year]).select("country_code", "metric_value")
    overall = rows.agg(F.avg(metric()).alias("global_avg"))  # one row
    regions = with_country(rows, wh, "region_name").groupBy("region_name").agg(F.avg(metric()).alias("_avg"))
    return (
        regions.crossJoin(F.broadcast(overall))
        .select(
            "region_name",
            F.round("_avg", 2).alias("avg_le"),
            safe_pct(F.col("_avg"), F.col("global_avg")).alias("pct_of_global_avg"),
        )
        .orderBy(F.desc("avg_le"), "region_name")
    )
