"""The quality checklist.

Checks on nulls, references, ranges and negatives read *typed staging*, before
the load filters make them true by construction; bounds and consistency checks
read the core.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.operators import quality as Q
from starhouse.operators.loading import parsed, referenced, typed_staging
from starhouse.operators.rules import split
from starhouse.plans.warehouse import Warehouse
from starhouse.schemas import COMM_FACT, HEALTH_FACT, NCD_FACT, FactSpec

Check = Callable[[Warehouse], DataFrame]


def typed(wh: Warehouse, spec: FactSpec) -> DataFrame:
    return typed_staging(wh.stg(spec.staging), spec)


def nulls_health(wh: Warehouse) -> DataFrame:
    return Q.null_counts(
        typed(wh, HEALTH_FACT),
        {
            "indicator_code": "null_indicator",
            "country_code": "null_country",
            "year_val": "null_year",
            "sex_code": "null_sex",
            "metric_value": "null_metric",
        },
    )


def nulls_ncd(wh: Warehouse) -> DataFrame:
    return Q.null_counts(
        typed(wh, NCD_FACT),
        {
            "cause_code": "null_cause",
            "country_code": "null_country",
            "year_val": "null_year",
            "death_count": "null_deaths",
        },
    )


def nulls_comm(wh: Warehouse) -> DataFrame:
    return Q.null_counts(
        typed(wh, COMM_FACT),
        {
            "disease_code": "null_disease",
            "country_code": "null_country",
            "year_val": "null_year",
            "death_count": "null_deaths",
        },
    )


def orphan_check(spec: FactSpec, dim: str, key: str, name: str) -> Check:
    def check(wh: Warehouse) -> DataFrame:
        return Q.orphans(typed(wh, spec), wh.dim(dim), key, name, small_dim=dim != "dim_country")

    return check


def duplicate_check(spec: FactSpec, limit: int) -> Check:
    """Repeated business keys of typed staging; the refresh refuses them where they would load."""
    return lambda wh: Q.duplicates(typed(wh, spec), spec.key, limit)


def year_range_health(wh: Warehouse) -> DataFrame:
    return Q.value_range(wh.health, "year_val", "min_year", "max_year", "n_distinct_years")


def year_range(spec: FactSpec) -> Check:
    return lambda wh: Q.value_range(wh.fact(spec), "year_val", "min_year", "max_year")


def negative_life_expectancy(wh: Warehouse) -> DataFrame:
    guarded = F.col("indicator_code").isin(*wh.profile.non_negative)
    return Q.count_where(
        typed(wh, HEALTH_FACT), guarded & (F.col("metric_value") < 0), "negative_life_expectancy"
    )


def negative_mortality(wh: Warehouse) -> DataFrame:
    kind = F.col("indicator_code") == wh.profile.adult_mortality
    return Q.count_where(typed(wh, HEALTH_FACT), kind & (F.col("metric_value") < 0), "negative_mortality")


def above_bound(wh: Warehouse) -> DataFrame:
    p = wh.profile
    suspicious = (F.col("indicator_code") == p.life_expectancy) & (F.col("metric_value") > p.value_bound)
    return typed(wh, HEALTH_FACT).filter(suspicious).select(
        "country_code", "year_val", "sex_code", "metric_value"
    )


def negative_deaths(spec: FactSpec, name: str) -> Check:
    return lambda wh: Q.count_where(typed(wh, spec), F.col("death_count") < 0, name)


def interval_coverage(wh: Warehouse) -> DataFrame:
    return Q.coverage(wh.health, "indicator_code")


def inverted_health(wh: Warehouse) -> DataFrame:
    counted = Q.count_where(wh.health, Q.inverted(), "n_affected")
    return counted.select(F.lit("inverted interval").alias("issue"), "n_affected")


def inverted_detail(wh: Warehouse, limit: int = 10) -> DataFrame:
    return (
        wh.health.filter(Q.inverted())
        .select("fact_id", *HEALTH_FACT.key, "metric_value", "low_ci", "high_ci")
        .orderBy("fact_id")
        .limit(limit)
    )


def inverted_count(spec: FactSpec, name: str) -> Check:
    return lambda wh: Q.count_where(wh.fact(spec), Q.inverted(), name)


def repaired(wh: Warehouse) -> DataFrame:
    """The health fact with inverted bounds swapped back; ``publish_repaired`` makes it current."""
    return Q.repair_inverted(wh.health)


def published_bounds(wh: Warehouse) -> DataFrame:
    return wh.health.select("fact_id", *HEALTH_FACT.key, "low_ci", "high_ci")


def remaining_inverted(wh: Warehouse) -> DataFrame:
    return Q.count_where(wh.health, Q.inverted(), "remaining_inverted")


def repair_detail(wh: Warehouse) -> DataFrame:
    return repaired(wh).select("fact_id", *HEALTH_FACT.key, "low_ci", "high_ci")


def repair_verify(wh: Warehouse) -> DataFrame:
    return Q.count_where(repaired(wh), Q.inverted(), "remaining_inverted")


def cross_consistency(wh: Warehouse, limit: int = 10) -> DataFrame:
    """Healthy life expectancy above life expectancy, same country, year and sex."""
    p = wh.profile
    kind, value = F.col("indicator_code"), F.col("metric_value")
    return (
        wh.health.filter(kind.isin(p.life_expectancy, p.healthy_life))
        .groupBy("country_code", "year_val", "sex_code")
        .agg(
            F.max(F.when(kind == p.life_expectancy, value)).alias("_total"),
            F.max(F.when(kind == p.healthy_life, value)).alias("_healthy"),
        )
        .filter(F.col("_healthy") > F.col("_total"))
        .orderBy("country_code", "year_val", "sex_code")
        .limit(limit)
        .select(
            "country_code",
            "year_val",
            "sex_code",
            F.round("_total", 1).alias("life_expectancy"),
            F.round("_healthy", 1).alias("hale"),
            F.round(F.col("_total") - F.col("_healthy"), 1).alias("gap"),
        )
    )


def rule_candidates(wh: Warehouse) -> DataFrame:
    """Rows the load would insert if no rule stood in the way."""
    spec = HEALTH_FACT
    return referenced(parsed(wh.stg(spec.staging), spec, wh.profile), spec, wh.dims())


def rule_rejects(wh: Warehouse) -> DataFrame:
    _, rejects = split(rule_candidates(wh), HEALTH_FACT, wh.profile)
    return rejects.select(*HEALTH_FACT.key, "metric_value", "reason")


def rule_accepted(wh: Warehouse) -> DataFrame:
    accepted, _ = split(rule_candidates(wh), HEALTH_FACT, wh.profile)
    return accepted.select(*HEALTH_FACT.key, "metric_value")


CHECKS: dict[str, Check] = {
    "dq_nulls_health": nulls_health,
    "dq_orphan_country_health": orphan_check(HEALTH_FACT, "dim_country", "country_code", "orphan_country"),
    "dq_orphan_indicator": orphan_check(HEALTH_FACT, "dim_indicator", "indicator_code", "orphan_indicator"),
    "dq_orphan_sex": orphan_check(HEALTH_FACT, "dim_sex", "sex_code", "orphan_sex"),
    "dq_dups_health": duplicate_check(HEALTH_FACT, 20),
    "dq_year_range_health": year_range_health,
    "dq_negative_le": negative_life_expectancy,
    "dq_negative_mortality": negative_mortality,
    "dq_above_bound": above_bound,
    "dq_ci_coverage": interval_coverage,
    "dq_inverted_health": inverted_health,
    "dq_inverted_detail": inverted_detail,
    "dq_repair_inverted": repair_detail,
    "dq_repair_verify": repair_verify,
    "dq_cross_consistency": cross_consistency,
    "dq_nulls_ncd": nulls_ncd,
    "dq_orphan_cause": orphan_check(NCD_FACT, "dim_cause", "cause_code", "orphan_cause"),
    "dq_orphan_country_ncd": orphan_check(NCD_FACT, "dim_country", "country_code", "orphan_country_deaths"),
    "dq_dups_ncd": duplicate_check(NCD_FACT, 10),
    "dq_negative_ncd": negative_deaths(NCD_FACT, "negative_deaths"),
    "dq_year_range_ncd": year_range(NCD_FACT),
    "dq_inverted_ncd": inverted_count(NCD_FACT, "inverted_ci_deaths"),
    "dq_nulls_comm": nulls_comm,
    "dq_orphan_disease": orphan_check(COMM_FACT, "dim_disease", "disease_code", "orphan_disease"),
    "dq_orphan_country_comm": orphan_check(COMM_FACT, "dim_country", "country_code", "orphan_country_comm"),
    "dq_dups_comm": duplicate_check(COMM_FACT, 10),
    "dq_negative_comm": negative_deaths(COMM_FACT, "negative_comm_deaths"),
    "dq_year_range_comm": year_range(COMM_FACT),
    "dq_inverted_comm": inverted_count(COMM_FACT, "inverted_ci_comm"),
}
