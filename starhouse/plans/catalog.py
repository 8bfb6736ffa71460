"""Every plan that needs nothing but a warehouse, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.functions.measures import register_sql_functions
from starhouse.operators.loading import build_country_dim
from starhouse.plans import analytics as A
from starhouse.plans import core as C
from starhouse.plans import quality as Q
from starhouse.plans import staging_reports as S
from starhouse.plans.staging_profile import profiles
from starhouse.plans.reports import REPORTS
from starhouse.plans.views import VIEWS
from starhouse.plans.warehouse import Warehouse
from starhouse.schemas import COMM_FACT, HEALTH_FACT, NCD_FACT, STG_COMM, STG_COUNTRY, STG_HEALTH, STG_NCD

Plan = Callable[[Warehouse], DataFrame]


def interval_widths(wh: Warehouse) -> DataFrame:
    """Interval width of every health estimate at two places, through the SQL function."""
    register_sql_functions(wh.spark)
    width = F.expr("fn_ci_width(low_ci, high_ci)")
    return wh.health.select(*HEALTH_FACT.key, width.alias("ci_width"))


STAGING: dict[str, Plan] = {
    "stg_row_counts": S.row_counts,
    "stg_sample": S.samples,
    "stg_freq_spatial": lambda wh: S.frequency(wh, STG_HEALTH, "raw_spatial_dim_type"),
    "stg_freq_indicator": lambda wh: S.frequency(wh, STG_HEALTH, "raw_indicator_code"),
    "stg_freq_sex": lambda wh: S.frequency(wh, STG_HEALTH, "raw_sex_code"),
    "stg_freq_cause": lambda wh: S.frequency(wh, STG_NCD, "raw_cause_code"),
    "stg_freq_disease": lambda wh: S.frequency(wh, STG_COMM, "raw_disease_name"),
    "stg_year_range_text": S.text_year_range,
    "stg_parse_health": S.parse_health,
    "stg_parse_ncd": S.parse_ncd,
    "stg_parse_comm": S.parse_comm,
    "stg_missing_region": S.missing_region,
    "stg_profile": profiles,
}

CORE: dict[str, Plan] = {
    "etl_dim_country": lambda wh: build_country_dim(wh.stg(STG_COUNTRY)),
    "etl_fct_health": lambda wh: C.fact_measures(wh, HEALTH_FACT),
    "etl_ci_health": lambda wh: C.fact_bounds(wh, HEALTH_FACT),
    "etl_fct_ncd": lambda wh: C.fact_measures(wh, NCD_FACT),
    "etl_ci_ncd": lambda wh: C.fact_bounds(wh, NCD_FACT),
    "etl_fct_comm": lambda wh: C.fact_measures(wh, COMM_FACT),
    "etl_ci_comm": lambda wh: C.fact_bounds(wh, COMM_FACT),
    "etl_verify_counts": C.loaded_counts,
    "etl_verify_indicator": lambda wh: C.loaded_by_category(wh, HEALTH_FACT),
    "etl_verify_cause": lambda wh: C.loaded_by_category(wh, NCD_FACT),
    "etl_verify_disease": lambda wh: C.loaded_by_category(wh, COMM_FACT),
    "etl_surrogate_key": C.surrogate_keys,
    "etl_reconcile": C.reconciliation,
    "etl_constraint_check": C.constraint_report,
    "etl_ci_key_match": C.loose_key_matches,
}

QUESTIONS: dict[str, Plan] = {
    plan.__name__: plan
    for plan in (
        A.q01_yearly_trend,
        A.q02_yoy_change,
        A.q03_top10,
        A.q04_top3_per_region,
        A.q05_gap_pivot,
        A.q06_indicator_pair,
        A.q07_region_improvement,
        A.q08_concentration,
        A.q09_dense_rank,
        A.q10_decliners,
        A.q11_cause_trend,
        A.q12_top_cause,
        A.q13_cause_share,
        A.q14_cross_fact,
        A.q15_disease_trend,
        A.q16_latest_top5,
        A.q17_union_share,
        A.q18_transition_ratio,
        A.q19_total_burden,
        A.q20_double_burden,
    )
}

OTHER: dict[str, Plan] = {
    "dq_control_chars": S.control_characters,
    "fn_ci_width": interval_widths,
    "fn_pct_of_global": A.region_vs_global,
    "tr_validate_rejects": Q.rule_rejects,
    "tr_validate_accepted": Q.rule_accepted,
}

PLANS: dict[str, Plan] = {
    **STAGING,
    **CORE,
    **VIEWS,
    **QUESTIONS,
    **Q.CHECKS,
    **OTHER,
    **REPORTS,
}
