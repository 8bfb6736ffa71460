"""Core load jobs: each step of staging -> dimensions and facts, and its verification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.operators.constraints import stacked, violations
from starhouse.operators.loading import (
    keyed_update,
    load_fact,
    match_ignoring_case,
    parsed,
    typed_staging,
    with_outcome,
)
from starhouse.operators.ordering import with_global_index
from starhouse.plans.refresh import COUNTRY_REQUIRED
from starhouse.plans.warehouse import Warehouse
from starhouse.schemas import FACTS, HEALTH_FACT, STG_COUNTRY, STG_HEALTH, FactSpec
from starhouse.functions.text import clean_text

BOUNDS = ["low_ci", "high_ci"]


def fact_measures(wh: Warehouse, spec: FactSpec) -> DataFrame:
    """Step one of a load: keys and measure only."""
    rows = load_fact(wh.stg(spec.staging), spec, wh.dims(), wh.profile)
    return rows.select(*spec.key, spec.measure)


def fact_bounds(wh: Warehouse, spec: FactSpec) -> DataFrame:
    """Step two: fill the bounds of already loaded rows from staging, by business key."""
    null_bound = F.lit(None).cast(spec.number_type)
    target = fact_measures(wh, spec).withColumns({c: null_bound for c in BOUNDS})
    updates = parsed(wh.stg(spec.staging), spec, wh.profile, with_bounds=True)
    return keyed_update(target, updates, spec.key, BOUNDS).select(*spec.key, *BOUNDS)


def loaded_counts(wh: Warehouse) -> DataFrame:
    return stacked(
        [
            wh.fact(s).agg(F.count("*").alias("n")).select(F.lit(s.name).alias("tbl"), "n")
            for s in FACTS
        ]
    )


def loaded_by_category(wh: Warehouse, spec: FactSpec) -> DataFrame:
    return wh.fact(spec).groupBy(spec.category).agg(F.count("*").alias("n"))


def surrogate_keys(wh: Warehouse) -> DataFrame:
    """Dense ids over the business key of the health fact, in load order."""
    rows = load_fact(wh.stg(STG_HEALTH), HEALTH_FACT, wh.dims(), wh.profile)
    keys = rows.select(*HEALTH_FACT.key)
    return with_global_index(keys, HEALTH_FACT.load_order, "fact_id").select("fact_id", *HEALTH_FACT.key)


OUTCOMES = [
    "loaded",
    "not_country",
    "bad_year",
    "bad_value",
    "unknown_country",
    "unknown_category",
    "unknown_sex",
    "rule_rejected",
    "missing_region",
    "repeated",
]


def reconciliation(wh: Warehouse) -> DataFrame:
    """Per table: rows staged, loaded and filtered out, with one count per reason."""

    def counts(df: DataFrame, table: str) -> DataFrame:
        return df.agg(
            F.count("*").alias("staged_rows"),
            *[F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES],
        ).select(
            F.lit(table).alias("table_name"),
            "staged_rows",
            F.col("loaded").alias("core_rows"),
            (F.col("staged_rows") - F.col("loaded")).alias("filtered_out"),
            *OUTCOMES[1:],
        )

    facts = [
        counts(with_outcome(wh.stg(s.staging), s, wh.dims(), wh.profile), s.name) for s in FACTS
    ]
    complete = (
        (clean_text(F.col("raw_country_code")) != "")
        & (clean_text(F.col("raw_region_code")) != "")
        & (clean_text(F.col("raw_region_name")) != "")
    )
    staged = wh.stg(STG_COUNTRY).agg(
        F.count("*").alias("staged_rows"), F.count_if(~complete).alias("missing_region")
    )
    loaded = wh.country().agg(F.count("*").alias("core_rows"))
    nothing = [F.lit(0).cast("bigint").alias(o) for o in OUTCOMES[1:-2]]
    # One row each. What is complete and not loaded repeats a row that is.
    countries = staged.crossJoin(loaded).select(
        F.lit("dim_country").alias("table_name"),
        "staged_rows",
        "core_rows",
        (F.col("staged_rows") - F.col("core_rows")).alias("filtered_out"),
        *nothing,
        "missing_region",
        (F.col("staged_rows") - F.col("missing_region") - F.col("core_rows")).alias("repeated"),
    )
    return stacked([*facts, countries])


def constraint_report(wh: Warehouse) -> DataFrame:
    """Violations before the load filters (typed staging) and after them (core)."""
    staged_country = wh.stg(STG_COUNTRY).select(
        *[
            F.nullif(clean_text(F.col(f"raw_{c}")), F.lit("")).alias(c)
            for c in COUNTRY_REQUIRED
        ]
    )
    before = [violations(staged_country, STG_COUNTRY, COUNTRY_REQUIRED, ["country_code"])]
    after = [violations(wh.country(), "dim_country", COUNTRY_REQUIRED, ["country_code"])]
    for spec in FACTS:
        required = spec.key + [spec.measure]
        before.append(
            violations(typed_staging(wh.stg(spec.staging), spec), spec.staging, required, spec.key)
        )
        after.append(violations(wh.fact(spec), spec.name, required, spec.key))
    return stacked([*before, *after])


def loose_key_matches(wh: Warehouse) -> DataFrame:
    """Staged indicator codes, respelled in lower case with a trailing space, matched
    to the dimension ignoring case, accents and trailing spaces; rows per indicator."""
    staged = (
        wh.stg(STG_HEALTH)
        .select(F.concat(F.lower("raw_indicator_code"), F.lit(" ")).alias("staged_code"))
        .groupBy("staged_code")
        .agg(F.count("*").alias("n_staged"))
    )
    dim = wh.dim("dim_indicator").select("indicator_code")
    return match_ignoring_case(staged, dim, "staged_code", "indicator_code").select(
        "indicator_code", "staged_code", "n_staged"
    )
