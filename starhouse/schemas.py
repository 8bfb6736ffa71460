"""Staging and core table definitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

STG_HEALTH = "stg_health_estimates_raw"
STG_NCD = "stg_ncd_deaths_raw"
STG_COMM = "stg_communicable_deaths_raw"
STG_COUNTRY = "stg_countries_raw"

# Column order of the landed files, and the staging name of each column.
CSV_COLUMNS: dict[str, tuple[tuple[str, str], ...]] = {
    STG_HEALTH: (
        ("indicator_code", "raw_indicator_code"),
        ("country_code", "raw_country_code"),
        ("spatial_dim_type", "raw_spatial_dim_type"),
        ("year", "raw_year"),
        ("sex_code", "raw_sex_code"),
        ("numeric_value", "raw_numeric_value"),
        ("low", "raw_low"),
        ("high", "raw_high"),
    ),
    STG_NCD: (
        ("indicator_code", "raw_indicator_code"),
        ("country_code", "raw_country_code"),
        ("spatial_dim_type", "raw_spatial_dim_type"),
        ("year", "raw_year"),
        ("sex_code", "raw_sex_code"),
        ("cause_code", "raw_cause_code"),
        ("numeric_value", "raw_numeric_value"),
        ("low", "raw_low"),
        ("high", "raw_high"),
    ),
    STG_COMM: (
        ("indicator_code", "raw_indicator_code"),
        ("disease_name", "raw_disease_name"),
        ("country_code", "raw_country_code"),
        ("spatial_dim_type", "raw_spatial_dim_type"),
        ("year", "raw_year"),
        ("numeric_value", "raw_numeric_value"),
        ("low", "raw_low"),
        ("high", "raw_high"),
    ),
    STG_COUNTRY: (
        ("country_code", "raw_country_code"),
        ("country_name", "raw_country_name"),
        ("parent_code", "raw_region_code"),
        ("parent_title", "raw_region_name"),
    ),
}

CSV_FILES = {
    STG_HEALTH: "health_estimates_raw.csv",
    STG_NCD: "ncd_deaths_raw.csv",
    STG_COMM: "communicable_deaths_raw.csv",
    STG_COUNTRY: "countries.csv",
}


def staging_columns(table: str) -> list[str]:
    return [staged for _, staged in CSV_COLUMNS[table]]


def csv_schema(table: str) -> T.StructType:
    """All-text schema in file order, under the file's own column names."""
    return T.StructType([T.StructField(name, T.StringType()) for name, _ in CSV_COLUMNS[table]])


def staging_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in staging_columns(table)])


@dataclass(frozen=True)
class FactSpec:
    """How one staging table becomes one fact table."""

    name: str
    staging: str
    category: str
    raw_category: str
    category_dim: str
    measure: str
    number_type: str
    has_sex: bool = True

    @property
    def key(self) -> list[str]:
        """Business key in reading order."""
        return [self.category, "country_code", "year_val"] + (["sex_code"] if self.has_sex else [])

    @property
    def load_order(self) -> list[str]:
        """Order of surrogate ids; year first so files line up with the year folders."""
        return ["year_val", self.category, "country_code"] + (["sex_code"] if self.has_sex else [])

    @property
    def columns(self) -> list[str]:
        return self.key + [self.measure, "low_ci", "high_ci"]

    @property
    def typed_schema(self) -> str:
        """Columns of a typed staging row, before ids."""
        types = {self.measure: self.number_type, "low_ci": self.number_type, "high_ci": self.number_type, "year_val": "SMALLINT"}
        return ", ".join(f"{c} {types.get(c, 'STRING')}" for c in self.columns)

    @property
    def schema(self) -> str:
        sex = "sex_code STRING, " if self.has_sex else ""
        return (
            f"fact_id BIGINT, {self.category} STRING, country_code STRING, {sex}"
            f"{self.measure} {self.number_type}, low_ci {self.number_type}, "
            f"high_ci {self.number_type}, created_at TIMESTAMP, year_val SMALLINT"
        )


HEALTH_FACT = FactSpec(
    name="fct_health_estimate",
    staging=STG_HEALTH,
    category="indicator_code",
    raw_category="raw_indicator_code",
    category_dim="dim_indicator",
    measure="metric_value",
    number_type="DECIMAL(18,6)",
)
NCD_FACT = FactSpec(
    name="fct_ncd_deaths",
    staging=STG_NCD,
    category="cause_code",
    raw_category="raw_cause_code",
    category_dim="dim_cause",
    measure="death_count",
    number_type="DECIMAL(18,2)",
)
COMM_FACT = FactSpec(
    name="fct_communicable_deaths",
    staging=STG_COMM,
    category="disease_code",
    raw_category="raw_indicator_code",
    category_dim="dim_disease",
    measure="death_count",
    number_type="DECIMAL(18,2)",
    has_sex=False,
)
FACTS = (HEALTH_FACT, NCD_FACT, COMM_FACT)

COUNTRY_SCHEMA = "country_code STRING, country_name STRING, region_code STRING, region_name STRING"
STATIC_DIMS = ("dim_sex", "dim_indicator", "dim_cause", "dim_disease")
