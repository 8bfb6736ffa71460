"""Static dimensions from inline rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starhouse.profile import Profile

_COLUMNS = {
    "dim_sex": ("sex_code", "sex_name"),
    "dim_indicator": ("indicator_code", "indicator_name", "unit"),
    "dim_cause": ("cause_code", "cause_name"),
    "dim_disease": ("disease_code", "disease_name", "disease_type"),
}


def _rows(profile: Profile, name: str) -> tuple[tuple[str, ...], ...]:
    return {
        "dim_sex": profile.sexes,
        "dim_indicator": profile.indicators,
        "dim_cause": profile.causes,
        "dim_disease": profile.diseases,
    }[name]


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def static_dim(spark: SparkSession, profile: Profile, name: str) -> DataFrame:
    """A VALUES relation: its size is known to the optimizer and is a handful of rows."""
    rows = ", ".join("(" + ", ".join(map(_quoted, row)) + ")" for row in _rows(profile, name))
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({', '.join(_COLUMNS[name])})")
