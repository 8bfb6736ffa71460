"""Row rules a health estimate has to meet before it is stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.profile import Profile
from starhouse.schemas import HEALTH_FACT, FactSpec

NEGATIVE_VALUE = "negative_value"
YEAR_OUT_OF_RANGE = "year_out_of_range"


def rules(spec: FactSpec, profile: Profile) -> list[tuple[str, Column]]:
    """(reason, violation) pairs in order of precedence; only health facts are guarded."""
    if spec is not HEALTH_FACT:
        return []
    negative = F.col(spec.category).isin(*profile.non_negative) & (F.col(spec.measure) < 0)
    outside = ~F.col("year_val").between(profile.first_year, profile.last_year)
    return [(NEGATIVE_VALUE, negative), (YEAR_OUT_OF_RANGE, outside)]


def first_violation(spec: FactSpec, profile: Profile) -> Column:
    """The reason of the first broken rule, null for a valid row."""
    reason = F.lit(None).cast("string")
    for name, broken in reversed(rules(spec, profile)):
        reason = F.when(broken, name).otherwise(reason)
    return reason


def split(rows: DataFrame, spec: FactSpec, profile: Profile) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects with ``reason``): together exactly the input rows."""
    judged = rows.withColumn("reason", first_violation(spec, profile))
    accepted = judged.filter(F.col("reason").isNull()).drop("reason")
    return accepted, judged.filter(F.col("reason").isNotNull())


def strict(rows: DataFrame, spec: FactSpec, profile: Profile) -> DataFrame:
    """The same rows, but the job fails on the first one that breaks a rule.

    The check guards the measure column rather than a filter, so it cannot be
    optimized away while the measure is used.
    """
    reason = first_violation(spec, profile)
    message = F.concat(F.lit(f"{spec.name}: "), reason)
    guarded = F.when(reason.isNotNull(), F.raise_error(message)).otherwise(F.col(spec.measure))
    return rows.withColumn(spec.measure, guarded.cast(spec.number_type))
