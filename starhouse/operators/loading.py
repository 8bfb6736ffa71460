"""Staging text into typed facts: parse, filter by reference, explain what was dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starhouse.functions.text import clean_text, is_number, is_year, to_number, to_year
from starhouse.operators.rules import first_violation, rules
from starhouse.profile import Profile
from starhouse.schemas import FactSpec, staging_columns

# Column of the spatial level in typed staging.
LEVEL = "spatial_dim_type"
# Names a staged record by its content.
RECORD_ID = "record_id"


def record(spec: FactSpec) -> Column:
    """All staged columns of a record as they were read."""
    return F.struct(*staging_columns(spec.staging))


def record_id(spec: FactSpec, kept: Column | None = None) -> Column:
    """A digest of :func:`record`, or of a column that kept it, null and '' told apart.

    It is the same whichever file, order or attempt of a task the record comes from; records
    that are equal throughout share it.
    """
    text = F.to_json(record(spec) if kept is None else kept, {"ignoreNullFields": "false"})
    return F.unhex(F.md5(text))


def _clean_columns(stg: DataFrame, spec: FactSpec, keep: Sequence[str] = ()) -> DataFrame:
    raw = [spec.raw_category, "raw_country_code", "raw_spatial_dim_type", "raw_year"]
    raw += ["raw_numeric_value", "raw_low", "raw_high"] + (["raw_sex_code"] if spec.has_sex else [])
    return stg.select(*[clean_text(F.col(c)).alias(c) for c in raw], *keep)


def _typed_columns(text: DataFrame, spec: FactSpec, tested: bool = False, keep: Sequence[str] = ()) -> DataFrame:
    """Typed columns of cleaned text; what does not parse is null.

    With ``tested`` the year and value are known to be well-formed and are only
    cast. Cleaning, parsing and pairing are separate projections, so no text is
    cleaned or parsed repeatedly.
    """

    def number(column: str, name: str) -> Column:
        return to_number(F.col(column), spec.number_type).alias(name)

    year, value = F.col("raw_year"), F.col("raw_numeric_value")

    values = text.select(
        F.col(spec.raw_category).alias(spec.category),
        F.col("raw_country_code").alias("country_code"),
        (year.try_cast("smallint") if tested else to_year(year)).alias("year_val"),
        *([F.col("raw_sex_code").alias("sex_code")] if spec.has_sex else []),
        (value.try_cast(spec.number_type) if tested else to_number(value, spec.number_type)).alias(
            spec.measure
        ),
        number("raw_low", "low_ci"),
        number("raw_high", "high_ci"),
        F.col("raw_spatial_dim_type").alias(LEVEL),
        *keep,
    )
    paired = F.col("low_ci").isNotNull() & F.col("high_ci").isNotNull()
    return values.withColumns(
        {bound: F.when(paired, F.col(bound)) for bound in ("low_ci", "high_ci")}
    )


def typed_staging(stg: DataFrame, spec: FactSpec) -> DataFrame:
    """Every staged row with typed columns; blank codes and what does not parse are null.

    Bounds count only as a pair: if either is missing or unreadable both are null.
    """
    typed = _typed_columns(_clean_columns(stg, spec), spec)
    codes = [k for k in spec.key if k != "year_val"]
    return typed.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in codes})


def parsed(
    stg: DataFrame,
    spec: FactSpec,
    profile: Profile,
    with_bounds: bool = False,
    seen: Observation | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed country-level rows whose year and value parse, optionally both bounds too.

    The tests are on text, before typing: Spark moves filters below projections
    and would otherwise repeat the typing inside them, up to generated code too
    large for the JVM to compile. ``seen`` counts the country-level rows (n_rows) as they pass;
    ``keep`` names columns of ``stg`` that are kept as they are.
    """
    text = _clean_columns(stg, spec, keep).filter(F.col("raw_spatial_dim_type") == profile.country_level)
    if seen is not None:
        text = text.observe(seen, F.count("*").alias("n_rows"))
    text = text.filter(is_year(F.col("raw_year")) & is_number(F.col("raw_numeric_value")))
    if with_bounds:
        text = text.filter(is_number(F.col("raw_low")) & is_number(F.col("raw_high")))
    # A number can be well-formed and still too large for the column.
    typed = _typed_columns(text, spec, tested=True, keep=keep)
    return typed.filter(F.col(spec.measure).isNotNull()).drop(LEVEL)


def _small_dims(spec: FactSpec) -> list[tuple[str, str]]:
    """(dimension, key) of the static dimensions: literal tables of a few rows."""
    return [(spec.category_dim, spec.category)] + ([("dim_sex", "sex_code")] if spec.has_sex else [])


def referenced(rows: DataFrame, spec: FactSpec, dims: dict[str, DataFrame]) -> DataFrame:
    """Keep rows whose keys exist in every dimension (semi joins: no dim column is read).

    The static dims are broadcast, being literals; the country dimension grows with
    the data, so Spark picks its join by measured size.
    """
    for dim, key in _small_dims(spec):
        rows = rows.join(F.broadcast(dims[dim].select(key)), key, "left_semi")
    return rows.join(dims["dim_country"].select("country_code"), "country_code", "left_semi")


def load_fact(
    stg: DataFrame, spec: FactSpec, dims: dict[str, DataFrame], profile: Profile
) -> DataFrame:
    """One pass from staging to fact rows, bounds included, rule violations left out."""
    rows = referenced(parsed(stg, spec, profile), spec, dims)
    for _, broken in rules(spec, profile):
        rows = rows.filter(~broken)
    return rows.select(*spec.columns)


def with_outcome(
    stg: DataFrame, spec: FactSpec, dims: dict[str, DataFrame], profile: Profile
) -> DataFrame:
    """Every staged row with the first reason it is not loaded, or 'loaded'."""
    rows = typed_staging(stg, spec)
    checks: list[tuple[Column, str]] = [
        (F.col(LEVEL) != profile.country_level, "not_country"),
        (F.col("year_val").isNull(), "bad_year"),
        (F.col(spec.measure).isNull(), "bad_value"),
    ]
    countries = dims["dim_country"].select("country_code", F.lit(True).alias("_country"))
    rows = rows.join(countries, "country_code", "left")
    checks.append((F.col("_country").isNull(), "unknown_country"))
    for dim, key in _small_dims(spec):
        known = dims[dim].select(key, F.lit(True).alias(f"_{dim}"))
        rows = rows.join(F.broadcast(known), key, "left")
        reason = "unknown_sex" if dim == "dim_sex" else "unknown_category"
        checks.append((F.col(f"_{dim}").isNull(), reason))
    checks.append((first_violation(spec, profile).isNotNull(), "rule_rejected"))
    outcome = F.lit("loaded")
    for failed, reason in reversed(checks):
        outcome = F.when(failed, reason).otherwise(outcome)
    return rows.select(*spec.columns, outcome.alias("outcome"))


def build_country_dim(stg: DataFrame) -> DataFrame:
    """Countries with a code and a region; text cleaned before it is compared."""
    cleaned = stg.select(
        clean_text(F.col("raw_country_code")).alias("country_code"),
        clean_text(F.col("raw_country_name")).alias("country_name"),
        clean_text(F.col("raw_region_code")).alias("region_code"),
        clean_text(F.col("raw_region_name")).alias("region_name"),
    )
    complete = (
        (F.col("country_code") != "") & (F.col("region_code") != "") & (F.col("region_name") != "")
    )
    return cleaned.filter(complete).distinct()


def keyed_update(
    target: DataFrame, updates: DataFrame, key: list[str], columns: list[str]
) -> DataFrame:
    """Overwrite ``columns`` of target rows that have a match in ``updates``.

    Repeated keys in ``updates`` are reduced to the smallest (columns) tuple first,
    by an aggregate that combines before the shuffle, so a match never fans out.
    """
    patch = updates.groupBy(*key).agg(F.min(F.struct(*columns)).alias("_patch"))
    keep = [c for c in target.columns if c not in columns]
    joined = target.join(patch, key, "left")
    matched = F.col("_patch").isNotNull()
    return joined.select(
        *keep,
        *[
            F.when(matched, F.col(f"_patch.{c}")).otherwise(target[c]).alias(c)
            for c in columns
        ],
    )


def match_ignoring_case(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner join under a case-, accent- and trailing-space-insensitive comparison."""
    loose = "UNICODE_CI_AI_RTRIM"
    return left.join(right, F.collate(left[left_key], loose) == F.collate(right[right_key], loose))
