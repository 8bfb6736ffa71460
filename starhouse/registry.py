"""Every job by key, run on the order tables.

A key maps to ``(spark, sf_dir) -> DataFrame``. The order tables are staged into
the model of ``starhouse.schemas`` once per session and directory; jobs then read
staging and core tables from there.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starhouse.functions.measures import register_sql_functions, safe_pct
from starhouse.functions.text import clean_text
from starhouse.operators.constraints import stacked
from starhouse.plans import quality, staging_reports, states
from starhouse.plans.catalog import PLANS
from starhouse.plans.landing import COUNTRY_PULL, NCD_PULL, REGION_PULL, REGIONS_FILE, land_pages, write_pages
from starhouse.plans.refresh import changes, publish_repaired, refresh_core
from starhouse.plans.views import publish_views
from starhouse.plans.warehouse import DerivedWarehouse, PublishedWarehouse, Warehouse
from starhouse.profile import RETAIL
from starhouse.schemas import (
    CSV_COLUMNS,
    CSV_FILES,
    FACTS,
    HEALTH_FACT,
    NCD_FACT,
    STATIC_DIMS,
    STG_COMM,
    STG_COUNTRY,
    STG_HEALTH,
    STG_NCD,
)
from starhouse.scratch import scratch_path
from starhouse.sinks.files import write_csv
from starhouse.sources.csv_text import csv_rejects, read_text_csv
from starhouse.sources.json_pages import (
    COMM_RECORD,
    COUNTRY_RECORD,
    HEALTH_RECORD,
    NCD_RECORD,
    REGION_RECORD,
    read_pages,
    union_pulls,
)
from starhouse.sources.order_tables import read_table, stage

Job = Callable[[SparkSession, str], DataFrame]

_warehouses: dict[tuple, Warehouse] = {}
_lock = threading.Lock()


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The tables of a folder, staged once a session; call :func:`reload` when they have changed."""
    key = (spark.sparkContext.applicationId, sf_dir)
    with _lock:
        if key not in _warehouses:
            _warehouses[key] = DerivedWarehouse(spark, RETAIL, lambda table: stage(spark, sf_dir, table))
        return _warehouses[key]


def reload(spark: SparkSession, sf_dir: str) -> None:
    """Forget what was staged from a folder."""
    with _lock:
        _warehouses.pop((spark.sparkContext.applicationId, sf_dir), None)


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and small integers as ints, so results compare across engines."""
    casts = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.ShortType):
            col = col.cast("int")
        casts.append(col.alias(field.name))
    return df.select(*casts)


def _job(plan: Callable[[Warehouse], DataFrame]) -> Job:
    return lambda spark, sf_dir: portable(plan(warehouse(spark, sf_dir)))


# --- sources and sinks -------------------------------------------------------


def _land_csv(wh: Warehouse, table: str) -> str:
    """Write a staging table as a CRLF file set; returns its folder.

    Carriage returns inside values are dropped: here they belong to the line ends.
    """
    path = scratch_path(wh.spark, CSV_FILES[table])
    columns = CSV_COLUMNS[table]
    plain = wh.stg(table).select(
        *[F.translate(F.col(staged), "\r", "").alias(staged) for _, staged in columns]
    )
    write_csv(plain, path, [(staged, header) for header, staged in columns])
    return path


def src_csv_staging(wh: Warehouse) -> DataFrame:
    """All four tables exported as CSV and imported again as text, one record per row."""
    return stacked(
        [
            staging_reports.as_records(read_text_csv(wh.spark, _land_csv(wh, t), t), t)
            for t in staging_reports.TABLES
        ]
    )


def src_lineage(wh: Warehouse) -> DataFrame:
    """For each staging table read from CSV: the files its rows name, and rows with a time of reading.

    The file name is reduced to its first word and its extension, since Spark names the files.
    """
    frames = []
    for table in staging_reports.TABLES:
        rows = read_text_csv(wh.spark, _land_csv(wh, table), table)
        name = F.regexp_extract("source_file", r"^([a-z]+)-.*\.([a-z]+)$", 1).alias("file_stem")
        kind = F.regexp_extract("source_file", r"^([a-z]+)-.*\.([a-z]+)$", 2).alias("file_type")
        frames.append(
            rows.groupBy(name, kind)
            .agg(F.count("*").alias("n_rows"), F.count("ingested_at").alias("n_timed"))
            .select(F.lit(table).alias("table_name"), "file_stem", "file_type", "n_rows", "n_timed")
        )
    return stacked(frames)


def src_rejects(wh: Warehouse) -> DataFrame:
    """Country rows written with a field too many or too few: what the reader accepts and refuses."""
    path = scratch_path(wh.spark, "damaged")
    fields = [F.translate(F.col(staged), "\r", "") for _, staged in CSV_COLUMNS[STG_COUNTRY]]
    code = F.col("raw_country_code").cast("int") % 7
    line = F.when(code == 1, F.concat_ws(",", *fields, F.lit("more"))).when(code == 2, F.concat_ws(",", *fields[:3]))
    header = ",".join(header for header, _ in CSV_COLUMNS[STG_COUNTRY])
    damaged = wh.stg(STG_COUNTRY).select(line.otherwise(F.concat_ws(",", *fields)).alias(header))
    damaged.write.option("header", True).option("sep", "\u0001").option("quote", "").csv(path)
    accepted = read_text_csv(wh.spark, path, STG_COUNTRY, accept_rejects=True).select(F.lit("accepted").alias("reason"))
    commas = F.size(F.split("record", ","))
    refused = csv_rejects(wh.spark, path, STG_COUNTRY).select(
        F.when(commas > len(fields), "field too many").otherwise("field too few").alias("reason")
    )
    return accepted.unionByName(refused).groupBy("reason").agg(F.count("*").alias("n_rows"))


def _through_pages(
    df: DataFrame, fields: dict[str, str], label: str, constants: dict[str, str] | None = None
) -> DataFrame:
    """Records written as JSON pages and read back."""
    path = scratch_path(df.sparkSession, label)
    write_pages(df, fields, path)
    return read_pages(df.sparkSession, path, fields, constants)


def _as_landed(wh: Warehouse, table: str) -> DataFrame:
    """Staging under the file's column names, blanks as nulls (absent keys in JSON)."""
    return wh.stg(table).select(
        *[F.nullif(F.col(staged), F.lit("")).alias(header) for header, staged in CSV_COLUMNS[table]]
    )


def _as_text(df: DataFrame, kind: str) -> DataFrame:
    return df.select(F.lit(kind).alias("kind"), F.concat_ws("|", *df.columns).alias("record"))


def _regions(wh: Warehouse) -> DataFrame:
    countries = _as_landed(wh, STG_COUNTRY)
    return (
        countries.filter(F.col("parent_code").isNotNull())
        .select(F.col("parent_code").alias("region_code"), F.col("parent_title").alias("region_name"))
        .distinct()
    )


def _health_pulls(wh: Warehouse) -> dict[str, DataFrame]:
    landed = _as_landed(wh, STG_HEALTH)
    return {code: landed.filter(F.col("indicator_code") == code) for code, *_ in wh.profile.indicators}


def _comm_pulls(wh: Warehouse) -> dict[str, DataFrame]:
    landed = _as_landed(wh, STG_COMM)
    return {code: landed.filter(F.col("indicator_code") == code) for code, *_ in wh.profile.diseases}


def _communicable_pages(wh: Warehouse) -> DataFrame:
    """A pull for each disease; its name is not in the pages."""
    names = {code: name for code, name, _ in wh.profile.diseases}
    return union_pulls(
        [
            _through_pages(pull, COMM_RECORD, f"pull-{code}", {"disease_name": names[code]})
            for code, pull in _comm_pulls(wh).items()
        ]
    )


def src_json_pages(wh: Warehouse) -> DataFrame:
    """Health, NCD, communicable, country and region records read back from JSON pages."""
    countries = _as_landed(wh, STG_COUNTRY)
    return stacked(
        [
            _as_text(_through_pages(_as_landed(wh, STG_HEALTH), HEALTH_RECORD, "health"), "health"),
            _as_text(_through_pages(_as_landed(wh, STG_NCD), NCD_RECORD, "ncd"), "ncd"),
            _as_text(_communicable_pages(wh), "communicable"),
            _as_text(_through_pages(countries, COUNTRY_RECORD, "country"), "country"),
            _as_text(_through_pages(_regions(wh), REGION_RECORD, "region"), "region"),
        ]
    )


def src_multi_indicator(wh: Warehouse) -> DataFrame:
    """One landed pull per indicator and one per disease, combined into a dataset of each kind."""
    health = [_through_pages(pull, HEALTH_RECORD, f"pull-{code}") for code, pull in _health_pulls(wh).items()]
    return stacked([_as_text(union_pulls(health), "health"), _as_text(_communicable_pages(wh), "communicable")])


def src_static_dims(wh: Warehouse) -> DataFrame:
    """Static members with the number of staged rows that use each of them."""
    uses = {
        "dim_sex": (STG_HEALTH, "raw_sex_code"),
        "dim_indicator": (STG_HEALTH, "raw_indicator_code"),
        "dim_cause": (STG_NCD, "raw_cause_code"),
        "dim_disease": (STG_COMM, "raw_indicator_code"),
    }
    frames = []
    for name in STATIC_DIMS:
        dim = wh.dim(name)
        code, label = dim.columns[:2]
        table, column = uses[name]
        used = (
            wh.stg(table)
            .groupBy(clean_text(F.col(column)).alias(code))
            .agg(F.count("*").alias("_n"))
        )
        frames.append(
            dim.join(used, code, "left").select(
                F.lit(name).alias("dim_name"),
                F.col(code).alias("code"),
                F.col(label).alias("label"),
                F.coalesce("_n", F.lit(0)).alias("n_staged"),
            )
        )
    return stacked(frames)


_publishing = threading.Lock()


def _published(wh: Warehouse) -> PublishedWarehouse:
    """The core of a warehouse, published once a session; later versions do not change what it reads."""
    with _publishing:
        if not hasattr(wh, "published"):
            root = scratch_path(wh.spark, "published")
            refresh_core(wh.spark, wh.profile, wh.stg, root)
            wh.published = PublishedWarehouse(wh.spark, wh.profile, root)
        return wh.published


def snk_core_roundtrip(wh: Warehouse) -> DataFrame:
    """Write the core, read the published version back: rows and totals per table and year."""
    published = _published(wh)
    frames = [
        published.fact(spec)
        .groupBy("year_val")
        .agg(F.count("*").alias("n_rows"), F.sum(spec.measure).cast("decimal(28,6)").alias("total"))
        .select(F.lit(spec.name).alias("table_name"), "year_val", "n_rows", "total")
        for spec in FACTS
    ]
    frames += [
        published.dim(name)
        .agg(F.count("*").alias("n_rows"))
        .select(
            F.lit(name).alias("table_name"),
            F.lit(None).cast("smallint").alias("year_val"),
            "n_rows",
            F.lit(None).cast("decimal(28,6)").alias("total"),
        )
        for name in (*STATIC_DIMS, "dim_country")
    ]
    return stacked(frames)


def snk_csv_roundtrip(wh: Warehouse) -> DataFrame:
    """Pages of every pull landed as the five CSV files, and all of them read back."""
    pages, landed = scratch_path(wh.spark, "pulls"), scratch_path(wh.spark, "landed")
    for code, pull in _health_pulls(wh).items():
        write_pages(pull, HEALTH_RECORD, f"{pages}/{code}")
    for code, pull in _comm_pulls(wh).items():
        write_pages(pull, COMM_RECORD, f"{pages}/{code}")
    write_pages(_as_landed(wh, STG_NCD), NCD_RECORD, f"{pages}/{NCD_PULL}")
    write_pages(_as_landed(wh, STG_COUNTRY), COUNTRY_RECORD, f"{pages}/{COUNTRY_PULL}")
    write_pages(_regions(wh), REGION_RECORD, f"{pages}/{REGION_PULL}")
    land_pages(wh.spark, wh.profile, pages, landed, one_page_per_file=False)

    def records(file: str, rows: DataFrame) -> DataFrame:
        # A carriage return inside a value belongs to it; the answer leaves it out on both sides.
        text = F.translate(F.concat_ws("|", *rows.columns), "\r", "")
        return rows.select(F.lit(file).alias("file_name"), text.alias("record"))

    frames = [
        records(CSV_FILES[t], read_text_csv(wh.spark, f"{landed}/{CSV_FILES[t]}", t, line_sep="\r\n").drop("source_file", "ingested_at"))
        for t in staging_reports.TABLES
    ]
    schema = ", ".join(f"{c} STRING" for c in REGION_RECORD)
    reader = wh.spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    regions = reader.option("lineSep", "\r\n").csv(f"{landed}/{REGIONS_FILE}")
    return stacked([*frames, records(REGIONS_FILE, regions)])


def snk_views_by_name(wh: Warehouse) -> DataFrame:
    """Rows of each published view, read by its name as a SQL user would."""
    published = _published(wh)
    names = publish_views(published)
    return stacked(
        [wh.spark.table(name).agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("view_name"), "n_rows") for name in names]
    )


def _repaired(wh: Warehouse) -> PublishedWarehouse:
    """The next version of it, with inverted bounds swapped."""
    published = _published(wh)
    with _publishing:
        if not hasattr(wh, "repaired"):
            wh.repaired = publish_repaired(wh.spark, wh.profile, published.root)
        return wh.repaired


def snk_change_set(wh: Warehouse) -> DataFrame:
    """Rows of the health fact that the repair changed, with their bounds in both versions."""
    found = changes(_published(wh), _repaired(wh), HEALTH_FACT)
    return found.select("change", *HEALTH_FACT.key, "old_low_ci", "old_high_ci", "new_low_ci", "new_high_ci")


def _states(wh: Warehouse) -> states.KpiStates:
    """The KPI states of the published version, computed once a session."""
    published = _published(wh)
    with _publishing:
        if not hasattr(wh, "states"):
            wh.states = states.KpiStates(published)
            wh.states.frame(HEALTH_FACT), wh.states.frame(NCD_FACT)
        return wh.states


def refresh_summary(wh: Warehouse) -> DataFrame:
    """A refresh of its own from nothing, and what it loaded."""
    return refresh_core(wh.spark, wh.profile, wh.stg, scratch_path(wh.spark, "refresh"), verbose=True)


# --- functions ---------------------------------------------------------------


def _decimal(name: str) -> Column:
    return F.col(name).cast("decimal(18,6)")


def fn_safe_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tax as a percentage of discount over all order lines; zero discounts give null."""
    register_sql_functions(spark)
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", _decimal("l_tax").alias("num"), _decimal("l_discount").alias("den")
    )
    both = lines.select(
        "l_returnflag",
        "l_linestatus",
        F.expr("fn_safe_pct(num, den)").alias("pct"),
        safe_pct(F.col("num"), F.col("den")).alias("pct_column"),
    )
    return portable(
        both.groupBy("l_returnflag", "l_linestatus").agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.col("pct").isNull()).alias("n_null"),
            F.count_if(~F.col("pct").eqNullSafe(F.col("pct_column"))).alias("n_differ"),
            F.min("pct").alias("min_pct"),
            F.max("pct").alias("max_pct"),
            F.sum("pct").alias("sum_pct"),
        )
    )


def fn_smoke(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The functions' special cases over all order lines: which inputs give null."""
    register_sql_functions(spark)
    tax, discount = F.col("tax"), F.col("discount")
    lines = (
        read_table(spark, sf_dir, "lineitem")
        .select(_decimal("l_tax").alias("tax"), _decimal("l_discount").alias("discount"))
        .select(F.nullif(tax, F.lit(0).cast("decimal(18,6)")).alias("num"), discount.alias("den"))
    )
    case = (
        F.when(F.col("den") == 0, "zero denominator")
        .when(F.col("num").isNull(), "null numerator")
        .otherwise("normal")
    )
    return portable(
        lines.select(
            case.alias("case_name"),
            F.expr("fn_safe_pct(num, den)").alias("pct"),
            F.expr("fn_ci_width(num, den)").alias("width"),
        )
        .groupBy("case_name")
        .agg(
            F.count("*").alias("n_rows"),
            F.count_if(F.col("pct").isNull()).alias("n_null_pct"),
            F.count_if(F.col("width").isNull()).alias("n_null_width"),
            F.sum("pct").alias("sum_pct"),
            F.sum("width").alias("sum_width"),
        )
    )


# --- registry ----------------------------------------------------------------


def _source_jobs() -> dict[str, Job]:
    plans = (
        src_csv_staging,
        src_lineage,
        src_rejects,
        src_json_pages,
        src_multi_indicator,
        src_static_dims,
        snk_core_roundtrip,
        snk_csv_roundtrip,
        snk_views_by_name,
    )
    jobs = {plan.__name__: _job(plan) for plan in plans}
    return {**jobs, "refresh_core": _job(refresh_summary)}


def jobs() -> dict[str, Job]:
    return {
        **_source_jobs(),
        **{name: _job(plan) for name, plan in PLANS.items()},
        # The repair is published, and checked on what readers then see.
        "dq_repair_inverted": _job(lambda wh: quality.published_bounds(_repaired(wh))),
        "snk_change_set": _job(snk_change_set),
        "vw_yearly_kpi_merged": _job(lambda wh: states.yearly_kpi(_states(wh))),
        "vw_region_yearly_kpi_merged": _job(lambda wh: states.region_yearly_kpi(_states(wh))),
        "vw_yearly_deaths_merged": _job(lambda wh: states.yearly_deaths_by_cause(_states(wh))),
        "vw_sketch_check": _job(lambda wh: states.sketch_check(_states(wh))),
        "dq_repair_verify": _job(lambda wh: quality.remaining_inverted(_repaired(wh))),
        "fn_safe_pct": fn_safe_pct,
        "fn_smoke": fn_smoke,
    }
