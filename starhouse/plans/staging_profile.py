"""Everything the staging reports count, from one pass over each table.

Rows, codes of every profiled column, the textual range of years and the parse checks come from one
aggregation over grouping sets: a set for each column and one for the whole table. Cleaning and
parsing happen once a row, below the sets, and a set combines before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.operators.constraints import stacked
from starhouse.plans import staging_reports as S
from starhouse.plans.warehouse import Warehouse
from starhouse.schemas import STG_COMM, STG_COUNTRY, STG_HEALTH, STG_NCD

#: Columns whose values are counted.
COLUMNS: dict[str, list[str]] = {
    STG_HEALTH: ["raw_spatial_dim_type", "raw_indicator_code", "raw_sex_code"],
    STG_NCD: ["raw_cause_code"],
    STG_COMM: ["raw_disease_name"],
    STG_COUNTRY: [],
}
CHECKS: dict[str, Callable[[], dict[str, Column]]] = {
    STG_HEALTH: S.health_checks,
    STG_NCD: S.ncd_checks,
    STG_COMM: S.comm_checks,
    STG_COUNTRY: dict,
}
SCHEMA = "table_name STRING, measure STRING, value STRING, n BIGINT"


def profile(wh: Warehouse, table: str) -> DataFrame:
    """A staging table as (table_name, measure, value, n).

    Measures are ``rows``, each parse check, ``min_year`` and ``max_year`` (as text, without n), and
    for each value of a profiled column, null among them, the column's name.
    """
    columns, checks = COLUMNS[table], CHECKS[table]()
    dated = table != STG_COUNTRY
    year = F.col("raw_year") if dated else F.lit(None).cast("string")
    flags = [check.alias(name) for name, check in checks.items()]
    rows = wh.stg(table).select(*columns, year.alias("_year"), *flags)
    counts = [
        F.count("*").alias("n"),
        F.min("_year").alias("min_year"),
        F.max("_year").alias("max_year"),
        *[F.count_if(name).alias(name) for name in checks],
    ]
    if columns:
        sets = [[F.col(c)] for c in columns] + [[]]
        found = rows.groupingSets(sets, *columns).agg(F.grouping_id(*columns).alias("_set"), *counts)
        # Of an empty table the sets give no row at all, not even the one for the whole table.
        none = [F.lit(None).cast("string").alias(c) for c in (*columns, "min_year", "max_year")]
        zeros = [F.lit(0).cast("bigint").alias(c) for c in ("n", *checks)]
        empty = wh.spark.range(1).select(F.lit(2 ** len(columns) - 1).cast("bigint").alias("_set"), *none, *zeros)
        sums = [F.sum(c).alias(c) for c in ("n", *checks)]
        years = [F.min("min_year").alias("min_year"), F.max("max_year").alias("max_year")]
        found = found.unionByName(empty).groupBy("_set", *columns).agg(*sums, *years)
    else:
        found = rows.agg(F.lit(0).alias("_set"), *counts)

    def entry(measure: str, value: Column, n: Column) -> Column:
        return F.struct(F.lit(measure).alias("measure"), value.cast("string").alias("value"), n.cast("bigint").alias("n"))

    nothing = F.lit(None)
    whole = [entry("rows", nothing, F.col("n")), *[entry(name, nothing, F.col(name)) for name in checks]]
    if dated:
        whole += [entry(name, F.col(name), nothing) for name in ("min_year", "max_year")]
    # A set's number has a bit for each column that it leaves out, the first column's highest.
    every = 2 ** len(columns) - 1
    entries = F.array(*whole)
    for i, column in enumerate(columns):
        own = every - 2 ** (len(columns) - 1 - i)
        entries = F.when(F.col("_set") == own, F.array(entry(column, F.col(column), F.col("n")))).otherwise(entries)
    return found.select(F.lit(table).alias("table_name"), F.inline(entries))


def profiles(wh: Warehouse) -> DataFrame:
    """All four staging tables, each scanned once."""
    return stacked([profile(wh, table) for table in S.TABLES])


class StagingProfile:
    """The staging reports from a profile; ``found`` should be a stored table."""

    def __init__(self, found: DataFrame):
        self.found = found

    def _measures(self, table: str) -> DataFrame:
        return self.found.filter(F.col("table_name") == table)

    def row_counts(self) -> DataFrame:
        return self.found.filter("measure = 'rows'").select("table_name", F.col("n").alias("n_rows"))

    def frequency(self, table: str, column: str) -> DataFrame:
        if column not in COLUMNS[table]:
            raise ValueError(f"{column} of {table} is not profiled")
        found = self._measures(table).filter(F.col("measure") == column)
        return found.select(F.col("value").alias(column), "n").orderBy(F.desc("n"), column)

    def _row(self, table: str, names: list[str], kept: str) -> DataFrame:
        return self._measures(table).agg(*[F.max(F.when(F.col("measure") == name, F.col(kept))).alias(name) for name in names])

    def text_year_range(self) -> DataFrame:
        return self._row(STG_HEALTH, ["min_year", "max_year"], "value")

    def parse(self, table: str) -> DataFrame:
        return self._row(table, list(CHECKS[table]()), "n")
