"""Writers for core tables and exports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from starhouse.operators.ordering import with_global_index
from starhouse.schemas import FactSpec
from starhouse.scratch import released


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


def write_fact(df: DataFrame, spec: FactSpec, path: str, starts: Mapping[int, int] | None = None) -> int:
    """Write a fact with dense surrogate ids, one folder per year; returns the rows written.

    Ids follow the load order, whose first column is the year, so rows reach the
    writer already clustered by year: few files per folder without a second
    shuffle. Files stay sorted by category and country, so Parquet statistics
    skip row groups on those filters. The numbering writes the typed rows once to the
    shared folder; that copy goes as soon as the fact is written, or has failed.

    With ``starts``, the rows of ``df`` before each of its years, ids begin anew in each
    year, so that a year's folder stays valid whatever other years hold.
    """
    seen = Observation()
    with released(df.sparkSession):
        numbered = with_global_index(df.select(*spec.columns), spec.load_order, "fact_id")
        if starts is not None:
            before = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])
            numbered = numbered.withColumn("fact_id", F.col("fact_id") - before[F.col("year_val").cast("int")])
        (
            numbered.withColumn("created_at", F.current_timestamp())
            .sortWithinPartitions(*spec.load_order)
            .observe(seen, F.count("*").alias("n"))
            .write.mode("errorifexists")
            .partitionBy("year_val")
            .parquet(path)
        )
    return seen.get["n"]


def write_csv(df: DataFrame, path: str, columns: list[tuple[str, str]], line_sep: str = "\r\n") -> None:
    """Header row, fixed column order; nulls and '' both as an empty field.

    ``columns`` pairs the column of ``df`` with its name in the file.
    """
    (
        df.select(*[F.col(name).cast("string").alias(header) for name, header in columns])
        .write.option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("lineSep", line_sep)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
