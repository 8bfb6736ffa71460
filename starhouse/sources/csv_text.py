"""CSV files into all-text staging with lineage columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.schemas import CSV_COLUMNS, csv_schema


def with_lineage(df: DataFrame, source_file: str | None = None) -> DataFrame:
    """Add ``source_file`` (the file each row was read from, or the given name) and ``ingested_at``."""
    origin = F.col("_metadata.file_name") if source_file is None else F.lit(source_file)
    return df.select("*", origin.alias("source_file"), F.current_timestamp().alias("ingested_at"))


CORRUPT = "_corrupt_record"


def _parsed(spark: SparkSession, path: str | list[str], table: str, line_sep: str | None, multi_line: bool) -> DataFrame:
    """Rows as read, with the text of those that do not have exactly the table's fields."""
    reader = (
        spark.read.schema(csv_schema(table).add(CORRUPT, "string"))
        .option("header", True)
        # A file whose header differs fails the read; a line-feed import leaves a return in the header.
        .option("enforceSchema", line_sep == "\n")
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("multiLine", multi_line)
    )
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return with_lineage(reader.csv(path))


def _broken(table: str) -> Column:
    """Whether a row does not fit. It names every field: the parser counts only fields that are read."""
    fields = [F.coalesce(F.col(name), F.lit("")) for name, _ in CSV_COLUMNS[table]]
    return F.concat(*fields, F.col(CORRUPT)).isNotNull()


def read_text_csv(
    spark: SparkSession,
    path: str | list[str],
    table: str,
    line_sep: str | None = None,
    multi_line: bool = False,
    accept_rejects: bool = False,
) -> DataFrame:
    """Read one staging table: header row, quoted fields, CRLF or LF, every column text.

    Empty fields become '' and not null, so parse checks count them. With
    ``line_sep=None`` a CRLF ending is absorbed; ``"\n"`` keeps the ``\r`` in the
    last column, as a plain line-feed import would. ``multi_line`` is for files with
    line breaks inside quotes; such files are read by one task each.

    A row with a field too many or too few fails the read, unless rejects are
    accepted; :func:`csv_rejects` returns them.
    """
    raw = _parsed(spark, path, table, line_sep, multi_line)
    broken = _broken(table)
    if accept_rejects:
        raw = raw.filter(~broken)
    else:
        message = F.concat(F.col("source_file"), F.lit(": not a row of the table: "), F.col(CORRUPT))
        raw = raw.filter(F.when(broken, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    return raw.select(
        *[F.coalesce(F.col(name), F.lit("")).alias(staged) for name, staged in CSV_COLUMNS[table]],
        "source_file",
        "ingested_at",
    )


def csv_rejects(
    spark: SparkSession, path: str | list[str], table: str, line_sep: str | None = None, multi_line: bool = False
) -> DataFrame:
    """Rows that :func:`read_text_csv` does not accept: source_file, record."""
    rows = _parsed(spark, path, table, line_sep, multi_line).filter(_broken(table))
    return rows.select("source_file", F.col(CORRUPT).alias("record"))
