"""From landed API pages to the CSV files that staging imports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.profile import Profile
from starhouse.schemas import CSV_COLUMNS, CSV_FILES, STG_COMM, STG_COUNTRY, STG_HEALTH, STG_NCD
from starhouse.sinks.files import write_csv
from starhouse.sources.csv_text import read_text_csv
from starhouse.sources.json_pages import (
    COMM_RECORD,
    CORRUPT,
    COUNTRY_RECORD,
    HEALTH_RECORD,
    NCD_RECORD,
    REGION_RECORD,
    damaged,
    flatten_pages,
    page_schema,
    read_pages,
    union_pulls,
)

# Folder of each pull that is not named after its own code.
NCD_PULL, COUNTRY_PULL, REGION_PULL = "ncd_deaths", "countries", "regions"
REGIONS_FILE = "regions.csv"
# Records per page.
PAGE_SIZE = 1000


def read_pulls(
    spark: SparkSession, profile: Profile, pages: str, one_page_per_file: bool = True
) -> dict[str, DataFrame]:
    """Records by output file; ``pages`` holds one folder of pages per pull.

    Health and communicable records come from one pull per code and are combined;
    a communicable record gets its disease's name, which the pages do not carry.
    """

    def pull(folder: str, fields: dict[str, str], **constants: str) -> DataFrame:
        return read_pages(spark, f"{pages}/{folder}", fields, constants, one_page_per_file)

    return {
        CSV_FILES[STG_HEALTH]: union_pulls([pull(code, HEALTH_RECORD) for code, *_ in profile.indicators]),
        CSV_FILES[STG_NCD]: pull(NCD_PULL, NCD_RECORD),
        CSV_FILES[STG_COMM]: union_pulls(
            [pull(code, COMM_RECORD, disease_name=name) for code, name, _ in profile.diseases]
        ),
        CSV_FILES[STG_COUNTRY]: pull(COUNTRY_PULL, COUNTRY_RECORD),
        REGIONS_FILE: pull(REGION_PULL, REGION_RECORD),
    }


def land_pages(
    spark: SparkSession, profile: Profile, pages: str, landed: str, one_page_per_file: bool = True
) -> None:
    """Write every file of :func:`read_pulls` with its header and fixed column order."""
    columns = {CSV_FILES[t]: [name for name, _ in cols] for t, cols in CSV_COLUMNS.items()}
    columns[REGIONS_FILE] = list(REGION_RECORD)
    for name, records in read_pulls(spark, profile, pages, one_page_per_file).items():
        write_csv(records, f"{landed}/{name}", [(c, c) for c in columns[name]])


def write_pages(df: DataFrame, fields: dict[str, str], path: str, page_size: int = PAGE_SIZE) -> None:
    """The reverse: records grouped into ``{"value": [...]}`` pages, one page per line.

    Pages follow the order of the rows in their partition, so none holds more than
    ``page_size`` records whatever keys they carry.
    """
    record = F.struct(*[F.col(name).alias(key) for name, key in fields.items()]).alias("_record")
    numbered = df.select(record, F.monotonically_increasing_id().alias("_row"))
    page = F.expr(f"_row div {page_size}").alias("_page")
    pages = numbered.select("_record", page).groupBy("_page").agg(F.collect_list("_record").alias("value"))
    pages.select("value").write.option("ignoreNullFields", True).json(path)


def landed_stage(spark: SparkSession, landed: str):
    """Staging tables by name, read from the CSV files in ``landed``."""
    return lambda table: read_text_csv(spark, f"{landed.rstrip('/')}/{CSV_FILES[table]}", table)


def landed_batch(pages: DataFrame, batch: int, fields: dict[str, str], constants: dict[str, str], table: str) -> None:
    """Write one batch of pages: records under ``<table>/records``, damaged pages under ``<table>/quarantine``.

    A batch has a folder of its own, which a repeated attempt writes again.
    """
    pages.filter(~damaged()).transform(flatten_pages, fields, constants).write.mode("overwrite").parquet(
        f"{table}/records/batch={batch}"
    )
    pages.filter(damaged()).select("source_file", F.coalesce(CORRUPT, F.lit("")).alias("record")).write.mode("overwrite").parquet(
        f"{table}/quarantine/batch={batch}"
    )


def land_arriving(
    spark: SparkSession,
    pages: str,
    fields: dict[str, str],
    table: str,
    constants: dict[str, str] | None = None,
    one_page_per_file: bool = True,
) -> None:
    """Land the pages of one pull that have arrived since the last call, each exactly once.

    A file stream keeps in ``<table>/progress`` which files are done; all that are new are taken
    in one go. To run without end, call it from a scheduler, or start a query of the same parts.
    """
    stream = spark.readStream.schema(page_schema(fields)).option("multiLine", one_page_per_file)
    arriving = stream.option("columnNameOfCorruptRecord", CORRUPT).json(pages).select("*", F.col("_metadata.file_name").alias("source_file"))

    def write(batch: DataFrame, number: int) -> None:
        landed_batch(batch, number, fields, constants or {}, table)

    query = arriving.writeStream.foreachBatch(write).option("checkpointLocation", f"{table}/progress").trigger(availableNow=True).start()
    query.awaitTermination()


def arrived(spark: SparkSession, fields: dict[str, str], table: str, constants: dict[str, str] | None = None) -> DataFrame:
    """All records landed so far, with the columns that the batch readers give."""
    columns = [*fields, *(constants or {})]
    return spark.read.schema(", ".join(f"{c} STRING" for c in columns)).parquet(f"{table}/records").select(*columns)
