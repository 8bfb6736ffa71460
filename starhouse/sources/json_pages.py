"""Landed API pages, ``{"value": [record, ...]}``, into flat text records."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Output column -> key in the page record, one map per record kind.
HEALTH_RECORD = {
    "indicator_code": "IndicatorCode",
    "country_code": "SpatialDim",
    "spatial_dim_type": "SpatialDimType",
    "year": "TimeDim",
    "sex_code": "Dim1",
    "numeric_value": "NumericValue",
    "low": "Low",
    "high": "High",
}
NCD_RECORD = {
    "indicator_code": "IndicatorCode",
    "country_code": "SpatialDim",
    "spatial_dim_type": "SpatialDimType",
    "year": "TimeDim",
    "sex_code": "Dim1",
    "cause_code": "Dim2",
    "numeric_value": "NumericValue",
    "low": "Low",
    "high": "High",
}
COMM_RECORD = {
    "indicator_code": "IndicatorCode",
    "country_code": "SpatialDim",
    "spatial_dim_type": "SpatialDimType",
    "year": "TimeDim",
    "numeric_value": "NumericValue",
    "low": "Low",
    "high": "High",
}
COUNTRY_RECORD = {
    "country_code": "Code",
    "country_name": "Title",
    "parent_code": "ParentCode",
    "parent_title": "ParentTitle",
}
REGION_RECORD = {"region_code": "Code", "region_name": "Title"}


CORRUPT = "_corrupt_record"


def page_schema(fields: dict[str, str]) -> T.StructType:
    """Numbers are read as text, so the page's own digits reach staging untouched."""
    record = T.StructType([T.StructField(key, T.StringType()) for key in fields.values()])
    return T.StructType([T.StructField("value", T.ArrayType(record)), T.StructField(CORRUPT, T.StringType())])


def flatten_pages(
    pages: DataFrame, fields: dict[str, str], constants: dict[str, str] | None = None
) -> DataFrame:
    """One row per record; a missing key and an explicit null both become ''."""
    records = pages.select(F.explode("value").alias("r"))
    flat = [F.coalesce(F.col(f"r.{key}"), F.lit("")).alias(name) for name, key in fields.items()]
    fixed = [F.lit(text).alias(name) for name, text in (constants or {}).items()]
    return records.select(*flat, *fixed)


def _pages(spark: SparkSession, path: str | list[str], fields: dict[str, str], one_page_per_file: bool) -> DataFrame:
    reader = spark.read.schema(page_schema(fields)).option("multiLine", one_page_per_file)
    return reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)


def damaged() -> Column:
    """A page that does not parse, or that has no list of records."""
    return F.col(CORRUPT).isNotNull() | F.col("value").isNull()


def read_pages(
    spark: SparkSession,
    path: str | list[str],
    fields: dict[str, str],
    constants: dict[str, str] | None = None,
    one_page_per_file: bool = False,
    accept_rejects: bool = False,
) -> DataFrame:
    """Pages landed one per line, or one (possibly indented) page per file.

    A damaged page fails the read, unless rejects are accepted; then it is left out
    with all its records, and :func:`page_rejects` returns it.
    """
    pages = _pages(spark, path, fields, one_page_per_file)
    if accept_rejects:
        pages = pages.filter(~damaged())
    else:
        text = F.coalesce(F.substring(CORRUPT, 1, 200), F.lit("no list of records"))
        message = F.concat(F.lit("damaged page: "), text)
        # In the column itself: Spark tests a list before it unrolls it, ahead of other filters.
        kind = pages.schema["value"].dataType
        pages = pages.withColumn("value", F.when(damaged(), F.raise_error(message).cast(kind)).otherwise(F.col("value")))
    return flatten_pages(pages, fields, constants)


def page_rejects(
    spark: SparkSession, path: str | list[str], fields: dict[str, str], one_page_per_file: bool = False
) -> DataFrame:
    """Damaged pages: source_file, record (the text where there is one)."""
    pages = _pages(spark, path, fields, one_page_per_file)
    return pages.select("*", F.col("_metadata.file_name").alias("source_file")).filter(damaged()).select(
        "source_file", F.coalesce(CORRUPT, F.lit("")).alias("record")
    )


def union_pulls(pulls: list[DataFrame]) -> DataFrame:
    """Several pulls of the same record kind as one dataset; duplicates are kept."""
    return reduce(DataFrame.unionByName, pulls)
