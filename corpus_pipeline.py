"""A corpus pipeline of five stages, each one operator of ``starhouse.llm``.

Every stage takes all rows its predecessor kept and returns the columns of ``documents``;
the last adds the place of each document in the mix. ``run`` writes each stage's result to
the shared folder and reads it again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.llm import dart_minhash, edit_matching, language_crf, line_spread, pfair_mix
from starhouse.llm.common import DOCUMENT_COLUMNS, stored, table

#: A document is rejected when less of its n-grams were met in training, beyond chance.
MIN_FAMILIAR = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those that resemble none of the learned languages."""
    model = language_crf.train(docs)
    named = language_crf.with_language(docs.select(*DOCUMENT_COLUMNS), model, "_pred", "_score", "_familiar")
    known = (F.col("_pred") != language_crf.UNKNOWN) & (F.col("_familiar") >= MIN_FAMILIAR)
    return named.filter(known).select(*DOCUMENT_COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes cross-site boilerplate lines out of all documents but the first that has them."""
    docs = docs.select(*DOCUMENT_COLUMNS)
    cleaned = line_spread.without_boilerplate(docs, min_sites=line_spread.threshold(docs))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENT_COLUMNS)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates."""
    return dart_minhash.deduplicated(docs.select(*DOCUMENT_COLUMNS))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents in which a benchmark item occurs."""
    return edit_matching.decontaminated(docs.select(*DOCUMENT_COLUMNS), table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Gives every document its slot in a mix of sources by tempered weights."""
    return pfair_mix.mixed(docs.select(*DOCUMENT_COLUMNS), text="text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("near_duplicates", dedup_near),
    ("decontamination", decontaminate),
    ("mix", mix),
]

#: The labels of words and the edit distances have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
