"""One query for each corpus operator, with production parameters over the whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from starhouse.llm import (
    conversation_repair,
    dart_minhash,
    edit_matching,
    language_crf,
    line_spread,
    one_permutation,
    personal_data,
    pfair_mix,
    secret_links,
    token_alignment,
    token_cache,
    url_cascade,
    warc_chunks,
)
from starhouse.llm.common import table
from starhouse.scratch import scratch_path

Job = Callable[[SparkSession, str], DataFrame]


def op1_edit_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_matching.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return pfair_mix.mixed(docs).select("doc_id", "source", "slot", "block", "place")


def op3_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_links.report(table(spark, sf_dir, "documents"))


def op4_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.classes(table(spark, sf_dir, "documents"))


def op5_one_permutation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_permutation.edited(table(spark, sf_dir, "documents"))


def op6_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_crf.predict(table(spark, sf_dir, "documents"))


def op7_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return line_spread.without_boilerplate(docs).select("doc_id", "n_lines", "n_removed", "text")


def op8_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_chunks.round_trip(table(spark, sf_dir, "pages"))


def op9_token_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With an empty cache, so every distinct text is encoded. This tokenizer drops white space."""
    import public_tokenizers

    return token_cache.count_tokens(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        scratch_path(spark, "token-cache"),
        splits_at_spaces=True,
    )


def op10_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_cascade.judged(pages, url_cascade.RULES, url_cascade.listed_domains(pages))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.report(table(spark, sf_dir, "documents"), *files)


def op12_candidate_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.report(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


def jobs() -> dict[str, Job]:
    chosen = (
        op1_edit_matching,
        op2_pfair_mix,
        op3_secret_links,
        op4_dart_minhash,
        op5_one_permutation,
        op6_language_crf,
        op7_line_spread,
        op8_warc_chunks,
        op9_token_cache,
        op10_url_cascade,
        op11_token_alignment,
        op12_candidate_boosting,
        op13_conversation_repair,
    )
    return {f.__name__: f for f in chosen}


def oracle_sql() -> dict[str, str]:
    return {
        "op7_line_spread": line_spread.oracle(),
        "op8_warc_chunks": warc_chunks.oracle(),
        "op10_url_cascade": url_cascade.oracle(),
        "op13_conversation_repair": conversation_repair.oracle(),
    }
