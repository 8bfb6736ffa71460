"""Token counts through a digest cache.

A text's key is the digest of its content as the tokenizer sees it; a tokenizer's version is
the digest of its file. Stored counts are joined by both; of the texts that are missing, one
row each is encoded, the counts are appended to the cache, and all rows take theirs from it.
Only digests are shuffled, and the text of the rows to encode.

For a tokenizer that cuts at white space and keeps none of it (``splits_at_spaces``), runs of
ASCII white space count as one space in the key, and a text's count is the sum over its words,
which each worker remembers (a bounded number of them); the library encodes every word.
Other tokenizers encode whole texts.

The cache is a Parquet folder partitioned by version: appending is atomic by Spark's commit,
a failed run leaves it as it was, and two runs at once can only repeat an equal row.

Defined results: null is empty text with no tokens; rows that repeat are counted each.
Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starhouse.llm.common import stored, text_or_empty

LIMIT = 2048
#: Bounds of what a worker remembers and handles at once.
_REMEMBERED = 500_000
_CHARS_AT_ONCE = 4_000_000
_CACHE = "digest binary, n_tokens bigint, tokenizer string"

Encode = Callable[[list[str]], list[int]]


def encoder(content: bytes, kind: str) -> Encode:
    """Counts for a list of texts, by the library that reads such a file."""
    if kind == ".model":
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(content)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return lambda texts: [len(x.ids) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


class WordCounts:
    """Counts of texts as sums over their words; forgets all words when they grow too many."""

    def __init__(self, encode: Encode):
        self.encode = encode
        self.known: dict[str, int] = {}

    def count(self, texts: pa.Array) -> np.ndarray:
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > _REMEMBERED:
            self.known = {}
        fresh = [w for w in distinct if w not in self.known]
        self.known.update(zip(fresh, self.encode(fresh)))
        each = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        upto = np.concatenate([[0], np.cumsum(each[coded.indices.to_numpy()])])
        return np.diff(upto[words.offsets.to_numpy() - words.offsets[0].as_py()])


_workers: dict[str, WordCounts] = {}


def _counts(spark: SparkSession, content: bytes, kind: str, version: str, splits_at_spaces: bool) -> Callable:
    shared = spark.sparkContext.broadcast(content)  # a tokenizer file

    @F.pandas_udf("bigint")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if version not in _workers:
            _workers.clear()
            _workers[version] = WordCounts(encoder(shared.value, kind))
        worker = _workers[version]
        for batch in batches:
            out, group, size = [], [], 0
            for text in batch:
                group.append(text)
                size += len(text)
                if size > _CHARS_AT_ONCE or len(out) + len(group) == len(batch):
                    out += list(worker.count(pa.array(group, pa.string())) if splits_at_spaces else worker.encode(group))
                    group, size = [], 0
            yield pd.Series(out, dtype="int64")

    return n_tokens


def _content(text: Column, splits_at_spaces: bool) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\n\x0B\f\r]+", " ")) if splits_at_spaces else text


def cached(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """Stored counts of one tokenizer version; none before the first append."""
    try:
        known = spark.read.schema(_CACHE).parquet(cache)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        known = spark.createDataFrame([], _CACHE)
    return known.filter(F.col("tokenizer") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame, tokenizer_file: str, cache: str, splits_at_spaces: bool = False, limit: int = LIMIT
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit; the cache folder holds all counts afterwards."""
    spark = docs.sparkSession
    with open(tokenizer_file, "rb") as file:
        content = file.read()
    version = hashlib.sha256(content).hexdigest()
    keyed = docs.select(
        "doc_id",
        text_or_empty().alias("_text"),
        F.unhex(F.sha2(_content(text_or_empty(), splits_at_spaces), 256)).alias("digest"),
    )
    rows = stored(keyed.select("doc_id", "digest", F.octet_length("_text").cast("long").alias("n_bytes")), "token-keys")

    chosen = rows.groupBy("digest").agg(F.min("doc_id").alias("_least"))
    misses = stored(chosen.join(cached(spark, cache, version), "digest", "left_anti"), "token-misses")
    same = (keyed.digest == misses.digest) & keyed.doc_id.eqNullSafe(misses["_least"])
    texts = keyed.join(misses, same).select(keyed.digest, "_text")
    count = _counts(spark, content, os.path.splitext(tokenizer_file)[1], version, splits_at_spaces)
    fresh = texts.select("digest", count("_text").alias("n_tokens")).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    fresh.withColumn("tokenizer", F.lit(version)).write.mode("append").partitionBy("tokenizer").parquet(cache)

    known = cached(spark, cache, version)
    return rows.join(known, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
