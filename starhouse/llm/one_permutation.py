"""Document fingerprints by one-permutation MinHash, in Spark expressions only.

Every five-word shingle is hashed once. The hash's top bits choose one of ``BINS`` bins, and
a bin keeps its least hash. Empty bins are filled by optimal densification: each tries bins
in an order of its own, the same in every document, and copies the first that is not empty
(the first ``_TRIES`` by hashing, then the rest by rank of a hash). Of every bin the low
eight bits are stored, and likeness is corrected for bits that agree by chance.

Words are runs of letters and digits in lower case; a text of one to four words is one
shingle, and a text without words is its own shingle. The empty text (and null) has a
fingerprint of zeros, alike to itself and to no other.

``edited`` pairs each document with the next by id. Documents are numbered by a range
partition; neighbours across ranges come from one row a range. Defined results: null ids come
first; among equal ids the text's digest decides; rows that agree in id and text are one
document for this purpose and get equal results each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.llm.common import document_key, let, stored, text_or_empty

WORDS = 5
BINS = 256
_BIN_SHIFT = 56
_TRIES = 6
_LONGS = BINS // 8
_WORD = r"([\p{L}\p{N}]+)"
_EMPTY = (1 << _BIN_SHIFT) - 1
_LOW_BITS = 0x0101010101010101


def shingle_hashes(text: Column) -> Column:
    """One hash for each shingle, as an array; none for the empty text."""
    words = F.transform(F.regexp_extract_all(F.lower(text), F.lit(_WORD), F.lit(1)), lambda w: F.xxhash64(w))

    def shingles(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - WORDS)
        windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WORDS)]))
        return (
            F.when(F.size(w) >= WORDS, windows)
            .when(F.size(w) > 0, F.array(F.xxhash64(w)))
            .when(text != "", F.array(F.xxhash64(text)))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return let(words, shingles)


def _is_empty(x: Column) -> Column:
    return x.bitwiseAND(F.lit(_EMPTY)) == _EMPTY


def bin_minima(hashes: Column) -> Column:
    """Least hash of every bin; where a bin has none, a mark of its own.

    The marks are the largest value of each bin, so after sorting, the values that begin a
    bin are exactly one for each.
    """
    marks = F.transform(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda i: F.shiftleft(i.cast("bigint"), _BIN_SHIFT) + _EMPTY)

    def firsts(h: Column) -> Column:
        def begins(x: Column, i: Column) -> Column:
            return (i == 0) | (F.shiftright(x, _BIN_SHIFT) != F.shiftright(F.get(h, i - 1), _BIN_SHIFT))

        return F.filter(h, begins)

    return let(F.sort_array(F.concat(hashes, marks)), firsts)


def densified(minima: Column) -> Column:
    """The minima with every empty bin filled from one that is not."""

    def fill(all_bins: Column, full: Column) -> Column:
        def value(x: Column, i: Column) -> Column:
            tries = []
            for k in range(_TRIES):
                y = F.get(all_bins, F.pmod(F.xxhash64(i, F.lit(k)), F.lit(BINS)).cast("int"))
                tries.append(F.when(~_is_empty(y), y))
            ranked = F.transform(full, lambda y: F.struct(F.xxhash64(i, F.shiftright(y, _BIN_SHIFT)), y.alias("y")))
            return F.when(~_is_empty(x), x).otherwise(F.coalesce(*tries, F.array_min(ranked)["y"]))

        return F.transform(all_bins, value)

    return let(minima, lambda m: let(F.filter(m, lambda x: ~_is_empty(x)), lambda full: fill(m, full)))


def fingerprint(text: Column) -> Column:
    """The low byte of every bin, eight to a long."""

    def packed(x: Column) -> Column:
        def eight(j: Column) -> Column:
            out = F.lit(0).cast("bigint")
            for k in range(8):
                out = out.bitwiseOR(F.shiftleft(F.get(x, j * 8 + k).bitwiseAND(F.lit(255)), 56 - 8 * k))
            return out

        return F.transform(F.sequence(F.lit(0), F.lit(_LONGS - 1)), eight)

    zeros = F.array_repeat(F.lit(0).cast("bigint"), _LONGS)
    return F.when(text == "", zeros).otherwise(let(densified(bin_minima(shingle_hashes(text))), packed))


def as_hex(fingerprint: Column) -> Column:
    return F.lower(F.array_join(F.transform(fingerprint, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity: the share of equal bytes, less those equal by chance (1 in 256)."""

    def differing(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        for shift in (4, 2, 1):
            z = z.bitwiseOR(F.shiftright(z, shift))
        return F.bit_count(z.bitwiseAND(F.lit(_LOW_BITS)))

    unequal = F.aggregate(F.zip_with(a, b, differing), F.lit(0), lambda n, d: n + d)
    corrected = ((F.lit(1.0) - unequal / BINS) - 1 / 256) / (1 - 1 / 256)
    nothing = F.array_repeat(F.lit(0).cast("bigint"), _LONGS)
    apart = (a == nothing) != (b == nothing)
    return F.when(apart, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), corrected))


def _followers(keys: DataFrame) -> DataFrame:
    """``keys`` (doc_id, _doc, unique) with the next row's key by doc_id; the last is followed by the first."""
    ordered = keys.repartitionByRange("doc_id", "_doc").sortWithinPartitions("doc_id", "_doc")
    ordered = stored(ordered.withColumn("_row", F.monotonically_increasing_id()), "fingerprint-order")
    ordered = ordered.withColumn("_range", F.shiftright("_row", 33))
    # One row a range partition, however many documents there are.
    firsts = ordered.groupBy("_range").agg(F.min(F.struct("_row", "_doc")).alias("_first"))
    line = Window.orderBy("_range")
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = F.col("_first._doc")
    after = firsts.select("_range", F.coalesce(F.lead(first).over(line), F.first(first).over(whole)).alias("_after"))
    inside = F.lead("_doc").over(Window.partitionBy("_range").orderBy("_row"))
    return (
        ordered.withColumn("_inside", inside)
        .join(F.broadcast(after), "_range")
        .withColumn("_next", F.coalesce("_inside", "_after"))
        .drop("_row", "_range", "_inside", "_after")
    )


def edited(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike they and the next text's are.

    The edited text has its last quarter replaced by as many characters of the next document's
    beginning. Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.
    """
    texts = docs.select("doc_id", document_key(text_or_empty()).alias("_doc"), text_or_empty().alias("_text"))
    known = stored(
        texts.select("doc_id", "_doc", F.length("_text").cast("bigint").alias("n_chars"), fingerprint(F.col("_text")).alias("_own")),
        "fingerprints",
    )
    single = known.groupBy("doc_id", "_doc").agg(F.min("n_chars").alias("n_chars"), F.first("_own").alias("_own"))
    single = stored(single, "fingerprints-single")
    pairs = _followers(single.select("doc_id", "_doc", "n_chars")).join(single.select("_doc", "_own"), "_doc")
    other = single.select(F.col("_doc").alias("_next"), F.col("_own").alias("_other"))
    pairs = pairs.join(other, "_next").withColumn("near_next", likeness(F.col("_own"), F.col("_other"))).drop("_other")

    # Both joins below read the same shuffle of (key, text).
    plain = texts.select("_doc", "_text")
    quarter = F.expr("n_chars div 4").cast("int")
    heads = (
        pairs.join(plain.withColumnRenamed("_doc", "_next"), "_next")
        .withColumn("_head", F.substring("_text", F.lit(1), quarter))
        .drop("_next", "_text")
        .dropDuplicates(["_doc"])
    )
    body = F.substring("_text", F.lit(1), (F.col("n_chars") - quarter).cast("int"))
    both = plain.join(heads, "_doc").withColumn("_edited", F.concat(body, F.col("_head")))
    both = both.withColumn("_new", fingerprint(F.col("_edited")))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("_edited", 256).alias("edited_sha256"),
        as_hex(F.col("_own")).alias("fingerprint"),
        as_hex(F.col("_new")).alias("edited_fingerprint"),
        likeness(F.col("_own"), F.col("_new")).alias("near_edited"),
        "near_next",
    )
