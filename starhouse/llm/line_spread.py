"""Cross-site line dedup: lines that spread over many distinct sites are boilerplate.

One aggregation keeps a HyperLogLog sketch of sites per line hash; partial sketches merge
before and after the shuffle, so a line that stands in a third of all documents is one row
per task by then. Estimates far from the threshold decide at once; lines near it get an
exact distinct count of their sites. Each boilerplate line stays where it occurs first
(smallest document, then smallest line number) and goes everywhere else, so no text is lost
from the corpus as a whole. The number of sites is a parameter; without it ``threshold`` takes
it from the corpus, lower where sites are few or unequal.

Defined results: lines are compared without outer spaces and case-sensitively; blank lines
are never boilerplate; null text is empty text, a null site is a site of its own; rows equal
in id and text share one fate; a document whose lines all go stays with an empty text. Only
the named columns are read; all of ``docs``, whatever their names, are returned by
``without_boilerplate``.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import document_key, let, shielded, stored, text_or_empty

MIN_SITES = 10
#: A line on fewer sites is never boilerplate, however few sites a corpus has.
LEAST_SITES = 3
#: Sketches of 2**10 buckets: a standard error of about 3 %.
SKETCH_BITS = 10
#: Share of the threshold on either side within which sites are counted exactly (3 errors).
MARGIN = 0.1


def _lines(docs: DataFrame, text: str, site: str) -> DataFrame:
    """A narrow row for each line that is not blank: two 64-bit hashes stand for its text."""
    line = F.trim("_line")
    return (
        docs.select(
            F.col("doc_id").alias("_id"),
            document_key(text_or_empty(text)).alias("_doc"),
            F.coalesce(F.concat(F.lit("="), F.col(site)), F.lit("-")).alias("_site"),
            F.posexplode(F.split(text_or_empty(text), "\n", -1)).alias("_no", "_line"),
        )
        .filter(line != "")
        .select("_id", "_doc", "_site", "_no", F.xxhash64(line).alias("_h1"), F.xxhash64(F.lit("b"), line).alias("_h2"))
    )


def threshold(docs: DataFrame, site: str = "source") -> int:
    """Half the effective number of sites, at least ``LEAST_SITES`` and at most ``MIN_SITES``.

    The effective number is the inverse chance that two documents share a site: a site with
    a third of the documents takes copies that would otherwise lie on sites of their own.
    """
    n = F.count("*").cast("double").alias("_n")
    total, squares = docs.groupBy(site).agg(n).agg(F.sum("_n"), F.sum(F.col("_n") * F.col("_n"))).first()
    return max(LEAST_SITES, min(MIN_SITES, math.ceil(total * total / squares / 2))) if total else MIN_SITES


def boilerplate(docs: DataFrame, text: str = "text", site: str = "source", min_sites: int | None = None) -> DataFrame:
    """Hashes of the lines that occur on ``min_sites`` sites or more, and where each is first."""
    if min_sites is None:
        min_sites = threshold(docs, site)
    lines = _lines(docs, text, site)
    spread = (
        lines.groupBy("_h1", "_h2")
        .agg(
            F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(SKETCH_BITS))).alias("_sites"),
            F.min(F.struct("_id", "_doc", "_no")).alias("_first"),
        )
        .filter(F.col("_sites") >= min_sites - max(1, int(min_sites * MARGIN)))
    )
    spread = stored(spread, "line-spread")
    near = F.abs(F.col("_sites") - min_sites) <= max(1, int(min_sites * MARGIN))
    exact = (
        lines.join(spread.filter(near).select("_h1", "_h2"), ["_h1", "_h2"], "left_semi")
        .select("_h1", "_h2", "_site")
        .distinct()
        .groupBy("_h1", "_h2")
        .count()
        .filter(F.col("count") >= min_sites)
    )
    kept = spread.filter(near).join(exact, ["_h1", "_h2"], "left_semi")
    return spread.filter(~near).unionByName(kept).select("_h1", "_h2", "_first")


def without_boilerplate(
    docs: DataFrame, text: str = "text", site: str = "source", min_sites: int | None = None
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``; adds ``n_lines`` and ``n_removed``.

    A column of ``docs`` with one of these two names is replaced.
    """
    docs, named = shielded(docs)
    here = F.struct("_id", "_doc", "_no")
    removed = (
        _lines(docs, text, site)
        .join(stored(boilerplate(docs, text, site, min_sites), "boilerplate"), ["_h1", "_h2"])
        .filter(here != F.col("_first"))
        .groupBy("_doc")
        .agg(F.collect_set("_no").alias("_gone"))
    )
    keyed = docs.withColumn("_doc", document_key(text_or_empty(text)))
    lines = F.split(text_or_empty(text), "\n", -1)
    places = F.sequence(F.lit(0), F.size(lines) - 1)
    staying = let(lines, lambda own: F.transform(F.array_except(places, F.col("_gone")), lambda i: F.get(own, i)))
    gone = F.coalesce(F.size("_gone"), F.lit(0)).cast("long")
    return named(
        keyed.join(removed, "_doc", "left")
        .withColumn("n_removed", F.when(F.col("_gone").isNull(), F.lit(0)).otherwise(gone).cast("long"))
        .withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn(text, F.when(F.col("_gone").isNull(), text_or_empty(text)).otherwise(F.concat_ws("\n", staying)))
        .drop("_doc", "_gone")
    )


def oracle() -> str:
    return f"""
WITH sized AS (
    SELECT source, CAST(count(*) AS DOUBLE) AS n FROM documents GROUP BY source
), needed AS (
    SELECT greatest({LEAST_SITES}, least({MIN_SITES}, ceil(sum(n) * sum(n) / sum(n * n) / 2))) AS sites FROM sized
), lines AS (
    SELECT doc_id, coalesce('=' || source, '-') AS site,
           unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS place
    FROM documents
), spread AS (
    SELECT trim(line) AS line, min({{'d': doc_id, 'p': place}}) AS earliest
    FROM lines WHERE trim(line) <> '' GROUP BY 1 HAVING count(DISTINCT site) >= (SELECT sites FROM needed)
), marked AS (
    SELECT l.doc_id, l.place, l.line,
           coalesce(s.earliest <> {{'d': l.doc_id, 'p': l.place}}, false) AS gone
    FROM lines l LEFT JOIN spread s ON trim(l.line) = s.line
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '') AS text
FROM marked GROUP BY doc_id
"""
