"""URL filters: rules by host and path, and a Bloom filter cascade for listed domains.

The key universe is every domain of the corpus: each host and all its parent domains of two
labels or more. The cascade's first filter holds the listed keys; the second holds those keys
of the universe that the first lets through by mistake; the third the listed keys that the
second lets through; and so on until no mistake is left. A key's membership is then exact
for all keys of the universe: the first filter that does not hold it decides. The cascade is
a few bits for each listed key and is read as a scalar, so the table of pages is filtered in
its scan, without a join or a shuffle.

Filters are arrays of 64-bit words made by an aggregation. Keys whose filters would be larger than
``MAX_WORDS`` are dealt by hash into shards that are not: each has a cascade of its own and the
pages are passed once a shard, so a task holds one shard's filters however long the list is.
Everything is Spark expressions.

Defined results: a null url, or one without ``://``, has an empty host and path, no rule, and
is allowed; repeated rows are judged alike; an empty list blocks nothing. Only page_id and
url are read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import let, stored

#: Bound of all levels of a shard together: about 8 MB of filter.
MAX_WORDS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    whole = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(whole, _PARTS, 1), _UPPER, _LOWER), F.regexp_extract(whole, _PARTS, 2)


def domains(host: Column) -> Column:
    """The host and its parent domains of two labels or more."""

    def parents(labels: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1)))
        return F.transform(starts, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))

    return let(F.split(host, r"\."), parents)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule for the url: a struct of rule and verdict, null where none fits."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


@dataclass
class Level:
    words: DataFrame  # one row, one array
    n_words: int
    hashes: int
    number: int

    def places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(self.number), F.lit(i)), F.lit(self.n_words * 64)) for i in range(self.hashes)]

    def holds(self, key: Column, words: Column) -> Column:
        tests = [F.get(words, F.shiftright(p, 6).cast("int")).bitwiseAND(_bit(p)) != 0 for p in self.places(key)]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


def _bit(place: Column) -> Column:
    # The amount to shift may be a column only in SQL's function.
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place.bitwiseAND(F.lit(63)).cast("int"))


def _level(keys: DataFrame, n_keys: int, bits: float, number: int) -> Level:
    level = Level(keys, max(1, math.ceil(n_keys * bits / 64)), max(1, round(bits * math.log(2))), number)
    set_bits = keys.select(F.explode(F.array(*level.places(F.col("key")))).alias("p"))
    set_bits = set_bits.select(F.shiftright("p", 6).alias("word"), _bit(F.col("p")).alias("bits"))
    zeros = keys.sparkSession.range(level.n_words).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    words = set_bits.union(zeros).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    one = words.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("w"))
    level.words = stored(one.select(F.col("w.bits").alias("words")), "bloom-level")
    return level


def _first_bits(n_in: int, n_out: int) -> float:
    """Bits a listed key in the first filter: as many keys are let through as are listed, or fewer."""
    return max(2.0, math.log2(max(2.0, n_out / n_in)) / math.log(2))


def _shards(n_in: int, n_out: int) -> int:
    """Shards that keep the filters of each within the bound; later levels take about six bits a key."""
    return max(1, math.ceil(n_in * (_first_bits(n_in, n_out) + 6) / 64 / MAX_WORDS)) if n_in else 1


def cascade(universe: DataFrame, listed: DataFrame) -> list[Level]:
    """Levels that decide, for every key of ``universe``, whether it is in ``listed`` (both: key)."""
    inside = stored(universe.join(listed, "key", "left_semi"), "listed")
    outside = stored(universe.join(listed, "key", "left_anti"), "unlisted")
    n_in, n_out = inside.count(), outside.count()
    levels: list[Level] = []
    while n_in:
        bits = _first_bits(n_in, n_out) if not levels else 2.0
        levels.append(_level(inside, n_in, bits, len(levels)))
        level = levels[-1]
        mistaken = stored(outside.filter(level.holds(F.col("key"), level.words.scalar())), "bloom-mistaken")
        inside, outside = mistaken, inside
        n_in, n_out = mistaken.count(), n_in
    return levels


def member(levels: Sequence[Level], key: Column, words: Sequence[Column]) -> Column:
    """Whether a key of the universe is listed: the first level without it decides."""
    answer = F.lit(len(levels) % 2 == 1)
    for k in range(len(levels) - 1, -1, -1):
        answer = F.when(levels[k].holds(key, words[k]), answer).otherwise(F.lit(k % 2 == 1))
    return answer


def with_listed(pages: DataFrame, keys: Column, listed: DataFrame, into: str = "listed") -> DataFrame:
    """``pages`` with whether any of a row's keys (an array column) is in ``listed`` (key)."""
    universe = stored(pages.select(F.explode(keys).alias("key")).distinct(), "key-universe")
    listed = stored(listed.select("key").distinct(), "key-list")
    n_in = universe.join(listed, "key", "left_semi").count()
    shards = _shards(n_in, universe.count() - n_in)
    # ``keys`` may be an expression over a column of this name, so the answer has its own until the end.
    pages = pages.withColumn("_listed", F.lit(False))
    for shard in range(shards):

        def mine(key: Column, shard: int = shard) -> Column:
            return F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shards)) == shard

        levels = cascade(universe.filter(mine(F.col("key"))), listed.filter(mine(F.col("key"))))
        if not levels:
            continue
        names = [f"_level{k}" for k in range(len(levels))]
        for name, level in zip(names, levels):
            pages = pages.withColumn(name, level.words.scalar())
        words = [F.col(name) for name in names]
        hit = F.exists(keys, lambda key: mine(key) & member(levels, key, words) if shards > 1 else member(levels, key, words))
        pages = pages.withColumn("_listed", F.col("_listed") | hit).drop(*names)
        if shards > 1:
            pages = stored(pages, "url-shard")
    return pages.drop(into).withColumnRenamed("_listed", into)


def judged(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict: the longest rule's, else block for listed domains."""
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    found = with_listed(parsed, domains(F.col("host")), listed)
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    other = F.when(F.col("listed"), "block").otherwise("allow")
    return found.withColumn("_rule", rule).select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce(F.col("_rule.verdict"), other).alias("verdict")
    )


# Rules and listed names of the registered query (fixed values).
RULES = (
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
)
LISTED_NAMES = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def listed_domains(pages: DataFrame) -> DataFrame:
    """The corpus's domains whose first label is a listed name."""
    host, _ = host_and_path(F.col("url"))
    keys = pages.select(F.explode(domains(host)).alias("key"))
    named = F.substring_index("key", ".", 1).isin(*LISTED_NAMES) & F.col("key").contains(".")
    return keys.filter(named).distinct()


def oracle() -> str:
    part = "regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', {})"
    cases = "\n".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'"
        for r in sorted(RULES, key=lambda r: (-len(r.name), r.name))
    )
    verdicts = " ".join(f"WHEN '{r.name}' THEN '{r.verdict}'" for r in RULES)
    names = "|".join(LISTED_NAMES)
    return f"""
WITH parsed AS (
    SELECT page_id, translate({part.format(1)}, '{_UPPER}', '{_LOWER}') AS host, {part.format(2)} AS path FROM pages
), ruled AS (
    SELECT *, CASE {cases} END AS rule FROM parsed
)
SELECT page_id, host, path, rule,
       CASE rule {verdicts}
       ELSE CASE WHEN regexp_matches(host, '(^|\\.)({names})\\.') THEN 'block' ELSE 'allow' END END AS verdict
FROM ruled
"""
