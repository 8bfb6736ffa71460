"""Personal data by candidate gradient boosting.

Generators of high recall propose spans, which may overlap: the four base patterns, and looser
ones that split runs of numbers or take other spellings (``(at)``, ``[.]``, other separators).
Each candidate has a normal form. Boosted trees judge it by the format of that form and by its
context, and a threshold for each kind, calibrated on rows the trees have not seen, selects
what is reported beside the base spans.

The labels are the checks of the base patterns: a candidate with the extent of an accepted base
span is positive; a match of a base pattern that fails its check, and a piece inside an accepted
span, are negative; all others have no label, and it is these the trees are for. Equal
candidates in equal contexts count once in training, so copies of a text have no weight of their
own. All of them are used, however many: one in ``HELD_OUT`` by hash for the thresholds, the
others for the trees. Up to ``TASK_ROWS`` of them the trees are the same on every run; beyond, tasks
add up their sums in the order they end.

A text is read once: matches and the pieces between them give lengths and contexts, and places
are running sums over rows, so a text with very many matches costs no more than its length.
Patterns are possessive and start only where a run starts, which changes no match and keeps the
search linear. Everything is built-in expressions and Spark's own boosted trees.

Defined results: null is empty text; every row is a document of its own, whatever its id; where
a label has no rows (as in an empty table) nothing is added to the base spans. Places are code
points, the end exclusive. Only doc_id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.llm.common import let, stored, text_or_empty
from starhouse.operators.ordering import with_running_total

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

#: Labelled rows that one task holds while the trees are fitted, about.
TASK_ROWS = 100_000
HELD_OUT = 4
#: Share of true spans among those a threshold selects from the held-out rows.
PRECISION = 0.99
TREES, DEPTH = 20, 4
#: Characters kept of a match's normal form, and of the text on either side.
_SHOWN, _CONTEXT = 96, 24

_LOCAL = r"[A-Za-z0-9._%+-]"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
_BETWEEN = r"[\x20.– /-]"


@dataclass(frozen=True)
class Generator:
    kind: int
    pattern: str
    hint: str  # what a text must hold for a match (a superset, cheap to test)
    base: bool = False


GENERATORS = (
    Generator(
        EMAIL, rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", True
    ),
    Generator(IP, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", True),
    Generator(CARD, r"[0-9](?:[\x20-]?[0-9])++", r"[0-9][\x20-]?[0-9]", True),
    Generator(PHONE, r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", True),
    Generator(
        EMAIL,
        rf"(?<!{_LOCAL}){_LOCAL}++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)++",
        r"@|\(at\)|\[at\]",
    ),
    Generator(IP, r"(?<![0-9.])[0-9]{1,3}+(?:(?:\.|\[\.\])[0-9]{1,3}+){3}(?![0-9]|\.[0-9])", r"[0-9](?:\.|\[\.\])[0-9]"),
    Generator(CARD, r"(?<![0-9])[0-9]{12,19}+(?![0-9])", r"[0-9]{12}"),
    Generator(CARD, rf"(?<![0-9])[0-9]{{4}}(?:{_BETWEEN}[0-9]{{4}}){{3}}(?![0-9])", rf"[0-9]{{4}}{_BETWEEN}[0-9]{{4}}"),
    Generator(
        PHONE,
        r"(?:\+|(?<![0-9.])00)[1-9][0-9]{0,2}[\x20.-]?\(?[0-9]{2,4}\)?(?:[\x20.-]?[0-9]{2,4}){2,3}(?![0-9])",
        r"(?:\+|00)[1-9]",
    ),
)

_HIT = "array<struct<gen: int, i: int, gap: int, n: int, form: string, digits: string, n_digits: int, before: string, after: string>>"


def _normal(kind: int, match: Column) -> Column:
    """One spelling for all ways to write a value."""
    if kind == EMAIL:
        plain = F.regexp_replace(F.regexp_replace(match, r"\x20?(?:\(at\)|\[at\])\x20?", "@"), r"\x20?(?:\(dot\)|\[dot\])\x20?", ".")
        return F.regexp_replace(plain, r"\x20?([@.])\x20?", "$1")
    if kind == IP:
        return F.regexp_replace(F.replace(match, F.lit("[.]"), F.lit(".")), "(?<![0-9])0+(?=[0-9])", "")
    if kind == PHONE:
        return F.regexp_replace(match, "^00", "+")
    return F.regexp_replace(match, "[^0-9]", "")


def _hits(number: int, text: Column) -> Column:
    """Matches of one generator with the length of the text before each and what is around it."""
    g = GENERATORS[number]

    def all_of(pieces: Column) -> Column:
        def one(match: Column, i: Column) -> Column:
            digits = F.regexp_replace(match, "[^0-9]", "")
            return F.struct(
                F.lit(number).alias("gen"),
                i.alias("i"),
                F.length(F.get(pieces, i)).alias("gap"),
                F.length(match).alias("n"),
                F.left(_normal(g.kind, match), F.lit(_SHOWN)).alias("form"),
                F.left(digits, F.lit(20)).alias("digits"),
                F.length(digits).alias("n_digits"),
                F.right(F.get(pieces, i), F.lit(_CONTEXT)).alias("before"),
                F.left(F.get(pieces, i + 1), F.lit(_CONTEXT)).alias("after"),
            )

        return F.transform(F.regexp_extract_all(text, F.lit(g.pattern), F.lit(0)), one)

    none = F.array().cast(_HIT)
    return F.when(F.rlike(text, F.lit(g.hint)), let(F.split(text, g.pattern, -1), all_of)).otherwise(none)


def passes_luhn(digits: Column) -> Column:
    """Whether a string of digits carries a right Luhn check digit."""
    back = F.reverse(digits)
    plain = F.regexp_replace(back, "(.)(.)?", "$1")
    doubled = F.translate(F.regexp_replace(back, "(.)(.)?", "$2"), "0123456789", "0246813579")
    both = F.concat(plain, doubled)
    total = F.lit(0)
    for d in range(1, 10):
        total = total + F.lit(d) * (F.length(both) - F.length(F.translate(both, str(d), "")))
    return total % 10 == 0


def proposed(docs: DataFrame) -> DataFrame:
    """A row a document: _row, doc_id, hits. The texts are read here and nowhere else."""
    found = F.flatten(F.array(*[_hits(k, F.col("_text")) for k in range(len(GENERATORS))]))
    read = docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id"), text_or_empty().alias("_text"))
    return read.select("_row", "doc_id", found.alias("hits"))


def candidates(found: DataFrame) -> DataFrame:
    """A row a candidate with its place, the checks of its form, and how it lies to accepted base spans."""
    rows = found.select("_row", F.explode("hits").alias("h")).select("_row", "h.*").repartition("_row")
    before = Window.partitionBy("_row", "gen").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.col("gap").cast("bigint") + F.col("n")).over(before), F.lit(0)) + F.col("gap")
    rows = rows.withColumn("start", start).withColumn("end", F.col("start") + F.col("n"))
    rows = rows.withColumn("kind", F.get(F.array(*[F.lit(g.kind) for g in GENERATORS]), F.col("gen")))
    luhn = (F.col("n_digits").between(12, 19)) & passes_luhn(F.col("digits"))
    octets = F.rlike("form", F.lit(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
    rows = rows.withColumn("luhn", luhn).withColumn("octets", octets)
    checks = (
        F.when(F.col("kind") == EMAIL, F.lit(True))
        .when(F.col("kind") == IP, F.col("octets"))
        .when(F.col("kind") == CARD, F.col("luhn"))
        .otherwise(F.col("n_digits").between(9, 15))
    )
    base = F.col("gen").isin([k for k, g in enumerate(GENERATORS) if g.base])
    rows = rows.withColumn("from_base", base).withColumn("accepted", base & checks)

    # Only accepted base spans matter here: those up to a start, and those that begin in the span.
    upto = Window.partitionBy("_row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy("_row").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, -1)
    reach = F.coalesce(F.max(F.when(F.col("accepted"), F.col("end"))).over(upto), F.lit(0))
    following = F.min(F.when(F.col("accepted"), F.col("start"))).over(later)
    same = Window.partitionBy("_row", "kind", "start", "end")
    rows = rows.withColumn("equal", F.max("accepted").over(same))
    rows = rows.withColumn("overlaps", (reach > F.col("start")) | F.coalesce(following < F.col("end"), F.lit(False)))
    label = (
        F.when(F.col("equal"), F.lit(1.0))
        .when(F.col("from_base"), F.lit(0.0))
        .when(reach >= F.col("end"), F.lit(0.0))
    )
    return rows.withColumn("label", label).drop("equal", "i", "gap")


_NEAR = {
    "near_mail": r"(?i)mail|contact|write|courriel|correo|schreib",
    "near_net": r"(?i)\bip\b|host|server|address|adresse|client",
    "near_card": r"(?i)card|visa|credit|karte|carte|tarjeta|iban|account",
    "near_phone": r"(?i)phone|tel|call|mobil|fax|anruf|llam",
}
FEATURES = (
    *[f"is_{k}" for k in KINDS],
    *["n", "n_digits", "n_groups", "n_letters", "n_dots", "last_part", "first_digit", "n_distinct"],
    *["f_luhn", "f_octets", "f_plus", "f_at", "joined_before", "joined_after", "digits_before", "digits_after"],
    *_NEAR,
)


def with_features(rows: DataFrame) -> DataFrame:
    """The numbers that the trees see: the format of the normal form, then the context."""

    def flag(c: Column) -> Column:
        return F.coalesce(c.cast("double"), F.lit(0.0))

    def count(column: str, pattern: str) -> Column:
        return F.length(F.regexp_replace(F.col(column), pattern, "")).cast("double")

    values = {f"is_{name}": flag(F.col("kind") == k) for k, name in enumerate(KINDS)}
    values |= {
        "n": F.least(F.length("form"), F.lit(_SHOWN)).cast("double"),
        "n_digits": F.least("n_digits", F.lit(40)).cast("double"),
        "n_groups": F.size(F.split("form", "[0-9]++")).cast("double") - 1,
        "n_letters": count("form", "[^A-Za-z]"),
        "n_dots": count("form", "[^.]"),
        "last_part": F.length(F.substring_index("form", ".", -1)).cast("double"),
        "first_digit": F.coalesce(F.expr("try_cast(left(digits, 1) AS double)"), F.lit(-1.0)),
        "n_distinct": F.size(F.array_distinct(F.split("digits", ""))).cast("double"),
        "f_luhn": flag(F.col("luhn")),
        "f_octets": flag(F.col("octets")),
        "f_plus": flag(F.startswith("form", F.lit("+"))),
        "f_at": flag(F.contains("form", F.lit("@"))),
        "joined_before": flag(F.rlike("before", F.lit(r"[\p{L}0-9]$"))),
        "joined_after": flag(F.rlike("after", F.lit(r"^[\p{L}0-9]"))),
        "digits_before": count("before", "[^0-9]"),
        "digits_after": count("after", "[^0-9]"),
    }
    around = F.concat_ws(" ", "before", "after")
    values |= {name: flag(F.rlike(around, F.lit(words))) for name, words in _NEAR.items()}
    kept = [c for c in rows.columns if c not in values]
    return rows.select(*kept, *[values[name].alias(f"x_{name}") for name in FEATURES])


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"x_{name}" for name in FEATURES], outputCol="features").transform(rows)


@dataclass
class Model:
    trees: GBTClassificationModel
    thresholds: dict[int, float]  # kinds without one add nothing

    def scored(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``score``, the trees' probability of a true span."""
        judged = self.trees.transform(_assembled(rows))
        return judged.withColumn("score", F.get(vector_to_array("probability"), F.lit(1))).drop(
            "features", "rawPrediction", "probability", "prediction"
        )

    def selected(self) -> Column:
        out = F.lit(False)
        for kind, threshold in self.thresholds.items():
            out = out | ((F.col("kind") == kind) & (F.col("score") >= threshold))
        return out


def labelled(featured: DataFrame) -> DataFrame:
    """All distinct candidates that have a label; ``held_out`` marks those for the thresholds."""
    names = [f"x_{name}" for name in FEATURES]
    whole = ["kind", "label", "form", "before", "after"]
    distinct = stored(featured.filter("label IS NOT NULL").dropDuplicates(whole).select(*whole, *names), "personal-labelled")
    tasks = max(1, -(-distinct.count() // TASK_ROWS))
    marked = distinct.withColumn("held_out", F.pmod(F.xxhash64(F.lit("held out"), *whole), F.lit(HELD_OUT)) == 0)
    # The order makes the sums of a task, and so the trees of one task, the same on every run.
    dealt = marked.repartition(tasks, *whole).sortWithinPartitions(*whole)
    return stored(dealt.select("kind", "label", "held_out", *names), "personal-dealt")


def thresholds(judged: DataFrame) -> dict[int, float]:
    """The threshold of each kind from rows with kind, label and score; kinds without a precise one have none."""
    by_score = judged.groupBy("kind", "score").agg(F.count("*").alias("_n"), F.sum("label").alias("_true"))
    best = [F.desc("score")]
    reached = with_running_total(by_score, ["kind"], best, "_n", "_seen")
    reached = stored(with_running_total(reached, ["kind"], best, "_true", "_found"), "personal-reached")
    precise = (F.col("_true") > 0) & (F.col("_found") / F.col("_seen") >= PRECISION)
    passing = reached.filter(precise).groupBy("kind").agg(F.min("score").alias("low"))
    below = reached.join(F.broadcast(passing), "kind").groupBy("kind", "low").agg(F.max(F.when(F.col("score") < F.col("low"), F.col("score"))).alias("next"))
    # Half way to the best held-out row that must stay out, but never below even odds.
    middle = F.greatest(F.lit(0.5), (F.col("low") + F.coalesce("next", F.lit(0.0))) / 2)
    return {r.kind: r.threshold for r in below.select("kind", middle.alias("threshold")).collect()}  # a row a kind


def fit(featured: DataFrame) -> Model | None:
    """Trees and thresholds, or None where one of the labels has no rows to fit on."""
    rows = labelled(featured)
    if rows.filter("NOT held_out").agg(F.count_distinct("label")).first()[0] < 2:
        return None
    booster = GBTClassifier(labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7)
    model = Model(booster.fit(_assembled(rows.filter("NOT held_out"))), {})
    model.thresholds = thresholds(model.scored(rows.filter("held_out")).select("kind", "label", "score"))
    return model


def find_personal(docs: DataFrame) -> DataFrame:
    """_row, doc_id, base and spans (base and selected ones): arrays of start, kind, end, in
    order; ``kind`` numbers ``KINDS``."""
    found = stored(proposed(docs), "personal-hits")
    judged = stored(with_features(candidates(found)), "personal-candidates")
    span = ["_row", "start", "kind", "end"]
    chosen = judged.filter("accepted").select(*span, F.lit(True).alias("is_base"))
    if model := fit(judged):
        free = model.scored(judged.filter("NOT overlaps")).filter(model.selected())
        # A span inside another selected one is a part of it; of equal ones the best kind stays.
        inside = Window.partitionBy("_row").orderBy("start", F.desc("end"), F.desc("score"), "kind")
        reach = F.max("end").over(inside.rowsBetween(Window.unboundedPreceding, -1))
        free = free.withColumn("reach", reach).filter("reach IS NULL OR reach < end")
        chosen = chosen.unionByName(free.select(*span, F.lit(False).alias("is_base")))
    place = F.struct("start", "kind", "end")
    lists = chosen.groupBy("_row").agg(
        F.sort_array(F.collect_list(F.when(F.col("is_base"), place))).alias("base"), F.sort_array(F.collect_list(place)).alias("spans")
    )
    none = F.array().cast("array<struct<start: bigint, kind: int, end: bigint>>")
    return (
        found.select("_row", "doc_id")
        .join(lists, "_row", "left")
        .select("_row", "doc_id", F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))
    )


def listed(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(spans, lambda p: F.concat_ws(":", F.get(names, p["kind"]), p["start"], p["end"]))
    return F.concat_ws(",", one)


def report(docs: DataFrame) -> DataFrame:
    """A row for each document with counts of the base kinds, their digest, and all spans."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda p: p["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    return find_personal(docs).select(
        "doc_id", *[count(k) for k in range(len(KINDS))], F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans")
    )


def redacted(docs: DataFrame) -> DataFrame:
    """doc_id and text, every span replaced by its kind in brackets; overlapping spans share the first's.

    Null texts become empty. The table is read twice and must give the same rows in the same
    order each time, as files do.
    """
    found = find_personal(docs).select("_row", "spans")
    texts = docs.select(F.monotonically_increasing_id().alias("_row"), "doc_id", text_or_empty().alias("_text"))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def piece(p: Column, i: Column) -> Column:
        """The text between the spans before and this one, and this one's mark."""
        reach = F.coalesce(F.array_max(F.transform(F.slice("spans", 1, i), lambda q: q["end"])), F.lit(0))
        between = F.substring("_text", (reach + 1).cast("int"), (p["start"] - reach).cast("int"))
        return F.when(p["start"] < reach, F.lit("")).otherwise(F.concat(between, F.get(names, p["kind"])))

    last = F.coalesce(F.array_max(F.transform("spans", lambda q: q["end"])), F.lit(0))
    rest = F.substring("_text", (last + 1).cast("int"), F.length("_text"))
    text = F.concat(F.array_join(F.transform("spans", piece), ""), rest)
    return texts.join(found, "_row").select("doc_id", text.alias("text"))
