"""Secret scans: strong patterns alone, weak ones only where complementary parts meet.

Three kinds are reported wherever they occur: assignments to a secret-like name, access key
ids, and long hexadecimal strings. Weak candidates - a name of a user or client, a mixed
string that may be a key, an address - are frequent and mostly harmless. They are reported
when the other parts of a credential lie within the same scope: an identifier near a secret,
a mixed string near an identifier, an address near both.

Parts are found in one pass over each text. The linking is an interval join by bins as wide
as the scope: a bin holds the first and the last place of each role, and a candidate looks at
its own bin and the two beside it, which decides exactly whether a part lies within the
scope. So a text full of parts makes three rows for each of them, never pairs.

Places are code points, the end exclusive. Defined results: null is empty text; rows that
agree in id and text get equal results each. Parts are complementary only as different pieces of
the text: a string inside an address or an identifier's value belongs to it, and no part
completes one that it overlaps. Only doc_id and text are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import document_key, stored, text_or_empty

#: Code points within which parts belong to one credential.
SCOPE = 400
#: Kinds in the order in which spans that start together are listed; the first three are strong.
KINDS = ("assign", "access", "hex", "id", "blob", "endpoint")
STRONG = 3
IDENTIFIER, SECRET, ENDPOINT = range(3)
#: Weak kinds in the order in which they take text that several match: an address, a name, a string.
_TAKES_FIRST = (5, 3, 4)
_ROLE = {"assign": SECRET, "access": IDENTIFIER, "hex": SECRET, "id": IDENTIFIER, "blob": SECRET, "endpoint": ENDPOINT}

# Fixed patterns of the strong kinds.
_ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_MIN_ASSIGN = 6

_ID = re.compile(
    r"""(?:access_?key_?id|client_?id|user_?name|user_?id|login|account)["']?\x20*[:=]\x20*["']?[\w.@-]{4,}""",
    re.ASCII | re.IGNORECASE,
)
_BLOB = re.compile(r"[A-Za-z0-9+/_-]{20,}")
_ENDPOINT = re.compile(r"""(?:https?|jdbc:\w+|postgres|mysql|mongodb|redis|amqp)://[^\s"'<>]{4,}""", re.ASCII)

_PLAIN = {"access": _ACCESS, "hex": _HEX, "id": _ID, "endpoint": _ENDPOINT}

#: What a text must hold for the search of a kind to be worth while (a superset, tested natively).
_HINTS = {
    "assign": r"(?i)password|passwd|secret|token|api_?key",
    "access": r"AKIA[A-Z0-9]",
    "hex": r"[0-9a-f]{24}",
    "id": r"(?i)access_?key_?id|client_?id|user_?name|user_?id|login|account",
    "blob": r"[A-Za-z0-9+/_-]{20}",
    "endpoint": r"://",
}

_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()), ("links", pa.bool_())])
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("_doc", pa.binary()), ("spans", pa.list_(_SPAN))])
_DDL = "doc_id bigint, _doc binary, spans array<struct<start: bigint, kind: int, end: bigint, links: boolean>>"


def _found(kind: str, text: str) -> Iterator[tuple[int, int]]:
    if kind == "assign":
        return (m.span() for m in _ASSIGN.finditer(text) if len(m[1]) >= _MIN_ASSIGN)
    if kind == "blob":
        mixed = (r"[A-Z]", r"[a-z]", r"[0-9]")
        return (m.span() for m in _BLOB.finditer(text) if all(re.search(p, m[0]) for p in mixed))
    return (m.span() for m in _PLAIN[kind].finditer(text))


def parts(text: str, kinds: tuple[str, ...] = KINDS) -> list[dict]:
    """All strong spans and the weak ones that are parts of their own, by start and kind.

    ``links`` marks those that may complete a credential. They never overlap: what lies in a
    strong span belongs to it, then in an address, then in a named identifier.
    """
    spans = [(s, k, e) for k, name in enumerate(KINDS) if name in kinds for s, e in _found(name, text)]
    taken: list[tuple[int, int]] = []  # disjoint, in order
    out = []
    for group in (KINDS[:STRONG], *((KINDS[k],) for k in _TAKES_FIRST)):
        for s, k, e in sorted(x for x in spans if KINDS[x[1]] in group):
            i = bisect_left(taken, (s, e))
            free = (i == 0 or taken[i - 1][1] <= s) and (i == len(taken) or taken[i][0] >= e)
            if free:
                taken.insert(i, (s, e))
            if free or k < STRONG:
                out.append((s, k, e, free))
    return [{"start": s, "kind": k, "end": e, "links": free} for s, k, e, free in sorted(out)]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("_text")
        wanted: dict[int, list[str]] = {}
        for kind, hint in _HINTS.items():
            for i in pc.indices_nonzero(pc.match_substring_regex(texts, hint)).to_pylist():
                wanted.setdefault(i, []).append(kind)
        spans = [parts(texts[i].as_py(), tuple(wanted[i])) if i in wanted else [] for i in range(len(texts))]
        columns = [batch.column("doc_id"), batch.column("_doc"), pa.array(spans, pa.list_(_SPAN))]
        yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _linked(found: DataFrame, scope: int) -> DataFrame:
    """The weak parts that complementary ones accompany: _doc, linked (an array of spans)."""
    roles = F.array(*[F.lit(_ROLE[k]) for k in KINDS])
    rows = found.select("_doc", F.explode(F.filter("spans", lambda p: p["links"])).alias("p"))
    rows = rows.select("_doc", "p.start", "p.kind", "p.end").distinct()
    rows = rows.withColumn("role", F.get(roles, F.col("kind"))).withColumn("bin", F.expr(f"start div {scope}"))
    edges = []
    for role in range(3):
        place = F.when(F.col("role") == role, F.col("start"))
        edges += [F.min(place).alias(f"first{role}"), F.max(place).alias(f"last{role}")]
    bins = rows.groupBy("_doc", "bin").agg(*edges)
    weak = rows.filter(F.col("kind") >= STRONG).withColumn("aside", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))))
    weak = weak.withColumn("bin", F.col("bin") + F.col("aside"))

    def near(role: int) -> Column:
        """A part in the candidate's bin is near; beside it, the one at the facing edge decides."""
        before = (F.col("aside") == -1) & (F.col(f"last{role}") >= F.col("start") - scope)
        after = (F.col("aside") == 1) & (F.col(f"first{role}") <= F.col("start") + scope)
        inside = (F.col("aside") == 0) & F.col(f"first{role}").isNotNull()
        return F.max(F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False)) | inside)

    met = (
        weak.join(bins, ["_doc", "bin"])
        .groupBy("_doc", "start", "kind", "end")
        .agg(*[near(role).alias(f"near{role}") for role in range(3)])
    )
    identifier, secret = F.col(f"near{IDENTIFIER}"), F.col(f"near{SECRET}")
    complete = (
        ((F.col("kind") == KINDS.index("id")) & secret)
        | ((F.col("kind") == KINDS.index("blob")) & identifier)
        | ((F.col("kind") == KINDS.index("endpoint")) & identifier & secret)
    )
    return met.filter(complete).groupBy("_doc").agg(F.collect_list(F.struct("start", "kind", "end")).alias("linked"))


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, base (strong spans), spans (with linked weak ones): arrays of start, kind, end,
    in order; ``kind`` numbers ``KINDS``."""
    read = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        document_key(text_or_empty()).alias("_doc"),
        text_or_empty().alias("_text"),
    )
    found = stored(read.mapInArrow(_scan, _DDL), "secret-parts")
    strong = F.filter("spans", lambda p: p["kind"] < STRONG)
    base = F.transform(strong, lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end")))
    linked = F.coalesce(F.col("linked"), F.slice(base, 1, 0))
    return (
        found.join(_linked(found, scope), "_doc", "left")
        .select("doc_id", base.alias("base"), F.sort_array(F.concat(base, linked)).alias("spans"))
    )


def listed(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(spans, lambda p: F.concat_ws(":", F.get(names, p["kind"]), p["start"], p["end"]))
    return F.concat_ws(",", one)


def report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """A row for each document with counts of the strong kinds, their digest, and all spans."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda p: p["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(k) for k in range(STRONG)]
    return find_secrets(docs, scope).select(
        "doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans")
    )
