"""Benchmark decontamination by pigeonhole edit matching.

An item that occurs in a document with at most e edits has, cut into e + 1 pieces, a piece
that occurs unchanged. So every document is searched once for all pieces (a multi-pattern
automaton), each hit names the stretch where the item would lie, and Myers' bit-parallel
algorithm gives the edit distance there. The same argument holds for any run of n pieces, of
which one half or the other keeps within its own budget of one error less than its pieces: so a
hit is verified on growing runs around it, and one by chance ends after a few letters. Nothing is shuffled: items go to the tasks in
blocks of bounded size, and each block is one more search in the same pass.

Texts are compared in lower case with runs of anything but letters and digits as one space.
The error budget is ``rate`` of an item's characters, rounded down.

Defined results: null or empty texts match nothing; items without letters or digits are
skipped; an item too short for any error must occur as whole words; one match an item and
document is returned, the best and then the earliest; documents that repeat give repeated
rows, items that repeat in id and text count once. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import shielded

RATE = 0.1
#: Characters of items in one broadcast block.
BLOCK_CHARS = 4_000_000
_MATCH = "array<struct<item_id: bigint, distance: bigint, start: bigint, end: bigint>>"
_CHARS_AT_ONCE = 4_000_000


def normal(texts: list[str | None]) -> list[str]:
    """Each text in lower case, words parted by one space, and a space at either end."""
    lower = pc.utf8_lower(pa.array(texts, pa.string()).fill_null(""))
    spaced = pc.replace_substring_regex(lower, r"[^\p{L}\p{N}]+", " ")
    return [f" {t.strip(' ')} " for t in spaced.to_pylist()]


class Pattern:
    """An item with what Myers' algorithm needs of it."""

    def __init__(self, item_id: int, text: str, rate: float):
        self.item_id = item_id
        self.budget = int(len(text.strip()) * rate)
        self.text = text.strip() if self.budget else text
        self.top = 1 << (len(self.text) - 1)
        self.full = (1 << len(self.text)) - 1
        self.places: dict[str, int] = {}
        for i, c in enumerate(self.text):
            self.places[c] = self.places.get(c, 0) | 1 << i

    def pieces(self) -> Iterator[tuple[str, int]]:
        n = self.budget + 1
        self.cuts = [len(self.text) * i // n for i in range(n + 1)]
        self.above: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        runs = [(0, n)]
        while runs:
            low, high = runs.pop()
            if high - low > 1:
                middle = (low + high) // 2
                runs += [(low, middle), (middle, high)]
                if high - low < n:
                    for j in range(low, high):
                        self.above[j].append((low, high))
        for own in self.above:
            own.sort(key=lambda r: r[1] - r[0])
        for start, end in zip(self.cuts, self.cuts[1:]):
            yield self.text[start:end], start

    def survives(self, piece: int, text: str, start: int) -> bool:
        """Whether every run of pieces around one that was hit lies there within its budget."""
        for low, high in self.above[piece]:
            first, end, errors = self.cuts[low], self.cuts[high], high - low - 1
            if not self.within(first, end, errors, text[max(0, start + first - errors) : max(0, start + end + errors)]):
                return False
        return True

    def within(self, first: int, end: int, errors: int, window: str) -> bool:
        """Whether a stretch of the window is within so many errors of a part of the item."""
        size = end - first
        full, top, get = (1 << size) - 1, 1 << (size - 1), self.places.get
        pv, mv, score = full, 0, size
        for c in window:
            eq = (get(c, 0) >> first) & full
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (full & ~(xh | pv))
            mh = pv & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
                if score <= errors:
                    return True
            ph <<= 1
            pv = ((mh << 1) | ~(xv | ph)) & full
            mv = ph & xv & full
        return False

    def best(self, window: str) -> tuple[int, int]:
        """Least distance of the item to any stretch of the window, and where the first such ends."""
        pv, mv, score = self.full, 0, len(self.text)
        least, at = score, 0
        for i, c in enumerate(window, 1):
            eq = self.places.get(c, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph = mv | (self.full & ~(xh | pv))
            mh = pv & xh
            if ph & self.top:
                score += 1
            elif mh & self.top:
                score -= 1
                if score < least:
                    least, at = score, i
            ph <<= 1
            pv = ((mh << 1) | ~(xv | ph)) & self.full
            mv = ph & xv & self.full
        return least, at


class Matcher:
    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.patterns = [Pattern(i, t, rate) for i, t in items]
        found: dict[str, list[tuple[int, int, int]]] = {}
        for k, p in enumerate(self.patterns):
            for j, (piece, offset) in enumerate(p.pieces()):
                found.setdefault(piece, []).append((k, offset, j))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in found.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if found:
            self.automaton.make_automaton()

    def matches(self, text: str) -> list[dict]:
        if not self.patterns:
            return []
        where: dict[int, list[tuple[int, int]]] = {}
        for end, (length, uses) in self.automaton.iter(text):
            for k, offset, j in uses:
                where.setdefault(k, []).append((end - length + 1 - offset, j))
        out = []
        for k, hits in where.items():
            if (m := self.verified(self.patterns[k], text, hits)) is not None:
                out.append(m)
        return out

    @staticmethod
    def verified(p: Pattern, text: str, hits: list[tuple[int, int]]) -> dict | None:
        """The best stretch near any of the places where the item may start, given with the piece hit."""
        size, slack = len(p.text), p.budget
        least, span = slack + 1, (0, 0)
        for s in sorted({s for s, _ in hits}):
            if s >= 0 and text.startswith(p.text, s):
                return {"item_id": p.item_id, "distance": 0, "start": s, "end": s + size}
        starts = sorted({s for s, j in hits if p.survives(j, text, s)})
        i = 0
        while i < len(starts) and slack:
            low = high = starts[i]
            while i < len(starts) and starts[i] - high <= slack:
                high = starts[i]
                i += 1
            begin = max(0, low - slack)
            distance, end = p.best(text[begin : high + size + slack])
            if distance < least:
                least, span = distance, (max(0, begin + end - size), begin + end)
        if least > slack:
            return None
        return {"item_id": p.item_id, "distance": least, "start": span[0], "end": span[1]}


def _search(docs: DataFrame, items: list[tuple[int, str]], rate: float, text: str) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(items)  # about BLOCK_CHARS / 2 characters

    @F.pandas_udf(_MATCH)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shared.value, rate)
        for batch in batches:
            found, group, size = [], [], 0
            for value in [*batch, None]:
                group.append(value)
                size += len(value or "")
                if size > _CHARS_AT_ONCE or len(found) + len(group) > len(batch):
                    found += [matcher.matches(t) for t in normal(group)]
                    group, size = [], 0
            yield pd.Series(found[: len(batch)])

    return search(text)


def with_matches(
    docs: DataFrame, items: DataFrame, rate: float = RATE, text: str = "text", into: str = "matches"
) -> DataFrame:
    """``docs`` with an array of the items that occur in each: item_id, distance, start, end.

    Places are in the text as compared. Items come in blocks, so their number is unbounded.
    """
    words = F.col("text").rlike(r"[\p{L}\p{N}]")
    chosen = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter(words).distinct()
    total = chosen.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = 2 * total // BLOCK_CHARS + 1  # half full on average, as items are dealt by hash
    found = []
    for k in range(blocks):
        rows = chosen.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        found.append(_search(docs, list(zip([r.item_id for r in rows], normal([r.text for r in rows]))), rate, text))
    return docs.withColumn(into, F.concat(*found) if len(found) > 1 else found[0])


def contaminated(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """A row for each item that occurs in a document: doc_id, item_id, distance, start, end."""
    found = with_matches(docs.select("doc_id", "text"), items, rate)
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def decontaminated(docs: DataFrame, items: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of ``docs`` in which no item occurs."""
    docs, named = shielded(docs)
    return named(with_matches(docs, items, rate, into="_matches").filter(F.size("_matches") == 0).drop("_matches"))
