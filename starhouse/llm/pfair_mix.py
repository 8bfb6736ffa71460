"""Mixing sources to target weights by Pfair scheduling.

Every source is dealt into blocks of rows. The j-th block of a source with weight w may go
out from slot floor((j - 1) / w) on and must be out by slot ceil(j / w), where w is its share of
the weights: then at any slot each source has had its share of the slots to within less than one
block. When sources run out, the others share on by their weights (a new phase, whose windows
start anew), until all rows are out: none is dropped or repeated.

There is one schedule for any number of sources and any weights. Sources of equal weight and
equal number of blocks are a class: they run out together, which ends the phase, and the turns of
a class go round among them, which keeps each within one block where its class is. ``tempered``
weights follow from the rows of a source, and different numbers of rows add up, so classes are
at most the square root of twice the rows, however many sources there are. The driver deals the
turns of the classes (``turns``), one after the other: it holds a row a class, the windows of one
phase and a batch of turns. Of a phase longer than the period of its weights it deals one period
and what is left over. Sources and rows are numbered and joined with the turns by Spark.

Rows are numbered within their source by a range partition and one offset a range, so a source
with most of the rows is spread over tasks like any other.

Defined results: a null source is a source of its own; within a source rows are ordered by a
hash of the id, then id and text; equal rows follow each other; an empty table gives an
empty result. Columns named like the added ones (slot, block, place) are replaced.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import batched, chain, islice
from operator import index

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starhouse.llm.common import shielded, stored, text_or_empty
from starhouse.operators.ordering import with_global_index
from starhouse.scratch import scratch_path

BLOCK_ROWS = 16
#: Weight of a source of one row; as whole parts, weights have periods.
PARTS = 16
#: Up to so many sources what is known of each is broadcast; results do not depend on it.
MAX_SOURCES = 1000
#: Periods are taken together up to so many slots, so that few numbers say how often they return.
_PERIOD_SLOTS = 4096
#: Turns that the driver holds at a time.
_BATCH = 500_000
#: monotonically_increasing_id keeps the partition number above the low 33 bits.
_ROW_BITS = 33
_NEVER = 1 << 60
_CLASS = ["_part", "_blocks"]
_TURNS = [*_CLASS, "_turn", "_step", "slot", "_period", "_repeats"]


def tempered(counts: Mapping[str | None, int], parts: int = PARTS) -> dict[str | None, int]:
    """Target parts by the square root of a source's rows, whatever other sources there are."""
    return {s: max(1, round(parts * n**0.5)) for s, n in counts.items()}


class _Room:
    """How many slots up to each deadline are not needed by blocks that are due by then."""

    def __init__(self, due: Sequence[int]):
        """``due[d]`` blocks are due by slot d, for d from 1 on."""
        self.size = 1 << max(1, len(due) - 1).bit_length()
        total = np.zeros(2 * self.size, dtype=np.int64)
        least = np.full(2 * self.size, _NEVER)
        total[self.size : self.size + len(due)] = 1 - np.array(due)
        total[self.size] = 0
        least[self.size + 1 : self.size + len(due)] = total[self.size + 1 : self.size + len(due)]
        half = self.size // 2
        while half:
            left, right = slice(2 * half, 4 * half, 2), slice(2 * half + 1, 4 * half, 2)
            total[half : 2 * half] = total[left] + total[right]
            least[half : 2 * half] = np.minimum(least[left], total[left] + least[right])
            half //= 2
        self.total, self.least = total.tolist(), least.tolist()

    def put(self, at: int, free: int, least: int) -> None:
        total, low = self.total, self.least
        at += self.size
        total[at], low[at] = free, least
        at >>= 1
        while at:
            left = 2 * at
            total[at] = total[left] + total[left + 1]
            low[at] = min(low[left], total[left] + low[left + 1])
            at >>= 1

    def pass_slot(self, slot: int) -> None:
        """All that is due by this slot is out."""
        self.put(slot, 0, _NEVER)

    def serve(self, deadline: int) -> None:
        free = self.total[self.size + deadline] + 1
        self.put(deadline, free, free)

    def tight(self) -> int:
        """The first deadline up to which every slot is needed."""
        if self.least[1] > 0:
            return _NEVER
        at, before = 1, 0
        while at < self.size:
            at *= 2
            if before + self.least[at] > 0:
                before += self.total[at]
                at += 1
        return at - self.size


def turns(classes: Sequence[tuple[int, int]]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Which class has which slot, from the weight and the number of blocks of each class.

    An item says that the turns ``turn``, ``turn + step``, ... of a class, as many as ``repeats``,
    have the slots ``slot``, ``slot + period``, ...: (class, turn, step, slot, period, repeats).
    Of the released blocks those that a fluid schedule over all phases would have begun go first,
    the one it would have out first before others, so that not every phase begins with the heavy
    classes. Where that would take a slot which later windows need, the block due first goes.
    """
    weight, left = [w for w, _ in classes], [n for _, n in classes]
    order = sorted((-w, i) for i, w in enumerate(weight))
    # The fluid schedule has sent ``sent[k]`` blocks at ``clock[k]``, and ``rate[k]`` a unit from there.
    clock, sent, rate = [0.0], [0.0], [sum(weight)]
    for until, w in sorted((n / w, w) for w, n in classes):
        sent.append(sent[-1] + (until - clock[-1]) * rate[-1])
        clock.append(until)
        rate.append(rate[-1] - w)
    done, base, k = [0] * len(classes), 0, 0
    # Released blocks, by when the fluid schedule begins them, and those begun, by when it has them out.
    waiting = [(0.0, i, 0) for i in range(len(classes))]
    begun: list[tuple[float, int, int]] = []
    while order:
        active = [i for _, i in order]
        common = math.gcd(*(weight[i] for i in active))
        part = {i: weight[i] // common for i in active}
        total = sum(part.values())
        together = -(-_PERIOD_SLOTS // total)
        repeats = min((left[i] - 1) // (part[i] * together) for i in active)
        # Without a whole period, the phase ends by the first slot by which all of a class must be out.
        end = total * together if repeats else min(-(-left[i] * total // part[i]) for i in active)
        due, urgent = [0] * (end + 1), []
        for i in active:
            if part[i] * end < total:
                break
            urgent.append((-(-total // part[i]), i, done[i]))
            for j in range(1, part[i] * end // total + 1):
                due[-(-j * total // part[i])] += 1
        heapq.heapify(urgent)
        room = _Room(due)
        had: dict[int, int] = {}
        later: list[tuple[int, int]] = []
        slot, out = 0, None
        while out is None and not (repeats and slot == end):
            while later and later[0][0] <= slot:
                i = heapq.heappop(later)[1]
                heapq.heappush(waiting, (done[i] / weight[i], i, done[i]))
                if (deadline := -(-(had[i] + 1) * total // part[i])) <= end:
                    heapq.heappush(urgent, (deadline, i, done[i]))
            while k + 2 < len(sent) and base + slot >= sent[k + 1]:
                k += 1
            now = (clock[k] + (base + slot - sent[k]) / rate[k]) * (1 + 1e-12)
            while waiting and (waiting[0][0] <= now or waiting[0][2] != done[waiting[0][1]]):
                _, i, n = heapq.heappop(waiting)
                if n == done[i]:
                    heapq.heappush(begun, ((n + 1) / weight[i], i, n))
            while begun and begun[0][2] != done[begun[0][1]]:
                heapq.heappop(begun)
            i = (begun or waiting)[0][1]
            deadline = -(-(had.get(i, 0) + 1) * total // part[i])
            if deadline > room.tight():
                while urgent[0][2] != done[urgent[0][1]]:
                    heapq.heappop(urgent)
                deadline, i, _ = urgent[0]
            if deadline <= end:
                room.serve(deadline)
            yield i, done[i], part[i] * together if repeats else 0, base + slot, end if repeats else 0, max(1, repeats)
            slot += 1
            room.pass_slot(slot)
            done[i] += 1
            left[i] -= 1
            had[i] = had.get(i, 0) + 1
            if left[i]:
                heapq.heappush(later, (had[i] * total // part[i], i))
            else:
                out = i
        if repeats:
            base += end * repeats
            for i in active:
                more = (repeats - 1) * part[i] * together
                done[i] += more
                left[i] -= more
            waiting, begun = sorted((done[i] / weight[i], i, done[i]) for i in active), []
        else:
            base += slot
            del order[bisect_left(order, (-weight[out], out))]
            done[out] = -1
            for _, i in later:
                heapq.heappush(waiting, (done[i] / weight[i], i, done[i]))


def period(parts: Mapping[str | None, int]) -> dict[str | None, list[int]]:
    """The slots of each source in one period of its parts."""
    names = sorted(parts, key=lambda s: (s is not None, s))
    slots: dict[str | None, list[int]] = {s: [] for s in names}
    endless = turns([(parts[s], parts[s] * _PERIOD_SLOTS + 1) for s in names])
    for i, _, _, slot, _, _ in islice(endless, sum(parts.values())):
        slots[names[i]].append(slot)
    return slots


def _dealt(classes: DataFrame) -> DataFrame:
    """The turns of classes with these weights, numbers of blocks and numbers of sources.

    A row a class is collected; the turns are written as they come, ``_BATCH`` at a time.
    """
    spark = classes.sparkSession
    path = scratch_path(spark, "mix-turns")
    chosen = sorted(map(tuple, classes.select(*_CLASS, "_members").collect()))
    batches = batched(turns([(part * members, blocks * members) for part, blocks, members in chosen]), _BATCH)
    for some in chain([next(batches, ())], batches):
        columns = list(zip(*((*chosen[i][:2], *rest) for i, *rest in some))) or [()] * len(_TURNS)
        arrays = [pa.array(c, pa.int64()) for c in columns]
        spark.createDataFrame(pa.table(arrays, names=_TURNS)).write.mode("append").parquet(path)
    return spark.read.schema(", ".join(f"{c} bigint" for c in _TURNS)).parquet(path)


def mixed(
    docs: DataFrame,
    targets: Callable[[Mapping[str | None, int]], Mapping[str | None, int]] = tempered,
    block_rows: int = BLOCK_ROWS,
    text: str | None = None,
) -> DataFrame:
    """``docs`` with its slot in the mix, its block within the source, and its place in the block.

    ``targets`` maps the rows of each source to whole parts. ``text`` names a column that
    orders rows of equal id. ``tempered`` targets are found by Spark; others are called with a
    mapping of all sources.
    """
    last = [F.xxhash64(text_or_empty(text))] if text else []
    order = [F.col("source"), F.xxhash64("doc_id"), F.col("doc_id"), *last]
    rows, named = shielded(docs.drop("slot", "block", "place"))
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = stored(ordered.withColumn("_row", F.monotonically_increasing_id()), "mix-order")
    ordered = ordered.withColumn("_range", F.shiftright("_row", _ROW_BITS)).withColumn("_none", F.col("source").isNull())
    ordered = ordered.withColumn("_key", F.coalesce("source", F.lit("")))

    # At most one row a range partition and one more a source.
    pieces = ordered.groupBy("_range", "_none", "_key").agg(F.min("_row").alias("_start"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("_none", "_key").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    pieces = stored(pieces.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))), "mix-pieces")
    sources = pieces.groupBy("_none", "_key").agg(F.sum("_n").alias("_n"))
    if targets is tempered:
        sources = sources.withColumn("_part", F.round(F.sqrt("_n") * PARTS).cast("bigint"))
    else:
        rows_of = {None if r["_none"] else r["_key"]: r["_n"] for r in sources.collect()}
        parts = targets(rows_of)
        weighed = [(s is None, s or "", index(parts[s])) for s in rows_of]
        weights = docs.sparkSession.createDataFrame(weighed, "_none boolean, _key string, _part bigint")
        sources = sources.join(weights, ["_none", "_key"])
    sources = sources.withColumn("_blocks", F.expr(f"(_n + {block_rows - 1}) div {block_rows}")).drop("_n")
    sources = with_global_index(sources, [*_CLASS, "_none", "_key"], "_nth")
    classes = stored(sources.groupBy(*_CLASS).agg(F.min("_nth").alias("_from"), F.count("*").alias("_members")), "mix-classes")
    members = stored(sources.join(classes, _CLASS), "mix-members")

    again = _dealt(classes).repartition(*_CLASS, "_turn").withColumn("_again", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_repeats") - 1)))
    slots = again.select(
        *_CLASS, (F.col("_turn") + F.col("_again") * F.col("_step")).alias("_turn"), (F.col("slot") + F.col("_again") * F.col("_period")).alias("slot")
    )

    pieces = pieces.drop("_n").join(members, ["_none", "_key"])
    # Pieces are as many as ranges and sources: few enough for every task where sources are few.
    few = members.limit(MAX_SOURCES + 1).count() <= MAX_SOURCES
    numbered = ordered.join(F.broadcast(pieces) if few else pieces, ["_range", "_none", "_key"])
    numbered = numbered.withColumn("_index", F.col("_row") - F.col("_start") + F.col("_before"))
    numbered = numbered.withColumn("block", F.expr(f"_index div {block_rows}")).withColumn("place", F.col("_index") % block_rows)
    numbered = numbered.withColumn("_turn", F.col("block") * F.col("_members") + F.col("_nth") - F.col("_from"))
    return named(numbered.join(stored(slots, "mix-slots"), [*_CLASS, "_turn"]).select(*rows.columns, "block", "place", "slot"))
