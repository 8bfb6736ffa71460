"""Near-duplicate classes by DartMinHash signatures and a banded join.

A document is a weighted set: its five-word shingles weighted by how often they occur. Each
element owns a region of the (weight, rank) plane as wide as its weight. Darts are thrown
into the regions by hashing alone - a Poisson process for each unit of weight, seeded by
element and layer, so equal regions receive equal darts in every document - and each dart
names one of K coordinates. A document looks at ranks up to (K ln K + 2K) / total weight,
which gives it about that many darts however long it is; the earliest dart of a coordinate
is its signature there (documents with an empty coordinate look further). Two signatures
agree at a coordinate with the probability of the weighted Jaccard similarity.

Bands of coordinates are joined. To keep a bucket of n texts from becoming n**2 pairs,
each member is first compared with its bucket's hub (the member that shares most buckets
with others), and exact similarity of the whole texts makes links and classes of them. What
then remains are pairs in one bucket but in different classes. Buckets that hold such are cut
into blocks of bounded size, and each pair of blocks is compared in a task of its own, which
returns links only: all pairs whose signatures allow the threshold (within 3.5 standard
errors) are compared exactly. Pairs within a class are not needed, as they cannot change it.

Defined results: equal texts are one class (null counts as empty text); texts of one to four
words are one shingle; texts without words are similar to equal texts only. Words are runs of
ASCII letters and digits and of any other characters beyond ASCII, in lower case. A class is
named by its smallest doc_id (null only where all its ids are null). Rows that repeat are
members of their class like others. Extra columns are ignored by ``classes`` and kept by
``deduplicated``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starhouse.llm.common import shielded, stored, text_or_empty

WORDS = 5
THRESHOLD = 0.8
ROWS, BANDS = 5, 32
COORDINATES = ROWS * BANDS
#: Four bits of each coordinate, sixteen coordinates in one long, bound the similarity of a pair.
_LONGS = COORDINATES // 16
_NIBBLES = 0x1111111111111111
_CHARS_AT_ONCE = 500_000
#: Texts of a bucket that are compared with each other in one task come in blocks of this size.
BLOCK_TEXTS = 1_000
BLOCK_CHARS = 16_000_000
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose bits all depend on each other (splitmix64's finish)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_WORD_BYTES = np.array([i >= 128 or chr(i).isalnum() for i in range(256)])


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, as far as a batch needs them."""

    up = down = np.ones(1, _U)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            inverse = pow(_BASE, -1, 1 << 64)
            for name, base in (("up", _BASE), ("down", inverse)):
                factors = np.full(n, base, _U)
                factors[0] = 1
                setattr(cls, name, np.cumprod(factors, dtype=_U))
        return cls.up, cls.down


def elements(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit-weight elements of each text: element hash, owner, and which are a first occurrence.

    The m-th occurrence of a shingle in a text is the shingle's m-th layer of weight. Rows are
    ordered by owner. All hashing runs over the bytes of the whole batch at once.
    """
    lower = pc.utf8_lower(pc.cast(texts, pa.large_string()))
    offsets = np.frombuffer(lower.buffers()[1], np.int64)[lower.offset : lower.offset + len(lower) + 1]
    data = lower.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    word = _WORD_BYTES[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    starts = np.flatnonzero(word & (cut[:-1] | ~np.append(False, word[:-1])))
    ends = np.flatnonzero(word & (cut[1:] | ~np.append(word[1:], False))) + 1
    up, down = _Powers.upto(len(raw) + 1)
    prefix = np.concatenate([np.zeros(1, _U), np.cumsum((raw.astype(_U) + _U(1)) * up[: len(raw)], dtype=_U)])
    words = _mix((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(_U))
    owner = np.searchsorted(offsets, starts, side="right") - 1
    count = np.bincount(owner, minlength=len(lower))
    first = np.cumsum(count) - count
    shingle = np.zeros(len(words), _U)
    padded = np.concatenate([words, np.zeros(WORDS, _U)])
    left = np.repeat(first + count, count) - np.arange(len(words))
    for j in range(WORDS):
        power = _U(pow(0xD1342543DE82EF95, j, 1 << 64))
        shingle += np.where(left > j, padded[j : j + len(words)], _U(0)) * power
    # Whole windows, and for a text of fewer words the one from its first word.
    keep = (left >= WORDS) | ((np.repeat(count, count) < WORDS) & (np.arange(len(words)) == np.repeat(first, count)))
    shingle, owner = _mix(shingle[keep]), owner[keep]
    own = _mix(shingle ^ _mix(owner.astype(_U) + _U(1)))
    order = np.argsort(own, kind="stable")
    new = np.append(True, own[order][1:] != own[order][:-1])[: len(order)]
    run = np.flatnonzero(new)
    layer = np.empty(len(order), np.int64)
    layer[order] = np.arange(len(order)) - np.repeat(run, np.diff(np.append(run, len(order))))
    return _mix(shingle + _U(0xA0761D6478BD642F) * layer.astype(_U)), owner, layer == 0


def signatures(seeds: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """Earliest dart of each coordinate, (n_texts, COORDINATES); rows without elements are zero."""
    best = np.full(n_texts * COORDINATES, ~_U(0), _U)
    weight = np.bincount(owner, minlength=n_texts)
    reach = COORDINATES * math.log(COORDINATES) + 2 * COORDINATES
    while len(seeds):
        limit = (reach / np.maximum(weight, 1)).astype(np.float32)
        live, own, rank = seeds, owner, np.zeros(len(seeds), np.float32)
        throw = 0
        while len(live):
            throw += 1
            dart = _mix(live + _U(throw * 0x9E3779B97F4A7C15 % (1 << 64)))
            rank = rank - np.log(((dart >> _U(40)).astype(np.float32) + np.float32(0.5)) / np.float32(1 << 24))
            hit = rank < limit[own]
            live, own, rank, dart = live[hit], own[hit], rank[hit], _mix(dart[hit])
            place = own * COORDINATES + ((dart >> _U(32)) % _U(COORDINATES)).astype(np.int64)
            key = (rank.view(np.uint32).astype(_U) << _U(32)) | (dart & _U(0xFFFFFFFF))
            np.minimum.at(best, place, key)
        open_ = ((best.reshape(n_texts, COORDINATES) == ~_U(0)).any(axis=1) & (weight > 0))[owner]
        seeds, owner = seeds[open_], owner[open_]
        reach *= 2
    best = best.reshape(n_texts, COORDINATES)
    best[weight == 0] = 0
    return best


def bands_and_bits(signature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mixed = _mix(signature)
    band = np.zeros((len(signature), BANDS), _U)
    for r in range(ROWS):
        band = _mix(band * _U(0xD1342543DE82EF95) + mixed[:, r::ROWS])
    band = _mix(band + np.arange(BANDS, dtype=_U))
    nibbles = (mixed & _U(15)).reshape(len(signature), _LONGS, 16)
    return band.view(np.int64), (nibbles << (_U(4) * np.arange(16, dtype=_U))).sum(axis=2, dtype=_U).view(np.int64)


def _spans(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of bounded total length; a longer text stands alone."""
    start = total = 0
    for i, n in enumerate(lengths):
        if total and total + n > _CHARS_AT_ONCE:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


_SIGNED = "_node binary, _id string, _bands array<bigint>, _bits array<bigint>, _chars bigint"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    many = pa.list_(pa.int64())
    schema = pa.schema(
        [("_node", pa.binary()), ("_id", pa.string()), ("_bands", many), ("_bits", many), ("_chars", pa.int64())]
    )
    for batch in batches:
        texts = batch.column("_text")
        for start, end in _spans(pc.binary_length(texts).to_numpy()):
            seeds, owner, _ = elements(texts.slice(start, end - start))
            band, bits = bands_and_bits(signatures(seeds, owner, end - start))
            real = np.bincount(owner, minlength=end - start) > 0
            columns = [batch.column(c).slice(start, end - start).filter(pa.array(real)) for c in ("_node", "_id")]
            for values in (band[real], bits[real]):
                lists = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
                columns.append(pa.ListArray.from_arrays(pa.array(lists), pa.array(values.ravel())))
            columns.append(pc.cast(pc.binary_length(texts.slice(start, end - start)), pa.int64()).filter(pa.array(real)))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


@F.arrow_udf(T.BooleanType())
def _alike(left: pa.Array, right: pa.Array) -> pa.Array:
    """Whether the weighted or the plain Jaccard similarity of the shingles reaches the threshold."""
    return pa.array(similarities(left.to_pylist(), right.to_pylist()) >= THRESHOLD)


class Shingled:
    """The elements of some texts, for exact similarities between them."""

    def __init__(self, texts: list[str]):
        self.all: list[np.ndarray] = []
        self.once: list[np.ndarray] = []
        for start, end in _spans(np.array([len(t) for t in texts])):
            seeds, owner, first = elements(pa.array(texts[start:end], pa.string()))
            ends = np.cumsum(np.bincount(owner, minlength=end - start))
            for i, j in zip(np.append(0, ends[:-1]), ends):
                self.all.append(seeds[i:j])
                self.once.append(seeds[i:j][first[i:j]])

    @staticmethod
    def _jaccard(x: np.ndarray, y: np.ndarray) -> float:
        if min(len(x), len(y)) < THRESHOLD * max(len(x), len(y), 1):
            return 0.0
        shared = len(np.intersect1d(x, y, assume_unique=True))
        return shared / (len(x) + len(y) - shared)

    def similarity(self, i: int, j: int) -> float:
        """Weighted or plain Jaccard, the larger; exact where it reaches the threshold."""
        weighted = self._jaccard(self.all[i], self.all[j])
        repeats = len(self.all[i]) > len(self.once[i]) or len(self.all[j]) > len(self.once[j])
        return max(weighted, self._jaccard(self.once[i], self.once[j])) if repeats else weighted


def similarities(left: list[str], right: list[str]) -> np.ndarray:
    best = np.zeros(len(left))
    for start, end in _spans(np.array([len(a) + len(b) for a, b in zip(left, right)])):
        both = Shingled(left[start:end] + right[start:end])
        best[start:end] = [both.similarity(i, i + end - start) for i in range(end - start)]
    return best


_LINK = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _linked_blocks(key: tuple, rows: pa.Table) -> pa.Table:
    """Links between texts of different classes within a block of a bucket, or between two blocks.

    A pair is taken in the first band that it shares. Likelier pairs come first, and those
    whose classes have been joined by then are left out, since they change nothing.
    """
    band, i, j = (k.as_py() for k in key)
    nodes, classes, block = (rows.column(c).to_pylist() for c in ("_node", "_class", "_block"))
    bands = np.array(rows.column("_bands").to_pylist(), np.int64)
    bits = np.array(rows.column("_bits").to_pylist(), np.int64).view(_U)
    nibbles = ((bits[:, :, None] >> (_U(4) * np.arange(16, dtype=_U))) & _U(15)).astype(np.uint8).reshape(len(nodes), -1)
    names, kind = np.unique(np.array(classes, dtype="S16"), return_inverse=True)
    left = [n for n, own in enumerate(block) if own == i]
    right = np.array([n for n, own in enumerate(block) if own == j])
    found = []
    for u in left:
        others = right[(right > u) & (kind[right] != kind[u])] if i == j else right[kind[right] != kind[u]]
        agree = (nibbles[others] == nibbles[u]).sum(axis=1)
        others, agree = others[agree >= _least_agreeing()], agree[agree >= _least_agreeing()]
        if len(others):
            first = (bands[others] == bands[u]).argmax(axis=1)
            here = bands[u][first] == band
            found += zip(-agree[here], [u] * int(here.sum()), others[here])
    parent = list(range(len(names)))

    def root(n: int) -> int:
        while parent[n] != n:
            n = parent[n]
        return n

    links, texts = [], None
    for _, u, v in sorted(found):
        if root(kind[u]) != root(kind[v]):
            texts = texts or Shingled(rows.column("_text").to_pylist())
            if texts.similarity(u, v) >= THRESHOLD:
                parent[root(kind[u])] = root(kind[v])
                links.append({"a": nodes[u], "b": nodes[v]})
    return pa.Table.from_pylist(links, schema=_LINK)


def _node() -> Column:
    return F.unhex(F.md5(text_or_empty()))


def _id() -> Column:
    """The id as a column that is never null, for joins that spread the copies of a text."""
    return F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))


def _agreeing(a: str, b: str) -> Column:
    """Coordinates whose four bits agree."""
    differing = F.lit(0)
    for i in range(_LONGS):
        x = F.get(f"{a}._bits", F.lit(i)).bitwiseXOR(F.get(f"{b}._bits", F.lit(i)))
        x = x.bitwiseOR(F.shiftright(x, 2))
        x = x.bitwiseOR(F.shiftright(x, 1))
        differing = differing + F.bit_count(x.bitwiseAND(F.lit(_NIBBLES)))
    return F.lit(COORDINATES) - differing


def _least_agreeing() -> int:
    p = THRESHOLD + (1 - THRESHOLD) / 16
    return math.floor(COORDINATES * p - 3.5 * math.sqrt(COORDINATES * p * (1 - p)))


def _linked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of candidate pairs (a, b), those whose texts are alike."""
    left = texts.select(F.col("_node").alias("a"), F.col("_text").alias("_ta"))
    right = texts.select(F.col("_node").alias("b"), F.col("_text").alias("_tb"))
    return pairs.join(left, "a").join(right, "b").filter(_alike("_ta", "_tb")).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """(node, class) for every node of ``links``: smallest labels travel along links and jump
    to their label's label until none changes."""
    both = links.select("a", "b").union(links.select("b", "a"))
    both = stored(both.union(both.select("a", F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("_node")).agg(F.min("b").alias("_class")), "labels")
    state = None
    while (now := labels.agg(F.count("*"), F.sum(F.xxhash64("_node", "_class").cast("decimal(38,0)"))).first()) != state:
        state = now
        near = (
            both.join(labels.withColumnRenamed("_node", "b"), "b")
            .groupBy(F.col("a").alias("_node"))
            .agg(F.min("_class").alias("_near"))
        )
        further = labels.select(F.col("_node").alias("_near"), "_class")
        labels = stored(near.join(further, "_near").select("_node", "_class"), "labels")
    return labels


def text_classes(docs: DataFrame) -> DataFrame:
    """(node, class) of every text that has a near-duplicate; a node is a text's digest."""
    keyed = docs.select(_node().alias("_node"), _id().alias("_id"), text_or_empty().alias("_text"))
    signed = stored(keyed.mapInArrow(_sign, _SIGNED).dropDuplicates(["_node"]), "signatures")
    rows = signed.select("_node", "_chars", F.explode("_bands").alias("_band"))
    crowded = rows.groupBy("_band").agg(F.count("*").alias("_n")).filter("_n > 1")
    rows = stored(rows.join(crowded, "_band"), "buckets")
    weight = rows.groupBy("_node").agg(F.sum("_n").alias("_weight"))
    involved = stored(weight.join(signed.select("_node", "_id", "_bits"), "_node"), "involved")
    # One row of each text, by the id that its signature was taken from: copies lie in many tasks.
    one = involved.select("_node", "_id")
    texts = keyed.join(one, ["_node", "_id"]).dropDuplicates(["_node", "_id"]).drop("_id")
    texts = stored(texts, "texts")

    hubs = (
        rows.join(involved.select("_node", "_weight"), "_node")
        .groupBy("_band")
        .agg(F.max(F.struct("_weight", "_node")).alias("_hub"))
        .select("_band", F.col("_hub._node").alias("b"))
    )
    pairs = rows.join(hubs, "_band").filter("_node <> b").select(F.col("_node").alias("a"), "b").distinct()
    bits = involved.select("_node", "_bits")
    likely = (
        pairs.join(bits.alias("x"), F.col("a") == F.col("x._node"))
        .join(bits.alias("y"), F.col("b") == F.col("y._node"))
        .filter(_agreeing("x", "y") >= _least_agreeing())
        .select("a", "b")
    )
    links = stored(_linked(likely, texts), "hub-links")
    labels = components(links)

    named = rows.join(labels, "_node", "left").withColumn("_class", F.coalesce("_class", "_node"))
    mixed = named.groupBy("_band").agg(
        F.min("_class").alias("_lo"), F.max("_class").alias("_hi"), F.count("*").alias("_size"), F.sum("_chars").alias("_sum")
    )
    mixed = mixed.filter("_lo < _hi").select(
        "_band", F.ceil(F.col("_size") / BLOCK_TEXTS + F.col("_sum") / BLOCK_CHARS).cast("int").alias("_blocks")
    )
    blocked = named.join(mixed, "_band").withColumn("_block", F.pmod(F.xxhash64("_node"), F.col("_blocks")).cast("int"))
    sketch = signed.select("_node", "_bands", "_bits").join(texts, "_node")
    blocked = blocked.select("_band", "_node", "_class", "_blocks", "_block").join(sketch, "_node")
    # A block meets itself and every other one of its bucket.
    meeting = F.transform(
        F.sequence(F.lit(0), F.col("_blocks") - 1),
        lambda k: F.struct(F.least(k, "_block").alias("i"), F.greatest(k, "_block").alias("j")),
    )
    met = blocked.withColumn("_pair", F.explode(meeting)).select(
        "_band", F.col("_pair.i").alias("_i"), F.col("_pair.j").alias("_j"),
        "_node", "_class", "_block", "_bands", "_bits", "_text",
    )
    more = met.groupBy("_band", "_i", "_j").applyInArrow(_linked_blocks, "a binary, b binary")
    return components(links.union(stored(more, "more-links")))


def _members(docs: DataFrame) -> DataFrame:
    """docs' id and node with the class of each row's text."""
    ids = docs.select("doc_id", _node().alias("_node"))
    return ids.join(text_classes(docs), "_node", "left").withColumn("_class", F.coalesce("_class", "_node"))


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size, and the number of different texts in the class."""
    members = stored(_members(docs), "members")
    by_class = members.groupBy("_class", "_node").agg(F.min("doc_id").alias("_least"), F.count("*").alias("_n"))
    by_class = by_class.groupBy("_class").agg(
        F.min("_least").alias("class_id"), F.sum("_n").alias("class_size"), F.count("*").alias("n_texts")
    )
    return members.join(by_class, "_class").select("doc_id", "class_id", "class_size", "n_texts")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class, that with the smallest id (a null one only where all are)."""
    docs, named = shielded(docs)
    order = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", "_node")
    keepers = (
        _members(docs)
        .groupBy("_class")
        .agg(F.min(order).alias("_first"))
        .select(F.col("_first._node").alias("_node"), F.col("_first.doc_id").alias("doc_id"))
        .select("_node", _id().alias("_id"))
    )
    keyed = docs.withColumn("_node", _node()).withColumn("_id", _id())
    kept = keyed.join(stored(keepers, "keepers"), ["_node", "_id"])
    return named(kept.dropDuplicates(["_node", "_id"]).drop("_node", "_id"))
