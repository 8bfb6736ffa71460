"""Alignment of two tokenizers' tokens over the bytes they share.

Both tokenizers cut the same bytes (a space and the text). Tokens that overlap belong to one
group; groups end where tokens of both end. The groups are found by pointer jumping: every
token points to its farthest-right overlapping token (a token of the other side that holds its
last byte; one of A that ends together with one of B points to itself), and pointers are
doubled, for all tokens of a block at once, until each points to the last token of its
component, which labels the group.

Where no piece of either tokenizer can hold a space behind a character that is not white, both cut
before every space between two words, so texts are aligned word by word and a worker remembers the
words it has seen (a bounded number); texts with other white space before spaces are aligned whole.

A pair of ids is linked in a document where they share a group. Each document gives its
distinct pairs with their number; the number of documents of a pair is one aggregation over
these, with partial sums before the shuffle. Pairs that hold more than a millionth of all rows
are at most a million and looked up by a broadcast of that bound; rarer ones by a join.

Defined results: null, empty and not equally decodable texts have no tokens; every row is a
document of its own, whatever its id; memory grows with the longest text, not with the number
of texts. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starhouse.llm.common import joined_evenly, stored, text_or_empty

#: Bounds of what a worker remembers and handles at once.
_REMEMBERED = 400_000
_CHARS_AT_ONCE = 2_000_000
_SEGMENTS_AT_ONCE = 20_000
_PAIRS_AT_ONCE = 4_000_000
_PAIRS_A_ROW = 65_536
LARGE_PAIRS = 1_000_000


def _byte_level() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable bytes stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


#: White space of any kind, as far as one of both tokenizers may know it.
_WHITE = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]"


def _spaces_follow_white(piece: bytes) -> bool:
    """Whether no space of a piece stands behind a character that is not white."""
    if not _decodes(piece):
        return False
    return not pc.match_substring_regex(pa.array([piece.decode()]), f"[^{_WHITE[1:]} ")[0].as_py()


def _decodes(piece: bytes) -> bool:
    try:
        piece.decode()
    except UnicodeDecodeError:
        return False
    return True


class Tokenizers:
    """Ids of a text by both sides and the bytes each id stands for."""

    def __init__(self, byte_bpe: bytes, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(byte_bpe)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        byte_of = _byte_level()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(True))]
        self.bytes_a = [bytes(byte_of[c] for c in x) if all(c in byte_of for c in x) else x.encode() for x in names]
        pieces_b = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(x[3:5], 16)]) if self.b.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(pieces_b)
        ]
        self.by_word = all(_spaces_follow_white(x) for x in (*self.bytes_a, *self.bytes_b) if b" " in x[1:])

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        found = self.a.encode_batch_fast([f" {t}" for t in texts], add_special_tokens=False)
        return [x.ids for x in found], self.b.encode(texts, num_threads=1)


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """For every token of A, then of B, the place of the token of A that ends its group.

    Ends are byte offsets; the last ends of both are equal.
    """
    n = len(a_end)
    over_a = np.searchsorted(b_end, a_end)
    pointer = np.concatenate(
        [np.where(b_end[over_a] == a_end, np.arange(n), n + over_a), np.searchsorted(a_end, b_end)]
    )
    while not np.array_equal(further := pointer[pointer], pointer):
        pointer = further
    return pointer


@dataclass
class Aligned:
    """A row a segment; ``codes`` and ``counts`` of segment i lie between ``offsets`` i and i + 1."""

    ok: np.ndarray
    sums: np.ndarray  # tokens of A, tokens of B, groups, links
    texts: list[bytes]
    offsets: np.ndarray
    codes: np.ndarray
    counts: np.ndarray


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


class Aligner:
    def __init__(self, tokenizers: Tokenizers):
        self.tokenizers = tokenizers
        self.size_b = len(tokenizers.bytes_b)
        self.pair_bits = (len(tokenizers.bytes_a) * self.size_b).bit_length()
        self.lengths = [np.array([len(x) for x in side], np.int64) for side in (tokenizers.bytes_a, tokenizers.bytes_b)]
        written = [np.array([b"%d" % i for i in range(len(x))], object) for x in self.lengths]
        self.a_inner, self.a_last = written[0] + b",", written[0] + b"|"
        self.b_inner, self.b_last = written[1] + b",", written[1] + b";"
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.parts: list[Aligned] = []
        self.store: tuple | None = None

    def align(self, segments: Sequence[str]) -> Iterator[Aligned]:
        """Segments in blocks, in order."""
        start, size = 0, 0
        for i, s in enumerate(segments):
            size += len(s)
            if size >= _CHARS_AT_ONCE or i + 1 - start == _SEGMENTS_AT_ONCE or i + 1 == len(segments):
                yield self._block(list(segments[start : i + 1]))
                start, size = i + 1, 0

    def _same_bytes(self, segments: list[bytes], side: int, ids: list[list[int]]) -> np.ndarray:
        """Whether one side decodes to each segment."""
        table = self.tokenizers.bytes_a if side == 0 else self.tokenizers.bytes_b
        return np.array([b"".join([table[x] for x in own]) == s for s, own in zip(segments, ids)], bool)

    def _flat(self, segments: list[bytes], side: int, ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, bool]:
        """All ids, their number in each segment, and whether every segment is decoded to itself."""
        table = self.tokenizers.bytes_a if side == 0 else self.tokenizers.bytes_b
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(chain.from_iterable(ids), np.int64, int(n.sum()))
        upto = np.concatenate([[0], np.cumsum(self.lengths[side][flat])])
        sizes = np.diff(upto[np.concatenate([[0], np.cumsum(n)])])
        same = np.array_equal(sizes, np.fromiter(map(len, segments), np.int64, len(segments)))
        return flat, n, same and b"".join(map(table.__getitem__, flat.tolist())) == b"".join(segments)

    def _block(self, segments: list[str]) -> Aligned:
        both = self.tokenizers.encode(segments)
        content = [b" " + s.encode() for s in segments]
        found = [self._flat(content, side, x) for side, x in enumerate(both)]
        ok = np.ones(len(segments), bool)
        if not all(same for _, _, same in found):
            for side, x in enumerate(both):
                ok &= self._same_bytes(content, side, x)
            found = [self._flat([], side, [y if good else [] for y, good in zip(x, ok)]) for side, x in enumerate(both)]
        ids = [flat for flat, _, _ in found]
        owner = [np.repeat(np.arange(len(n)), n) for _, n, _ in found]
        a, b = ids
        a_end, b_end = (np.cumsum(length[x]) for length, x in zip(self.lengths, ids))
        ends = terminals(a_end, b_end) if len(a) else np.zeros(0, np.int64)
        last = np.unique(ends)
        group_a, group_b = np.searchsorted(last, ends[: len(a)]), np.searchsorted(last, ends[len(a) :])
        n_a, n_b = np.bincount(group_a, minlength=len(last)), np.bincount(group_b, minlength=len(last))
        upto_a, upto_b = np.cumsum(n_a), np.cumsum(n_b)
        group_owner = owner[0][last]

        merged = np.empty(len(a) + len(b), object)
        merged[np.arange(len(a)) + (upto_b - n_b)[group_a]] = np.where(ends[: len(a)] == np.arange(len(a)), self.a_last[a], self.a_inner[a])
        merged[np.arange(len(b)) + upto_a[group_b]] = np.where(b_end == a_end[ends[len(a) :]], self.b_last[b], self.b_inner[b])
        per = np.zeros((4, len(segments)), np.int64)
        per[0] = np.bincount(owner[0], minlength=len(segments))
        per[1] = np.bincount(owner[1], minlength=len(segments))
        per[2] = np.bincount(group_owner, minlength=len(segments))
        np.add.at(per[3], group_owner, n_a * n_b)
        cut = np.concatenate([[0], np.cumsum(per[0] + per[1])])
        texts = [b"".join(merged[s:e])[:-1] for s, e in zip(cut, cut[1:])]
        keys, counts = self._pairs(a, b, group_a, n_a, n_b, upto_a - n_a, upto_b - n_b, group_owner)
        offsets = np.searchsorted(keys >> self.pair_bits, np.arange(len(segments) + 1))
        return Aligned(ok, per, texts, offsets, keys & ((1 << self.pair_bits) - 1), counts)

    def _pairs(self, a, b, group_a, n_a, n_b, from_a, from_b, owner) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys (segment and pair) with their links; a large group gives distinct ids only."""
        found: list[tuple[np.ndarray, np.ndarray]] = []
        large = n_a * n_b > _PAIRS_AT_ONCE
        links = np.where(large[group_a], 0, n_b[group_a])
        upto = np.cumsum(links)
        start = 0
        while start < len(a):
            end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + _PAIRS_AT_ONCE, "right")))
            n = links[start:end]
            first = np.repeat(np.arange(start, end), n)
            second = np.arange(len(first)) - np.repeat(np.cumsum(n) - n, n) + from_b[group_a[first]]
            keys = (owner[group_a[first]] << self.pair_bits) | (a[first] * self.size_b + b[second])
            found.append(_counted(keys, np.ones(len(keys), np.int64)))
            start = end
        for g in np.flatnonzero(large):
            ids_a, times_a = np.unique(a[from_a[g] : from_a[g] + n_a[g]], return_counts=True)
            ids_b, times_b = np.unique(b[from_b[g] : from_b[g] + n_b[g]], return_counts=True)
            keys = (owner[g] << self.pair_bits) | (ids_a[:, None] * self.size_b + ids_b[None, :])
            found.append((keys.ravel(), (times_a[:, None] * times_b[None, :]).ravel()))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return _counted(np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found]))

    def words(self, words: pa.DictionaryArray) -> np.ndarray:
        """Places of words in the store, to which those that are new are added."""
        distinct = words.dictionary.to_pylist()
        if len(self.known) > _REMEMBERED:
            self.forget()
        fresh = [w for w in distinct if w not in self.known]
        if fresh:
            self.parts += self.align(fresh)
            self.known.update(zip(fresh, range(len(self.known), len(self.known) + len(fresh))))
            self.store = None
        each = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return each[words.indices.to_numpy()]

    def stored(self) -> tuple:
        """ok, sums, texts, pairs and counts of all words in the store."""
        if self.store is None:
            p = self.parts
            shift = np.cumsum([0, *[len(x.codes) for x in p]])
            offsets = np.concatenate([*[x.offsets[:-1] + s for x, s in zip(p, shift)], shift[-1:]])
            whole = Aligned(
                np.concatenate([x.ok for x in p]),
                np.concatenate([x.sums for x in p], axis=1),
                [],
                offsets,
                np.concatenate([x.codes for x in p]),
                np.concatenate([x.counts for x in p]),
            )
            texts = pa.concat_arrays([x if isinstance(x, pa.Array) else pa.array(x, pa.binary()) for x in (y.texts for y in p)])
            whole.texts = texts
            self.parts = [whole]
            lists = [pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(x)) for x in (whole.codes, whole.counts)]
            self.store = whole.ok, whole.sums, texts, *lists
        return self.store


_ROW = pa.schema(
    [("_row", pa.int64()), ("doc_id", pa.int64())]
    + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("codes", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))]
)
_DDL = (
    "_row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, codes array<bigint>, counts array<bigint>"
)


def _rows(rows: list[int], doc_ids: list, sums: np.ndarray, texts: list, offsets, codes, counts) -> Iterator[pa.RecordBatch]:
    """A row a document, and more rows without sums where it has very many pairs."""
    digests = [hashlib.sha256(t).hexdigest() if n else "" for t, n in zip(texts, sums[0].tolist())]
    head = [pa.array(rows), pa.array(doc_ids, pa.int64()), *[pa.array(s) for s in sums], pa.array(digests, pa.string())]
    ends = np.minimum(offsets[1:], offsets[:-1] + _PAIRS_A_ROW)
    if np.array_equal(ends, offsets[1:]):
        lists = [pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x)) for x in (codes, counts)]
        yield pa.RecordBatch.from_arrays([*head, *lists], schema=_ROW)
        return
    for i in range(len(rows)):
        for start in range(offsets[i], max(offsets[i + 1], offsets[i] + 1), _PAIRS_A_ROW):
            end = min(start + _PAIRS_A_ROW, offsets[i + 1])
            own = [x.slice(i, 1) for x in head] if start == offsets[i] else [head[0].slice(i, 1), *[pa.nulls(1, f.type) for f in list(_ROW)[1:7]]]
            lists = [pa.array([x[start:end]], pa.list_(pa.int64())) for x in (codes, counts)]
            yield pa.RecordBatch.from_arrays([*own, *lists], schema=_ROW)


_ODD_SPACE = rf"(^|{_WHITE}) | $"


def _aligned_texts(aligner: Aligner, rows: list[int], doc_ids: list, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    whole = np.zeros(len(texts), bool)
    if aligner.tokenizers.by_word:
        odd = pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False)
        fine = np.flatnonzero(~odd)
        whole[odd] = True
    else:
        fine = np.zeros(0, np.int64)
        whole[:] = True
    if len(fine):
        lists = pc.split_pattern(texts.take(pa.array(fine)), " ")
        words = lists.flatten().dictionary_encode()
        places = aligner.words(words)
        ok, sums, word_texts, codes, counts = aligner.stored()
        cut = lists.offsets.to_numpy().astype(np.int64) - lists.offsets[0].as_py()
        good = np.add.reduceat(np.append(ok[places].astype(np.int64), 0), cut[:-1]) == np.diff(cut)
        whole[fine[~good]] = True
        upto = np.concatenate([np.zeros((4, 1), np.int64), np.cumsum(sums[:, places], axis=1)], axis=1)
        per = np.diff(upto[:, cut], axis=1)
        taken = pa.array(places)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(cut, pa.int32()), word_texts.take(taken)), b";")
        own_codes, own_counts = codes.take(taken), counts.take(taken)
        n_pairs = np.diff(own_codes.offsets.to_numpy())
        owner = np.repeat(np.repeat(np.arange(len(fine)), np.diff(cut)), n_pairs)
        keys, times = _counted((owner << aligner.pair_bits) | own_codes.flatten().to_numpy(), own_counts.flatten().to_numpy())
        offsets = np.searchsorted(keys >> aligner.pair_bits, np.arange(len(fine) + 1))
        keys &= (1 << aligner.pair_bits) - 1
        for start, end in _runs(good):
            s, e = offsets[start], offsets[end]
            yield from _rows(
                [rows[i] for i in fine[start:end]], [doc_ids[i] for i in fine[start:end]], per[:, start:end],
                joined[start:end].to_pylist(), offsets[start : end + 1] - s, keys[s:e], times[s:e],
            )
    left = np.flatnonzero(whole)
    done = 0
    for block in aligner.align([texts[i].as_py() for i in left]):
        own = left[done : done + len(block.ok)]
        done += len(own)
        yield from _rows(
            [rows[i] for i in own], [doc_ids[i] for i in own], block.sums, block.texts, block.offsets, block.codes, block.counts
        )


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and end of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    yield from zip(edges[::2].tolist(), edges[1::2].tolist())


_workers: dict[str, Aligner] = {}


def aligned(docs: DataFrame, byte_bpe_file: str, piece_file: str) -> DataFrame:
    """Per document: sizes, the digest of its groups, distinct pairs (``a * size of B + b``) and their links.

    Very many pairs of one document come in further rows, which have nulls but for ``_row``.
    """
    spark = docs.sparkSession
    content = []
    for name in (byte_bpe_file, piece_file):
        with open(name, "rb") as file:
            content.append(file.read())
    version = hashlib.sha256(b"".join(content)).hexdigest()
    shared = spark.sparkContext.broadcast(content)  # two tokenizer files

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if version not in _workers:
            _workers.clear()
            _workers[version] = Aligner(Tokenizers(*shared.value))
        aligner = _workers[version]
        for batch in batches:
            rows, doc_ids, texts = batch.column("_row").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("_text")
            sizes = np.cumsum(pc.utf8_length(texts).to_numpy(zero_copy_only=False))
            start = 0
            while start < len(texts):
                end = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + _CHARS_AT_ONCE, "right")))
                own = texts.slice(start, end - start)
                filled = np.flatnonzero(pc.binary_length(own).to_numpy(zero_copy_only=False) > 0)
                empty = sorted(set(range(len(own))) - set(filled.tolist()))
                none = np.zeros(0, np.int64)
                zeros = np.zeros((4, len(empty)), np.int64)
                yield from _rows(
                    [rows[start + i] for i in empty], [doc_ids[start + i] for i in empty], zeros, [b""] * len(empty),
                    np.zeros(len(empty) + 1, np.int64), none, none,
                )
                if len(filled):
                    ids = [doc_ids[start + i] for i in filled]
                    yield from _aligned_texts(aligner, [rows[start + i] for i in filled], ids, own.take(pa.array(filled)))
                start = end

    read = docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().alias("_text")
    )
    return read.mapInArrow(run, _DDL)


def pair_documents(found: DataFrame, size_b: int) -> DataFrame:
    """code, n_docs (documents that hold the pair) and whether that is the most of all pairs of its A id."""
    of_a = Window.partitionBy(F.expr(f"code div {size_b}"))  # at most as many rows as B has ids
    held = found.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count("*").alias("n_docs"))
    return held.withColumn("best", F.col("n_docs") == F.max("n_docs").over(of_a))


def report(docs: DataFrame, byte_bpe_file: str, piece_file: str) -> DataFrame:
    """A row a document: sizes, best links, sum of the links' counts, digest of the groups."""
    import sentencepiece

    size_b = sentencepiece.SentencePieceProcessor(model_file=piece_file).get_piece_size()
    found = stored(aligned(docs, byte_bpe_file, piece_file), "token-groups")
    pairs = found.select("_row", F.explode(F.arrays_zip("codes", "counts")).alias("p")).select("_row", "p.codes", "p.counts")
    pairs = pairs.select("_row", F.col("codes").alias("code"), F.col("counts").alias("n"))
    held = stored(pair_documents(found, size_b).withColumn("_size", F.col("n_docs")), "token-pairs")
    scored = joined_evenly(pairs, held, ["code"], "_size", "inner", LARGE_PAIRS)
    sums = scored.groupBy("_row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(F.lit(0))).alias("n_best"),
        F.sum(F.col("n") * F.col("n_docs")).alias("count_sum"),
    )
    heads = found.filter("n_a IS NOT NULL").drop("codes", "counts")
    zero = F.lit(0).cast("bigint")
    return heads.join(sums, "_row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
