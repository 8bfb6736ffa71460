"""Language identification with a linear-chain conditional random field over words.

Every word is labelled with a language. A word's features are its character n-grams and
affixes (hashed) and the languages whose lexicon holds it; learned transitions link
neighbouring words, so a text may switch languages. Forward-backward gives each word's
posterior, and a document's language is the one with the largest mean posterior.

Any number of languages is learned; memory and time of the model grow with it. Training uses
a bounded sample (``sample_docs`` documents a language, fewer where more than
``_FULL_SAMPLES`` languages share the bound, and a slice of ``slice_words`` words of each,
chosen by a hash). It pairs slices into switched
sequences, so the transitions see changes of language. Prediction runs over every word of
every text inside the tasks that scan the documents; nothing is shuffled.

Defined results: a text that is null or has no letter gets ``und`` with score 0; repeated
rows get equal results; ids play no part in a prediction; without any labelled row every
text with letters gets ``und`` as well. Extra columns are ignored by ``predict`` and kept
by ``with_language``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starhouse.llm.common import shielded

UNKNOWN = "und"
#: Words are runs of letters, in lower case.
_WORD = r"(\p{L}+)"
_BLOCK = 64
#: Languages up to which blocks' transfer matrices are cheaper than a step a word.
_FEW_LANGUAGES = 16
#: Languages that get a full sample; more of them share as many documents as these have.
_FULL_SAMPLES = 32
#: Bounds of what a Python worker keeps: distinct words remembered, characters handled at once.
_REMEMBERED = 400_000
_CHARS_AT_ONCE = 4_000_000
#: Numbers in a table of words by languages, or of features by languages, made at once.
_CELLS = 8_000_000


@dataclass
class Crf:
    """Weights of a trained model; ``grams`` has one row a hashed feature and a last row of zeros."""

    languages: list[str]
    lexicon: dict[str, list[int]]  # word -> its languages
    grams: np.ndarray
    lexical: np.ndarray  # row: language whose lexicon holds the word
    transitions: np.ndarray

    @property
    def seen(self) -> np.ndarray:
        """Which rows of ``grams`` training has touched."""
        return (self.grams != 0).any(axis=1)

    def emissions(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros((0, len(self.languages)), np.float32)
        ids, starts = gram_features(words, len(self.grams) - 1)
        return (gram_scores(self.grams, ids, starts) + self.lexicon_flags(words) @ self.lexical).astype(np.float32)

    def lexicon_flags(self, words: list[str]) -> np.ndarray:
        flags = np.zeros((len(words), len(self.languages)), np.float32)
        for i, w in enumerate(words):
            if w in self.lexicon:
                flags[i, self.lexicon[w]] = 1
        return flags


def gram_features(words: list[str], buckets: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashed features by n and character, and the character where each word begins.

    All 2- and 3-grams of the word between its boundary marks, and the 4- and 5-grams that
    touch a mark (affixes of three and four letters). Where a character begins no such
    n-gram, the number is ``buckets``, which stands for no feature.
    """
    chars = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), np.uint32)
    starts = np.flatnonzero(chars == 2)
    ends = np.append(starts[1:], len(chars))
    left = np.repeat(ends, ends - starts) - np.arange(len(chars))  # characters up to the end
    padded = np.concatenate([chars, np.zeros(5, np.uint32)]).astype(np.uint64)
    rolled, found = padded[: len(chars)], []
    for n in (2, 3, 4, 5):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + padded[n - 1 : n - 1 + len(chars)]
        mixed = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        ids = ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)
        inside = left >= n
        if n > 3:
            inside &= (chars == 2) | (left == n)
        ids[~inside] = buckets
        found.append(ids)
    return found, starts


def gram_scores(grams: np.ndarray, ids: list[np.ndarray], starts: np.ndarray) -> np.ndarray:
    """Summed weights of each word's features, some words at a time."""
    out = np.empty((len(starts), grams.shape[1]), grams.dtype)
    ends = np.append(starts[1:], len(ids[0]))
    start = 0
    while start < len(starts):
        end = max(start + 1, int(np.searchsorted(ends, starts[start] + _CELLS // grams.shape[1], side="right")))
        part = slice(starts[start], ends[end - 1])
        out[start:end] = np.add.reduceat(sum(grams[own[part]] for own in ids), starts[start:end] - starts[start], axis=0)
        start = end
    return out


def _normal(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def posteriors(
    emissions: np.ndarray, transitions: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Word posteriors and forward messages of many texts laid end to end, by forward-backward.

    A text is cut into blocks of words. All blocks' transfer matrices are multiplied side by
    side, messages pass from block to block within each text, and then run through all blocks
    side by side: the steps number block length plus blocks of the longest text, not its words.
    Texts of no words may occur. Transfer matrices cost the cube of the number of languages a
    word, so for many languages the steps are the words of the longest text.
    """
    size = emissions.shape[1]
    if size > _FEW_LANGUAGES:
        return _posteriors_by_word(emissions, transitions, lengths)
    blocks_of = -(-lengths // _BLOCK)
    n_blocks = int(blocks_of.sum())
    if not n_blocks:
        return np.zeros((0, size)), np.zeros((0, size))
    within = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    first_block = np.cumsum(blocks_of) - blocks_of
    row = np.repeat(first_block, lengths) + within // _BLOCK
    column = within % _BLOCK
    kind = emissions.dtype
    local = np.ones((_BLOCK, n_blocks, size), kind)
    local[column, row] = np.exp(emissions - emissions.max(axis=1, keepdims=True)) + np.finfo(kind).tiny
    filled = np.full(n_blocks, _BLOCK)
    filled[first_block[lengths > 0] + blocks_of[lengths > 0] - 1] = (lengths[lengths > 0] - 1) % _BLOCK + 1
    order = np.argsort(-filled, kind="stable")  # blocks still going at any step come first
    local = local[:, order]
    going = np.searchsorted(-filled[order], -np.arange(_BLOCK), side="left")
    move = np.exp(transitions - transitions.max()).astype(kind)
    product = np.broadcast_to(np.eye(size, dtype=kind), (n_blocks, size, size)).copy()
    for t in range(_BLOCK):
        on = product[: going[t]]
        on[:] = (on.reshape(-1, size) @ move).reshape(-1, size, size) * local[t, : going[t], None, :]
        if t % 4 == 3:
            on /= on.max(axis=(1, 2), keepdims=True)
    product /= product.max(axis=(1, 2), keepdims=True)
    place = np.empty(n_blocks, np.int64)
    place[order] = np.arange(n_blocks)
    # The first word's predecessor may be any language alike.
    alpha, beta = np.ones((n_blocks, size), kind), np.ones((n_blocks, size), kind)
    for k in range(int(blocks_of.max()) - 1):
        longer = blocks_of > k + 1
        on = first_block[longer] + k
        alpha[place[on + 1]] = _normal(np.einsum("bi,bij->bj", alpha[place[on]], product[place[on]]))
        back = (first_block + blocks_of)[longer] - 1 - k
        beta[place[back - 1]] = _normal(np.einsum("bij,bj->bi", product[place[back]], beta[place[back]]))
    forward = np.ones((_BLOCK, n_blocks, size), kind)
    message = alpha
    for t in range(_BLOCK):
        message = _normal((message[: going[t]] @ move) * local[t, : going[t]])
        forward[t, : going[t]] = message
    row = place[row]
    ahead = forward[column, row]
    for t in range(_BLOCK - 1, -1, -1):
        forward[t, : going[t]] *= beta[: going[t]]
        beta[: going[t]] = _normal((local[t, : going[t]] * beta[: going[t]]) @ move.T)
    return _normal(forward[column, row] + np.finfo(kind).tiny), ahead


def _posteriors_by_word(
    emissions: np.ndarray, transitions: np.ndarray, lengths: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """``posteriors`` with one step for each word of the longest text, side by side over texts."""
    kind = emissions.dtype
    local = np.exp(emissions - emissions.max(axis=1, keepdims=True)) + np.finfo(kind).tiny
    move = np.exp(transitions - transitions.max()).astype(kind)
    order = np.argsort(-lengths, kind="stable")  # texts still going at any step come first
    first = (np.cumsum(lengths) - lengths)[order]
    steps = int(lengths.max(initial=0))
    going = np.searchsorted(-lengths[order], -np.arange(steps), side="left")
    ahead, back = np.empty_like(local), np.empty_like(local)
    message = np.ones((len(lengths), emissions.shape[1]), kind)
    for t in range(steps):
        at = first[: going[t]] + t
        message = _normal((message[: going[t]] @ move) * local[at])
        ahead[at] = message
    message = np.ones((len(lengths), emissions.shape[1]), kind)
    for t in range(steps - 1, -1, -1):
        at = first[: going[t]] + t
        back[at] = message[: going[t]]
        message[: going[t]] = _normal((local[at] * back[at]) @ move.T)
    back *= ahead
    return _normal(back + np.finfo(kind).tiny), ahead


def fit(slices: list[tuple[str, list[str]]], buckets: int = 1 << 15, rounds: int = 20, lexicon_words: int = 300) -> Crf:
    """Train on (language, words) slices by full-batch Adam on the conditional likelihood."""
    languages = sorted({lang for lang, _ in slices})
    size = len(languages)
    slices = sorted(((lang, words) for lang, words in slices if words), key=lambda x: (len(x[1]), x[0], x[1]))
    # Sequences that switch: each slice is followed by the half of another one.
    place = {lang: k for k, lang in enumerate(languages)}
    sequences, labels = [], []
    for i, (lang, words) in enumerate(slices):
        other_lang, other = slices[(i * 7919 + 13) % len(slices)]
        tail = other[: max(1, len(other) // 2)]
        sequences.append(words + tail)
        labels.append([place[lang]] * len(words) + [place[other_lang]] * len(tail))
    counts: list[dict[str, int]] = [{} for _ in languages]
    for lang, words in slices:
        own = counts[place[lang]]
        for w in words:
            own[w] = own.get(w, 0) + 1
    lexicon: dict[str, list[int]] = {}
    for k, own in enumerate(counts):
        for w, n in sorted(own.items(), key=lambda x: (-x[1], x[0]))[:lexicon_words]:
            if n > 1:
                lexicon.setdefault(w, []).append(k)
    types = sorted({w for s in sequences for w in s})
    number = {w: i for i, w in enumerate(types)}
    features, starts = gram_features(types, buckets)
    ids = np.concatenate(features)
    owner = np.tile(np.repeat(np.arange(len(types)), [len(w) + 2 for w in types]), 4)
    flat = np.array([number[w] for s in sequences for w in s])
    gold = np.array([y for s in labels for y in s])
    lengths = np.array([len(s) for s in sequences])
    model = Crf(languages, lexicon, np.zeros((buckets + 1, size)), np.zeros((size, size)), np.zeros((size, size)))
    flags = model.lexicon_flags(types)
    linked = np.ones(len(flat), bool)
    linked[np.cumsum(lengths) - lengths] = False
    before, after = np.flatnonzero(linked) - 1, np.flatnonzero(linked)
    seen_moves = np.zeros((size, size))
    np.add.at(seen_moves, (gold[before], gold[after]), 1)
    # Sequences whose tables of words by languages are made at once, as spans of words.
    upto = np.concatenate([[0], np.cumsum(lengths)])
    groups = np.split(np.arange(len(lengths)), np.flatnonzero(np.diff(upto[1:] * size // _CELLS)) + 1)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in (model.grams, model.lexical, model.transitions)]
    for step in range(1, rounds + 1):
        scores = (gram_scores(model.grams, features, starts) + flags @ model.lexical).astype(np.float32)
        moves, expected_moves = np.exp(model.transitions), np.zeros((size, size))
        by_type = np.zeros((len(types), size))
        for group in groups:
            own = slice(upto[group[0]], upto[group[-1] + 1])
            marginal, ahead = posteriors(scores[flat[own]], model.transitions, lengths[group])
            second = np.flatnonzero(linked[own])
            left = ahead[second - 1].astype(float)
            expected_moves += moves * (left.T @ (marginal[second] / (left @ moves)))
            for k in range(size):
                by_type[:, k] += np.bincount(flat[own], (gold[own] == k) - marginal[:, k], len(types))
        grams = np.stack([np.bincount(ids, by_type[owner, k], buckets + 1) for k in range(size)], axis=1)
        gradients = (grams, flags.T @ by_type, seen_moves - expected_moves)
        for weights, gradient, (m, v) in zip((model.grams, model.lexical, model.transitions), gradients, moments):
            gradient = gradient / len(flat) - 1e-6 * weights
            m += 0.1 * (gradient - m)
            v += 0.01 * (gradient**2 - v)
            weights += 0.25 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        model.grams[-1] = 0
    return Crf(languages, lexicon, model.grams.astype(np.float32), model.lexical.astype(np.float32), model.transitions)


def training_slices(
    docs: DataFrame, usable: Column, sample_docs: int, slice_words: int
) -> list[tuple[str, list[str]]]:
    """Slices of the ``sample_docs`` documents of each language with the smallest draws.

    A draw is a hash of id and text. Documents are counted first, and only draws below four
    times the share that is needed go on, so a language's window sees about four times the
    sample however many documents there are.
    """
    known = docs.select("doc_id", "text", "lang").filter(usable & F.col("lang").isNotNull())
    counts = known.groupBy("lang").count().collect()  # a row a language, like the model
    if not counts:
        return []
    if len(counts) > _FULL_SAMPLES:
        sample_docs = max(1, sample_docs * _FULL_SAMPLES // len(counts))
    top = 1 << 31
    limits = {r.lang: min(top, 4 * sample_docs * top // r["count"] + 1) for r in counts}
    limit = F.from_json(F.lit(json.dumps(limits)), "map<string,bigint>")[F.col("lang")]
    words = F.regexp_extract_all(F.lower("text"), F.lit(_WORD), F.lit(1))
    start = 1 + F.pmod("_draw", F.greatest(F.size("_words") - slice_words, F.lit(1)))
    rows = (
        known.filter(F.col("text").rlike(r"\p{L}"))
        .withColumn("_draw", F.pmod(F.xxhash64("doc_id", "text"), F.lit(top)))
        .filter(F.col("_draw") < limit)
        .withColumn("_words", words)
        .select("lang", "_draw", F.slice("_words", start.cast("int"), slice_words).alias("words"))
        .groupBy("lang", "_draw")
        .agg(F.first("words").alias("words"))
        .withColumn("_rank", F.row_number().over(Window.partitionBy("lang").orderBy("_draw")))
        .filter(F.col("_rank") <= sample_docs)
        .orderBy("lang", "_draw")
        .select("lang", "words")
        .collect()
    )
    return [(r.lang, r.words) for r in rows]


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, usable: Column | None = None, sample_docs: int = 250, slice_words: int = 100) -> Crf | None:
    slices = training_slices(docs, F.lit(True) if usable is None else usable, sample_docs, slice_words)
    return fit(slices) if slices else None


def words_of(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts end to end, and how many each has; a text without letters has none."""
    lower = pc.utf8_lower(pa.array(texts, pa.string()).fill_null(""))
    runs = pc.split_pattern(pc.replace_substring_regex(lower, r"[^\p{L}]+", " "), " ")
    real = pc.greater(pc.binary_length(runs.values), 0)
    upto = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return runs.values.filter(real), np.diff(upto[runs.offsets.to_numpy()])


class Labeller:
    """A worker's model with the words it has met; forgets them all when they grow too many."""

    def __init__(self, model: Crf | None):
        self.model = model
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages) if model else 1), np.float32)

    def numbers(self, words: pa.Array) -> np.ndarray:
        """Row of ``scores`` for each word; only distinct words reach Python."""
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if len(self.known) > _REMEMBERED * _FEW_LANGUAGES // max(_FEW_LANGUAGES, self.scores.shape[1]):
            self.known, self.scores = {}, self.scores[:0]
        fresh = [w for w in distinct if w not in self.known]
        if fresh:
            start = len(self.known)
            self.known.update(zip(fresh, range(start, start + len(fresh))))
            self.scores = np.concatenate([self.scores, self.model.emissions(fresh)])
        rows = np.fromiter(map(self.known.__getitem__, distinct), np.int64, len(distinct))
        return rows[coded.indices.to_numpy()]

    def label(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and mean posterior of each text."""
        if self.model is None:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        words, lengths = words_of(texts)
        numbers = self.numbers(words)
        marginal, _ = posteriors(self.scores[numbers], self.model.transitions, lengths)
        ends = np.cumsum(lengths)
        total = np.concatenate([np.zeros((1, marginal.shape[1])), np.cumsum(marginal, axis=0, dtype=np.float64)])
        mean = (total[ends] - total[ends - lengths]) / np.maximum(lengths, 1)[:, None]
        best = mean.argmax(axis=1)
        names = [self.model.languages[b] if n else UNKNOWN for b, n in zip(best, lengths)]
        score = np.where(lengths > 0, np.clip(mean.max(axis=1), 0, 1), 0.0)
        return names, score.tolist()


class Judge(Labeller):
    """A labeller that also says how much of a text resembles what the model was trained on."""

    def __init__(self, model: Crf | None):
        super().__init__(model)
        if model is not None:
            self.seen = model.seen
            #: What an n-gram that training never met is taken for by its hash alone.
            self.chance = float(self.seen[:-1].mean())

    def familiar(self, texts: list[str | None]) -> list[float]:
        """The share of each text's n-grams that training met, beyond chance: 0 to 1.

        An n-gram never met shares its bucket with one that was met at the rate of used buckets,
        so that rate counts as 0, whatever the number of languages. A text without letters has
        0; where every bucket is used nothing can be told and every text has 1.
        """
        if self.model is None:
            return [0.0] * len(texts)
        words, lengths = words_of(texts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        if not distinct:
            return [0.0] * len(texts)
        ids, starts = gram_features(distinct, len(self.seen) - 1)
        met, all_ = (np.add.reduceat(sum(f(own) for own in ids), starts) for f in (self._met, self._real))
        rows = coded.indices.to_numpy()
        upto = np.concatenate([[0], np.cumsum(lengths)])
        met, all_ = (np.concatenate([[0], np.cumsum(n[rows])]) for n in (met, all_))
        met, all_ = met[upto[1:]] - met[upto[:-1]], all_[upto[1:]] - all_[upto[:-1]]
        if self.chance >= 1:
            return np.where(lengths > 0, 1.0, 0.0).tolist()
        share = (met / np.maximum(all_, 1) - self.chance) / (1 - self.chance)
        return np.where(lengths > 0, np.clip(share, 0, 1), 0.0).tolist()

    def _met(self, ids: np.ndarray) -> np.ndarray:
        return self.seen[ids].astype(np.int64)

    def _real(self, ids: np.ndarray) -> np.ndarray:
        return (ids != len(self.seen) - 1).astype(np.int64)


def _spans(texts: list[str | None], languages: int = 1) -> Iterator[slice]:
    """Runs of texts of bounded total length, less for many languages; a longer text stands alone."""
    start = total = 0
    most = _CHARS_AT_ONCE * _FEW_LANGUAGES // max(_FEW_LANGUAGES, languages)
    for i, t in enumerate(texts):
        n = len(t or "")
        if total and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(texts):
        yield slice(start, len(texts))


def with_language(
    docs: DataFrame, model: Crf | None, pred: str = "lang_pred", score: str = "score", familiar: str | None = None
) -> DataFrame:
    """``docs`` with its predicted language; every other column is kept, one of the added names replaced.

    ``familiar`` names a further column for :meth:`Judge.familiar`.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: buckets x languages
    added = [pred, score, *([familiar] if familiar else [])]
    kind = f"struct<{pred}: string, {score}: double{f', {familiar}: double' if familiar else ''}>"

    @F.pandas_udf(kind)
    def labels(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = Judge(shared.value) if familiar else Labeller(shared.value)
        for batch in batches:
            texts, names, scores, shares = batch.tolist(), [], [], []
            for span in _spans(texts, labeller.scores.shape[1]):
                n, s = labeller.label(texts[span])
                names += n
                scores += s
                if familiar:
                    shares += labeller.familiar(texts[span])
            yield pd.DataFrame(dict(zip(added, (names, scores, shares))))

    docs, named = shielded(docs.drop(*added))
    out = docs.withColumn("_label", labels("text")).select("*", *[f"_label.{c}" for c in added]).drop("_label")
    return named(out)


def predict(docs: DataFrame, sample_docs: int = 250, slice_words: int = 100) -> DataFrame:
    """Train on the rows that are not held out, predict all: doc_id, held_out, lang_pred, score."""
    model = train(docs, ~held_out(), sample_docs, slice_words)
    named = with_language(docs.select("doc_id", "text"), model)
    return named.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
