"""Forward-backward against enumeration, gradients' outcome against held-out rows, odd inputs."""

from __future__ import annotations

import itertools

import numpy as np
import regex
from pyspark.sql import functions as F

from starhouse.llm import language_crf as crf
from starhouse.llm.common import table


def test_posteriors_equal_enumeration():
    draw = np.random.default_rng(1)
    lengths = np.array([7, 0, 200, 1, 64, 65])
    scores, moves = draw.normal(size=(lengths.sum(), 3)), draw.normal(size=(3, 3))
    post, _ = crf.posteriors(scores, moves, lengths)
    want = np.zeros((7, 3))
    for path in itertools.product(range(3), repeat=7):
        w = np.exp(moves)[:, path[0]].sum() * np.exp(scores[0, path[0]])
        for t in range(1, 7):
            w *= np.exp(moves[path[t - 1], path[t]] + scores[t, path[t]])
        for t in range(7):
            want[t, path[t]] += w
    assert np.allclose(post[:7], want / want.sum(axis=1, keepdims=True))

    def plain(e):
        forward, backward = [], []
        a = np.ones(3)
        for row in e:
            a = (a @ np.exp(moves)) * np.exp(row)
            a /= a.sum()
            forward.append(a)
        b = np.ones(3)
        for row in e[::-1]:
            backward.append(b)
            b = np.exp(moves) @ (np.exp(row) * b)
            b /= b.sum()
        p = np.array(forward) * np.array(backward[::-1])
        return p / p.sum(axis=1, keepdims=True)

    at = 0
    for n in lengths:
        if n:
            assert np.allclose(post[at : at + n], plain(scores[at : at + n]))
        at += n


def test_held_out_accuracy(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = crf.predict(docs).join(docs.select("doc_id", "lang"), "doc_id")
    assert found.count() == docs.count()
    right = found.filter("held_out and lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
    wrong = docs.filter(F.crc32(F.col("doc_id").cast("string")) % 3 == 1).count()
    assert found.filter("held_out").count() == wrong


def test_code_switched_words_change_label(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    labeller = crf.Labeller(crf.train(docs))
    texts = {r.lang: r.text[:400] for r in docs.filter("length(text) > 3000").collect()}
    names = labeller.model.languages
    words, lengths = crf.words_of([texts[names[0]] + " " + texts[names[1]]])
    post, _ = crf.posteriors(labeller.model.emissions(words.to_pylist()), labeller.model.transitions, lengths)
    labels = post.argmax(axis=1)
    assert labels[: len(labels) // 3].tolist().count(0) > len(labels) // 3 * 0.8
    assert labels[-len(labels) // 3 :].tolist().count(1) > len(labels) // 3 * 0.8


def test_odd_rows(spark, documents, odd_rows):
    rows = {}
    for r in crf.predict(documents(odd_rows)).collect():
        rows.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, rows.values())) == len(odd_rows)
    for doc in (2, 3):
        assert rows[doc][0].lang_pred == "und" and rows[doc][0].score == 0
    assert {r.lang_pred for r in rows[1]} == {"und"}
    assert len({(r.lang_pred, r.score) for r in rows[4][:2]}) >= 1
    assert all(0 <= r.score <= 1 for group in rows.values() for r in group)
    assert not rows[None][0].held_out
    assert crf.predict(documents([])).count() == 0
    unlabelled = crf.predict(documents([(9, "some words", None, None, None, None, None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in unlabelled] == [("und", 0.0)]


def test_steps_by_word_equal_steps_by_block(monkeypatch):
    draw = np.random.default_rng(2)
    lengths = np.array([7, 0, 200, 1, 64, 65])
    scores, moves = draw.normal(size=(lengths.sum(), 5)), draw.normal(size=(5, 5))
    blocks = crf.posteriors(scores, moves, lengths)
    monkeypatch.setattr(crf, "_FEW_LANGUAGES", 1)
    words = crf.posteriors(scores, moves, lengths)
    assert np.allclose(blocks[0], words[0]) and np.allclose(blocks[1], words[1])
    none = crf.posteriors(scores[:0], moves, np.array([0, 0]))
    assert none[0].shape == none[1].shape == (0, 5)


def test_training_in_groups_changes_nothing(monkeypatch):
    draw = np.random.default_rng(3)
    slices = [(lang, ["".join(draw.choice(list(own), 5)) for _ in range(30)]) for lang, own in [("x", "abcde"), ("y", "cdefg"), ("z", "fghij")] for _ in range(6)]
    whole = crf.fit(slices, buckets=512, rounds=5)
    monkeypatch.setattr(crf, "_CELLS", 200)
    parts = crf.fit(slices, buckets=512, rounds=5)
    for name in ("grams", "lexical", "transitions"):
        assert np.allclose(getattr(whole, name), getattr(parts, name), atol=1e-3)


def test_more_languages_than_bits_of_a_word(documents):
    draw = np.random.default_rng(4)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    rows = []
    for k in range(70):
        vocabulary = ["".join(draw.choice(letters, 6)) for _ in range(12)]
        for j in range(6):
            text = " ".join(draw.choice(vocabulary, 40))
            rows.append((len(rows), text, f"l{k}'\"", "s", len(text), "x", "y", "z"))
    found = {r.doc_id: r for r in crf.predict(documents(rows)).collect()}
    assert len(found) == len(rows)
    assert sum(found[r[0]].lang_pred == r[2] for r in rows) > 0.9 * len(rows)


def plain_familiar(model, text):
    """Share of n-grams met in training beyond chance, a word and an n-gram at a time; 0 without letters."""
    last = len(model.grams) - 1
    met = real = 0
    for word in regex.findall(r"\p{L}+", text.lower()):
        ids, _ = crf.gram_features([word], last)
        grams = [i for own in ids for i in own.tolist() if i != last]
        met += sum(bool(model.grams[i].any()) for i in grams)
        real += len(grams)
    if not real:
        return 0.0
    chance = sum(bool(row.any()) for row in model.grams[:-1]) / last
    return min(1.0, max(0.0, (met / real - chance) / (1 - chance)))


FOREIGN = [
    "это предложение написано на русском языке и не должно остаться здесь",
    "αυτή η πρόταση είναι γραμμένη στα ελληνικά και δεν πρέπει να μείνει εδώ",
    "zxqv wkrtp bvnmq xxzzq pqrst wvvk jjhq qwpl",
]


def test_unknown_languages_are_not_familiar(spark, sf_dir):
    """The texts of the table are, two of them joined and a license line too; other scripts and letters at random are not."""
    docs = table(spark, sf_dir, "documents")
    rows = docs.filter("text rlike '[a-z]'").collect()
    by_lang = {r.lang: r.text[:400] for r in rows if len(r.text) > 3000}
    mixed = [" ".join(by_lang.values()), "This work is licensed under the GNU General Public License", None, "", "123 !"]
    # The share beyond chance does not rise with the number of labels, though more buckets are used.
    more = docs.withColumn("lang", F.concat("lang", (F.col("doc_id") % 5).cast("string")))
    for model in (crf.train(docs), crf.train(more)):
        judge = crf.Judge(model)
        assert min(judge.familiar([r.text for r in rows])) > 0.6
        assert max(judge.familiar(FOREIGN)) < 0.4
        found = judge.familiar(mixed)
        assert min(found[:2]) > 0.6 and found[2:] == [0, 0, 0]
        texts = [*FOREIGN, *mixed, *[r.text for r in rows[:20]]]
        assert np.allclose(judge.familiar(texts), [plain_familiar(model, t or "") for t in texts])
    assert crf.Judge(None).familiar(["a"]) == [0.0] and crf.Judge(model).familiar([]) == []


def test_familiar_is_a_further_column(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(50)
    model = crf.train(docs)
    found = crf.with_language(docs.withColumn("near", F.lit(1)), model, familiar="near")
    assert found.columns == [*docs.columns, "lang_pred", "score", "near"]
    judge = crf.Judge(model)
    rows = found.collect()
    assert np.allclose([r.near for r in rows], judge.familiar([r.text for r in rows]))
