"""Groups, links and counts of two tokenizers against a plain walk over byte offsets."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from conftest import rows_of

from starhouse.llm import token_alignment as ta
from starhouse.llm.common import table

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture(scope="module")
def sides():
    with open(A, "rb") as a, open(B, "rb") as b:
        return ta.Tokenizers(a.read(), b.read())


def groups_of(sides, text):
    """Lists of ids of A and of B for each group, by walking both sides' ends."""
    (a,), (b,) = sides.encode([text])
    if not text or b"".join(sides.bytes_a[i] for i in a) != (" " + text).encode():
        return []
    if b"".join(sides.bytes_b[i] for i in b) != (" " + text).encode():
        return []
    out, own, i, j, at_a, at_b = [], ([], []), 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at_a <= at_b:
            own[0].append(a[i])
            at_a += len(sides.bytes_a[a[i]])
            i += 1
        else:
            own[1].append(b[j])
            at_b += len(sides.bytes_b[b[j]])
            j += 1
        if at_a == at_b:
            out.append(own)
            own = ([], [])
    return out


def expected(sides, rows):
    every, held = [], Counter()
    for doc_id, text in rows:
        groups = groups_of(sides, text or "")
        links = Counter((x, y) for a, b in groups for x in a for y in b)
        held.update(links.keys())
        every.append((doc_id, groups, links))
    most = {}
    for (x, _), n in held.items():
        most[x] = max(n, most.get(x, 0))
    out = []
    for doc_id, groups, links in every:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values()),
            sum(n for p, n in links.items() if held[p] == most[p[0]]), sum(n * held[p] for p, n in links.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "a  b", "▁ x", "x ▁y", "<|endoftext|> <s></s> <0x41>", "日本語のテキスト 漢字",
    "é" * 50, "𝒳𝒴 ñandú\r\nÇa", "it's 'tis can't 1234567 89", "\x00\x01 \x7f", "word word word", "zzz" * 2000, "\t\t tab", "x　 y z",
]


def test_odd_texts(spark, documents, sides):
    rows = rows_of(ODD + ODD[4:8] + [None]) + [(None, "a word", None, None, None, None, None, None)] * 2
    want = expected(sides, [r[:2] for r in rows])
    assert found(ta.report(documents(rows), A, B)) == want
    assert ta.report(documents([]), A, B).count() == 0


def test_whole_table(spark, sides):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = expected(sides, [(r.doc_id, r.text) for r in docs.collect()])
    assert found(ta.report(docs, A, B)) == want


def test_blocks_of_any_size(sides, monkeypatch):
    """Large groups, many blocks and words that are forgotten change nothing."""
    draw = random.Random(1)
    texts = [" ".join("".join(draw.choice("abcé12") for _ in range(draw.randint(1, 30))) for _ in range(30)) for _ in range(60)]
    whole = list(ta.Aligner(sides).align(texts))
    for name, value in (("_PAIRS_AT_ONCE", 5), ("_SEGMENTS_AT_ONCE", 7), ("_CHARS_AT_ONCE", 500)):
        monkeypatch.setattr(ta, name, value)
    small = list(ta.Aligner(sides).align(texts))
    assert len(small) > 5 and [t for x in whole for t in x.texts] == [t for x in small for t in x.texts]
    for name in ("codes", "counts"):
        assert np.array_equal(np.concatenate([getattr(x, name) for x in whole]), np.concatenate([getattr(x, name) for x in small]))


def test_rows_are_bounded_and_rare_pairs_join(spark, documents, sides, prose, monkeypatch):
    for name, value in (("_PAIRS_A_ROW", 10), ("_REMEMBERED", 50), ("_CHARS_AT_ONCE", 3000), ("LARGE_PAIRS", 50)):
        monkeypatch.setattr(ta, name, value)
    rows = rows_of([prose(200, i % 7) for i in range(20)])
    assert found(ta.report(documents(rows), A, B)) == expected(sides, [r[:2] for r in rows])


def test_pointers_reach_the_last_token_of_a_long_chain():
    """Tokens of two that overlap like bricks: one component of any length."""
    a, b = np.arange(2, 100_002, 2), np.append(np.arange(1, 100_000, 2), 100_000)
    assert set(ta.terminals(a, b).tolist()) == {len(a) - 1}
