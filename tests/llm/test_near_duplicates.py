"""Classes against all pairs, signatures against the similarity that they estimate."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from starhouse.llm import dart_minhash as dm
from starhouse.llm.common import table


def shingles(text):
    words = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    if 0 < len(words) < 5:
        return Counter([tuple(words)])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similarity(x, y):
    if not x or not y:
        return 0.0
    weighted = sum((x & y).values()) / sum((x | y).values())
    return max(weighted, len(x.keys() & y.keys()) / len(x.keys() | y.keys()))


def brute(rows):
    """Smallest id of each row's component, over all pairs."""
    kinds = sorted({t or "" for _, t in rows})
    counted = [shingles(t) for t in kinds]
    parent = list(range(len(kinds)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_shingle = {}
    for i, c in enumerate(counted):
        near = set()
        for s in c:
            near.update(by_shingle.setdefault(s, []))
            by_shingle[s].append(i)
        for j in near:
            if root(i) != root(j) and similarity(c, counted[j]) >= 0.8:
                parent[root(i)] = root(j)
    at = {t: root(i) for i, t in enumerate(kinds)}
    least = {}
    for d, t in rows:
        c = at[t or ""]
        if d is not None:
            least[c] = min(least.get(c, d), d)
    return sorted(((d, least.get(at[t or ""])) for d, t in rows), key=str)


def found(df):
    return sorted(((r.doc_id, r.class_id) for r in df.collect()), key=str)


def test_all_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(dm.classes(docs)) == brute(rows)
    kept = dm.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, c in brute(rows)})


def test_chain_of_edits_and_a_large_group(documents, prose):
    """Copies edited more and more, so hubs do not settle all links."""
    draw = random.Random(3)
    base = prose(150, 1).split()
    texts = []
    for i in range(150):
        words = list(base)
        for _ in range(draw.randint(0, 9)):
            words[draw.randrange(len(words))] = f"edit{draw.randrange(10**6)}"
        texts.append(" ".join(words))
    step = list(base)
    for i in range(0, 60, 4):
        step[i] = f"step{i}"
        texts.append(" ".join(step))
    rows = [(i, t, "en", "s", 1, "x", "y", "z") for i, t in enumerate(texts)]
    assert found(dm.classes(documents(rows))) == brute([(r[0], r[1]) for r in rows])


def test_odd_rows(documents, odd_rows):
    docs = documents(odd_rows)
    want = brute([(r[0], r[1]) for r in odd_rows])
    assert found(dm.classes(docs)) == want
    kept = dm.deduplicated(docs)
    assert kept.columns == docs.columns
    assert kept.count() == 8  # id 4 has two different texts, so two classes bear its name
    assert dm.classes(documents([])).count() == 0
    assert dm.deduplicated(documents([])).count() == 0


def test_signatures_estimate_weighted_similarity(prose):
    errors = []
    for seed in range(30):
        a = prose(300, seed) + " again and again and so on" * (seed % 4)
        words = a.split()
        for k in range(0, len(words), 40):
            words[k] = "new"
        b = " ".join(words)
        seeds, owner, _ = dm.elements(pa.array([a, b]))
        left, right = dm.signatures(seeds, owner, 2)
        x, y = shingles(a), shingles(b)
        errors.append((left == right).mean() - sum((x & y).values()) / sum((x | y).values()))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06
