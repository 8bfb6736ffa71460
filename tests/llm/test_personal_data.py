"""Base spans against a plain search; what the trees add on planted values."""

from __future__ import annotations

import hashlib
import random
import re

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from starhouse.llm import personal_data as pd_
from starhouse.llm.common import table

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(text):
    digits = [int(c) for c in text if c in "0123456789"][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def fits(kind, match):
    n = sum(c in "0123456789" for c in match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 12 <= n <= 19 and luhn(match)
    return kind == "email" or 9 <= n <= 15


def base(text):
    spans = [
        (m.start(), k, m.end(), name)
        for k, (name, pattern) in enumerate(PATTERNS.items())
        for m in re.finditer(pattern, text or "")
        if fits(name, m[0])
    ]
    return [f"{name}:{s}:{e}" for s, _, e, name in sorted(spans)]


def check(df, rows):
    got = sorted(df.collect(), key=lambda r: (str(r.doc_id), r.spans))
    want = sorted((str(i), *[sum(b.startswith(k) for b in base(t)) for k in PATTERNS], hashlib.sha256(",".join(base(t)).encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
    return got


ODD = [
    None, "", "a@b.c_x@d.e a@b.c.@d.e @x.y a@@b.c", "1.2.3.4.5.6.7.8 0000255.1.1.001 256.1.1.1", "4485 1681-1440 7329 1",
    "𝒳 a+b%@x-y.zz é1.2.3.4é", "+1 (017) 555-7713 4845168114407329", "+1((((((((((((((((2 +12345678-", "9" * 50, "0" * 15, "1 2-3--4",
]


def test_base_spans_of_odd_texts(spark, documents):
    draw = random.Random(2)
    noise = ["".join(draw.choice("a1.@+- (9)_0é") for _ in range(draw.randint(1, 60))) for _ in range(400)]
    rows = rows_of(ODD + noise + noise[:5]) + [(None, "a@b.c", None, None, None, None, None, None)] * 2
    check(pd_.report(documents(rows)), [r[:2] for r in rows])
    assert pd_.report(documents([])).count() == 0


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    texts = dict(rows)
    for r in check(pd_.report(docs), rows):
        spans = r.spans.split(",") if r.spans else []
        own = base(texts[r.doc_id])
        assert [s for s in spans if s in set(own)] == own
        for extra in set(spans) - set(own):
            kind, start, end = extra.split(":")
            assert kind != "card" or luhn(texts[r.doc_id][int(start) : int(end)])


@pytest.fixture(scope="module")
def planted(prose):
    """Texts with one value each, from which the trees learn, and their true values."""
    draw = random.Random(3)

    def card(good=True):
        while luhn(number := str(draw.randint(4 * 10**15, 5 * 10**15 - 1))) != good:
            pass
        return number

    def one(i):
        kinds = [
            lambda: f"{draw.choice(['ann', 'bo', 'cy'])}.{draw.randint(1, 99)}@mail{draw.randint(0, 9)}.example.com",
            lambda: ".".join(str(draw.randint(0, 255)) for _ in range(4)),
            card,
            lambda: f"+1 ({draw.randint(100, 999)}) 555-{draw.randint(1000, 9999)}",
            lambda: card(False),
            lambda: ".".join(str(draw.randint(256, 999)) for _ in range(4)),
        ]
        return f"{prose(5, i)} {kinds[i % 6]()} {prose(5, i + 1)}"

    return [one(i) for i in range(600)], card


def test_added_spans(spark, documents, planted):
    """Values that a run of numbers or another spelling hides are added; other numbers are not."""
    texts, card = planted
    a, b, wrong = card(), card(), card(False)
    hidden = {
        f"pay {a} {b} now": [f"card:4:{4 + 16}", "card:21:37"],
        f"pay {wrong} {b} now": ["card:21:37"],
        f"call +1 (417) 555-7713 {wrong} now": ["phone:5:22"],
        f"call +1 (417) 555-7713 {a} now": ["phone:5:22", "card:23:39"],
        "write ann.5 (at) mail3 (dot) example (dot) com now": ["email:6:46"],
        "host 10[.]20[.]30[.]40 now": ["ip:5:22"],
        f"card {a[:4]}.{a[4:8]}.{a[8:12]}.{a[12:]} now": ["card:5:24"],
        "plain words 12 and 1234567 with 3.14 and 12.5.2026 or 10:30": [],
        f"number {wrong} and 1234 5678": [],
    }
    hidden = {t: s for t, s in hidden.items() if not base(t)}
    assert len(hidden) >= 8
    rows = rows_of(texts + list(hidden))
    got = {r.doc_id: r.spans for r in pd_.report(documents(rows)).collect()}
    for i, want in enumerate(hidden.values()):
        assert got[len(texts) + i] == ",".join(want)
    assert all(got[i] == ",".join(base(t)) for i, t in enumerate(texts))


def test_redaction(spark, documents, planted):
    texts, _ = planted
    rows = rows_of([*texts, None, ""])
    frame = documents(rows)
    got = {r.doc_id: r.text for r in pd_.redacted(frame).collect()}
    for i, text in enumerate([*texts, "", ""]):
        for b in reversed(base(text)):
            kind, start, end = b.split(":")
            text = text[: int(start)] + f"[{kind.upper()}]" + text[int(end) :]
        assert got[i] == text


def test_very_long_runs_are_linear(spark, documents):
    texts = ["a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" + "(" * 400_000, "a@" * 200_000, "0" * 300_000 + ".1.1.1", "1.2.3.4 " * 20_000]
    got = {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone) for r in pd_.report(documents(rows_of(texts))).collect()}
    none = (0, 0, 0, 0)
    assert [got[i] for i in range(7)] == [none, none, (0, 50_000, 0, 0), none, none, (0, 1, 0, 0), (0, 20_000, 0, 0)]


def test_no_python_in_the_plans(spark, documents):
    plan = pd_.report(documents(rows_of(ODD)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert pd_.passes_luhn(F.lit("1")) is not None


def test_every_labelled_row_is_fitted(spark, documents, monkeypatch):
    """More candidates of a kind and label than any sample held: trees and thresholds share out all of them."""
    seen = {}

    class Booster:
        def __init__(self, **settings):
            pass

        def fit(self, rows):
            seen["trees"] = rows.count()

    def scored(model, rows):
        seen["thresholds"] = rows.count()
        return rows.withColumn("score", F.col("label"))

    monkeypatch.setattr(pd_, "GBTClassifier", Booster)
    monkeypatch.setattr(pd_.Model, "scored", scored)
    texts = [f"write to a{i}@mail{i % 7}.org or 999.{i}.1.1 now" for i in range(7000)]
    rows = pd_.with_features(pd_.candidates(pd_.proposed(documents(rows_of(texts)))))
    model = pd_.fit(rows)
    distinct = rows.filter("label IS NOT NULL").dropDuplicates(["kind", "label", "form", "before", "after"]).count()
    assert distinct >= 14000 and seen["trees"] + seen["thresholds"] == distinct
    assert model.thresholds[pd_.EMAIL] == 0.5
