"""Edit matches against plain dynamic programming; the mix against its deviation bound."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np

from starhouse.llm import edit_matching as em
from starhouse.llm import pfair_mix as pf
from starhouse.llm.common import table


def plain_distance(pattern, text):
    """Least edit distance of the pattern to any stretch of the text."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        before, row[0] = row[0], 0
        for i, p in enumerate(pattern, 1):
            before, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, before + (p != c))
        best = min(best, row[-1])
    return best


def edit(text, n, draw):
    chars = list(text)
    for _ in range(n):
        i = draw.randrange(len(chars))
        how = draw.randrange(3)
        if how == 0:
            chars[i] = draw.choice("abcxyz")
        elif how == 1:
            chars.insert(i, draw.choice("abcxyz"))
        else:
            del chars[i]
    return "".join(chars)


def test_against_plain_distances(spark, documents, prose):
    draw = random.Random(8)
    items = [(i, prose(12, 100 + i)) for i in range(6)] + [(6, "Short, one"), (7, None), (8, "?!"), (9, "x" * 40)]
    texts = []
    for i in range(60):
        body = prose(40, 500 + i).split()
        _, item = items[i % 6]
        body[20:20] = edit(item, i % 9, draw).split()
        texts.append(" ".join(body) + (" short one." if i % 7 == 0 else " shorten" if i % 7 == 1 else ""))
    texts += [None, "", "x" * 39, "y" * 500 + "x" * 40, items[0][1], "Short one"]
    rows = [(i, t, "en", "s", 1, "x", "y", "z") for i, t in enumerate(texts)]
    chosen = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in em.contaminated(documents(rows), chosen).collect()}
    want = {}
    for i, text in zip(range(len(texts)), em.normal(texts)):
        for j, item in zip([k for k, t in items], em.normal([t for _, t in items])):
            bare = item.strip()
            budget = int(len(bare) * em.RATE)
            if not bare:
                continue
            if budget == 0:
                if item in text:
                    want[i, j] = 0
            elif (d := plain_distance(bare, text)) <= budget:
                want[i, j] = d
    assert len(set(want.values())) > 2
    assert got == want
    kept = em.decontaminated(documents(rows), chosen)
    assert kept.columns == documents(rows).columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - {d for d, _ in want}


def test_blocks_of_items(monkeypatch, spark, documents, prose):
    items = [(i, prose(12, i)) for i in range(8)]
    rows = [(i, t, "en", "s", 1, "x", "y", "z") for i, (_, t) in enumerate(items)]
    chosen = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(em, "BLOCK_CHARS", 200)
    found = em.contaminated(documents(rows), chosen).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(i, i) for i in range(8)]


def test_items_and_documents_may_be_odd(spark, documents, odd_rows):
    none = spark.createDataFrame([], "item_id bigint, text string")
    docs = documents(odd_rows)
    assert em.contaminated(docs, none).count() == 0
    assert em.decontaminated(docs, none).count() == len(odd_rows)
    assert em.contaminated(documents([]), none).count() == 0
    word = spark.createDataFrame([(1, "WORD"), (1, "word"), (None, "a b c d e f")], "item_id bigint, text string")
    found = Counter((r.doc_id, r.item_id) for r in em.contaminated(docs, word).collect())
    assert found[4, 1] == 6 and found[None, None] == 2


def test_period_keeps_every_source_within_one_block():
    draw = random.Random(2)
    for _ in range(30):
        parts = {f"s{i}": draw.randint(1, 60) for i in range(draw.randint(1, 12))}
        total, slots = sum(parts.values()), pf.period(parts)
        assert sorted(t for own in slots.values() for t in own) == list(range(total))
        for s, own in slots.items():
            for t in range(total + 1):
                done = sum(x < t for x in own)
                assert abs(done - parts[s] * t / total) < 1


def lags_within_one(rows, parts, block_rows):
    """Replays the schedule slot by slot, with shares that change as sources run out."""
    blocks = {}
    for r in rows:
        assert blocks.setdefault((r.source, r.block), r.slot) == r.slot
    order = sorted(blocks, key=blocks.get)
    assert sorted(blocks.values()) == list(range(len(blocks)))
    left = Counter(s for s, _ in blocks)
    done, due, seen = Counter(), Counter(), Counter()
    for source, block in order:
        assert block == seen[source]
        seen[source] += 1
        total = sum(parts[s] for s in left)
        for s in left:
            due[s] += parts[s] / total
        done[source] += 1
        assert all(abs(done[s] - due[s]) < 1 + 1e-9 for s in left)
        left[source] -= 1
        if not left[source]:
            del left[source]
            done, due = Counter(), Counter()


def test_all_documents_are_mixed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    parts = {}

    def targets(counts):
        parts.update({s: 1 + i * 7 % 13 for i, s in enumerate(sorted(counts))})
        return parts

    rows = pf.mixed(docs, targets, block_rows=4).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in docs.collect())
    assert len({(r.source, r.block, r.place) for r in rows}) == len(rows)
    lags_within_one(rows, parts, 4)


def test_odd_rows_are_mixed(documents, odd_rows):
    out = pf.mixed(documents(odd_rows), block_rows=2, text="text")
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    assert Counter(r.text for r in rows) == Counter(r[1] for r in odd_rows)
    counts = Counter(r.source for r in rows)
    lags_within_one(rows, pf.tempered(counts), 2)
    assert pf.mixed(documents([])).count() == 0


def largest_lag(rows, weights):
    """Largest distance in blocks of any source from the fluid schedule, at the slots it uses and before them."""
    blocks = {(r.source, r.block): r.slot for r in rows}
    assert sorted(blocks.values()) == list(range(len(blocks)))
    counts = Counter(s for s, _ in blocks)
    names = sorted(counts, key=lambda s: (s is not None, s))
    w, b = np.array([float(weights[s]) for s in names]), np.array([float(counts[s]) for s in names])
    clock = np.unique(np.concatenate([b / w, np.linspace(0, (b / w).max(), 2000)]))
    sent = np.array([np.minimum(w * v, b).sum() for v in clock])
    worst = 0
    for s, weight, own in zip(names, w, b):
        slots = np.array([blocks[s, j] for j in range(int(own))])
        assert (np.diff(slots) > 0).all()
        for at, done in ((slots, np.arange(own)), (slots + 1, np.arange(1, own + 1))):
            fluid = np.minimum(weight * np.interp(at, sent, clock), own)
            worst = max(worst, np.abs(fluid - done).max())
    return worst


def test_more_sources_than_one_schedule_holds(documents):
    n = pf.MAX_SOURCES + 100
    names = ["hot"] * 1200 + [f"d{i % n}.org" for i in range(2 * n + 300)] + [None] * 40 + [""] * 9
    rows = [(i, f"t{i}", "en", s, 1, "x", "y", "z") for i, s in enumerate(names)]
    out = pf.mixed(documents(rows), block_rows=2).collect()
    assert sorted((r.doc_id, r.source) for r in out if r.source) == sorted((i, s) for i, s in enumerate(names) if s)
    assert len({(r.source, r.block, r.place) for r in out}) == len(rows) == len(out)
    assert largest_lag(out, {s: k**0.5 for s, k in Counter(names).items()}) < 2


def test_longer_schedules_than_one_period_table(monkeypatch, documents):
    names = [f"s{i % 7 * (i % 3)}" for i in range(400)]
    rows = [(i, f"t{i}", "en", s, 1, "x", "y", "z") for i, s in enumerate(names)]
    parts = {s: 1_000_003 + 400_000 * i for i, s in enumerate(sorted(set(names)))}
    out = pf.mixed(documents(rows), lambda counts: parts, block_rows=2).collect()
    assert sorted(r.doc_id for r in out) == list(range(400))
    assert largest_lag(out, parts) < 2
    monkeypatch.setattr(pf, "MAX_SOURCES", 3)
    again = pf.mixed(documents(rows), lambda counts: parts, block_rows=2).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))


def test_a_replaced_word_of_a_short_item_is_found(spark, documents):
    """An item of 85 characters with one word of seven letters replaced; and growing runs miss nothing."""
    item = "harvest moons rise over quiet hills while distant rivers carry silver leaves to seas "
    assert len(item.strip()) in (84, 85)
    text = "before it " + item.replace("distant", "bzzqkww") + "after it"
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    (row,) = em.contaminated(documents([(1, text, "en", "s", 1, "x", "y", "z")]), items).collect()
    assert row.doc_id == 1 and "7" in str(row)

    draw = random.Random(4)
    p = em.Matcher([(1, em.normal([item])[0])], 0.1)
    plain = p.patterns[0]
    found = 0
    for _ in range(400):
        noisy = list(plain.text)
        for _ in range(draw.randint(0, 11)):
            i = draw.randrange(len(noisy))
            noisy[i : i + draw.randint(0, 1)] = draw.choice(["", "q", "e", " "])
        around = "xx " + "".join(noisy) + " yy"
        least, _ = plain.best(around)
        got = p.matches(around)
        assert (least <= plain.budget) == bool(got) and all(m["distance"] == least for m in got)
        found += bool(got)
    assert 50 < found < 400


def spread(classes):
    """The class of every slot and its turn, with the turns that return written out."""
    seats = {}
    for i, turn, step, slot, period, repeats in pf.turns(classes):
        for n in range(repeats):
            assert seats.setdefault(slot + n * period, (i, turn + n * step)) == (i, turn + n * step)
    assert sorted(seats) == list(range(sum(n for _, n in classes)))
    return [seats[t] for t in range(len(seats))]


def class_lags(classes, seats):
    """Largest lag of a class behind or before its share of a phase, and of the fluid schedule."""
    weight, blocks = (np.array(x, dtype=float) for x in zip(*classes))
    clock = np.unique(np.concatenate([[0], blocks / weight]))
    sent = np.array([np.minimum(weight * v, blocks).sum() for v in clock])
    done, had, due = np.zeros(len(weight)), np.zeros(len(weight)), np.zeros(len(weight))
    phase = fluid = 0.0
    for slot, (i, turn) in enumerate(seats, 1):
        left = done < blocks
        assert turn == done[i] and left[i]
        due += np.where(left, weight, 0) / weight[left].sum()
        done[i] += 1
        had[i] += 1
        phase = max(phase, np.abs(had - due)[left].max())
        fluid = max(fluid, np.abs(np.minimum(weight * np.interp(slot, sent, clock), blocks) - done).max())
        if done[i] == blocks[i]:
            had[:], due[:] = 0, 0
    return phase, fluid


def test_every_class_is_within_one_block_of_its_share(monkeypatch):
    draw = random.Random(3)
    cases = [[(draw.randint(1, 60), draw.randint(1, 90)) for _ in range(draw.randint(1, 40))] for _ in range(30)]
    sizes = Counter(max(1, int(4000 / (i + 1) ** 0.9)) for i in range(5000))
    cases.append([(pf.tempered({0: n})[0] * m, -(-n // 16) * m) for n, m in sizes.items()])
    for classes in cases:
        seats = spread(classes)
        phase, fluid = class_lags(classes, seats)
        assert phase < 1 + 1e-9 and fluid < 2
    few = [(3, 700), (5, 40), (3, 2000), (8, 900)]
    whole = spread(few)
    for slots in (1, 100, 10**9):
        monkeypatch.setattr(pf, "_PERIOD_SLOTS", slots)
        assert spread(few) == whole
    monkeypatch.setattr(pf, "_PERIOD_SLOTS", 1)
    assert sum(1 for _ in pf.turns([(1, 10**12), (2, 10**12)])) < 20


def test_weights_do_not_depend_on_other_sources():
    few = {"a": 40_000, "b": 900, None: 1}
    many = few | {f"d{i}.org": 3 for i in range(5000)}
    weights = pf.tempered(many)
    assert pf.tempered(few) == {s: weights[s] for s in few}
    assert weights["a"] == 200 * weights[None] and weights["b"] == 30 * weights[None]


def test_many_sources_and_long_periods_keep_the_bound_of_few(documents):
    """The same schedule past a thousand sources and two million slots a period."""
    n = 1100
    names = ["hot"] * 1200 + [f"d{i % n}.org" for i in range(2 * n + 300)] + [None] * 40 + [""] * 9
    rows = [(i, f"t{i}", "en", s, 1, "x", "y", "z") for i, s in enumerate(names)]
    lags_within_one(pf.mixed(documents(rows), block_rows=2).collect(), pf.tempered(Counter(names)), 2)
    names = [f"s{i % 7 * (i % 3)}" for i in range(400)]
    rows = [(i, f"t{i}", "en", s, 1, "x", "y", "z") for i, s in enumerate(names)]
    parts = {s: 1_000_003 + 400_000 * i for i, s in enumerate(sorted(set(names)))}
    lags_within_one(pf.mixed(documents(rows), lambda counts: parts, block_rows=2).collect(), parts, 2)
