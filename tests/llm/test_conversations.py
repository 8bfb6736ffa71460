"""Repair of conversations against a search over all edits, in chunks of few rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import cache

import duckdb
from compare import differences

from starhouse.llm import conversation_repair as cr

SCHEMA = "conv_id bigint, turn bigint, role string, text string, _conv string, _chunk string, dropped_ string"
SOUND = re.compile(r"(s?(ua)+)?")


def cheapest(rows):
    """Least cost, then least audit, over all ways to edit (role, text, must go, truncated) rows; by forward search."""
    paths = {"": [(0, "", ())]}

    def grow(paths):
        for _ in range(2):
            for initials, found in list(paths.items()):
                for role in ("user", "assistant"):
                    if possible(initials + role[0]):
                        more = [(c + 2, a + "I", t + ((role, ""),)) for c, a, t in found]
                        put(paths, initials + role[0], more)
        return paths

    def put(paths, initials, more):
        key = squeezed(initials)
        paths[key] = [min(paths.get(key, []) + more)]

    def squeezed(initials):
        """What the future depends on: whether there is an s, and the last initial."""
        return initials if len(initials) < 2 else initials[:1] * (initials[0] == "s") + ("ua" if initials[-1] == "a" else "u")

    @cache
    def possible(initials):
        return any(SOUND.fullmatch(initials + tail) for tail in ("", "a", "ua"))

    paths = grow(paths)
    for role, text, gone, cut in rows:
        now = {}
        for initials, found in paths.items():
            put(now, initials, [(c + 3, a + "D", t) for c, a, t in found])
            if gone:
                continue
            for letter, cost, new in (("K", 0, role), ("R", 2, "user"), ("R", 2, "assistant")):
                if new[:1] in ("s", "u", "a") and possible(initials + new[:1]):
                    put(now, initials + new[:1], [(c + cost + cut, a + letter, t + ((new, text),)) for c, a, t in found])
        paths = grow(now)
    return min(f for initials, found in paths.items() if SOUND.fullmatch(initials) for f in found)


def expected(rows):
    out, convs = [], {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kept = convs.setdefault(conv, [])
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        kept += [] if fault == 0 else [(turn, role, text)] * (2 if fault == 3 else 1)
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest()))
        seen, marked, counts = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in kept:
            solid = text.strip(" \t\n\x0b\f\r")
            fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [r[0] for r in kept if r[0] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(kept, kept[1:]))
        cost, audit, text = cheapest(marked)
        whole = "\n".join(f"{r}:{t}" for r, t in text)
        out.append((conv, gaps, *counts.values(), illegal, cost, audit, hashlib.sha256(whole.encode()).hexdigest()))
    return out


COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def made(seed, n_convs, longest):
    draw = random.Random(seed)
    rows = []
    for conv in range(n_convs):
        roles = draw.choice(["user assistant".split(), "system user assistant tool".split(), ["system"], ["user"], ["assistant", ""]])
        for turn in range(draw.randint(1, longest)):
            text = draw.choice(["Well.", "Yes", "", " \n", "So? ", "no end", f"a {turn}.", f"b {turn}", None])
            rows.append((conv, draw.choice([turn, turn, turn, None, 3]), draw.choice([*roles, *roles, None]), text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_cheapest_edits_across_chunks(spark):
    rows = made(3, 60, 14) + [(None, None, None, None), (None, 2, "user", "Hi."), (-5, None, "user", "Long."), (-5, None, "user", "Long.")]
    rows += [r for r in rows if r[0] == 7]
    want = sorted(expected(rows), key=str)
    for chunk_rows in (2, 5, 256):
        assert found(cr.report(cr.damaged(frame(spark, rows)), chunk_rows)) == want
    assert cr.report(cr.damaged(frame(spark, []))).count() == 0


def test_passes_for_what_never_converges(spark, monkeypatch):
    """Runs of system rows keep a difference for ever; a conversation of many chunks takes few passes."""
    monkeypatch.setattr(cr, "GROWTH", 4)
    passes = []
    rerun = cr._rerun
    monkeypatch.setattr(cr, "_rerun", lambda *a: passes.append(a[1:]) or rerun(*a))
    rows = [(1, i, "system", f"t {i}.") for i in range(401)] + [(1, 500 + i, "user", "same.") for i in range(200)]
    rows += [(2, i, "user" if i % 2 else "assistant", f"t {i}.") for i in range(300)]
    assert found(cr.report(cr.damaged(frame(spark, rows)), 4)) == sorted(expected(rows), key=str)
    assert 2 <= len(passes) <= 12


def test_matches_sql(spark):
    rows = made(9, 40, 9)
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert differences(cr.report(cr.damaged(frame(spark, rows)), 3), con, cr.oracle()) == []


def test_repaired_rows_are_sound(spark):
    rows = made(4, 30, 10)
    got = cr.repaired(frame(spark, rows), 3).collect()
    audits = {r.conv_id: r.audit for r in cr.report(frame(spark, rows), 3).collect()}
    by_conv = {}
    for r in sorted(got, key=lambda r: (r.conv_id, r.place)):
        by_conv.setdefault(r.conv_id, []).append(r)
    for conv, audit in audits.items():
        own = by_conv.get(conv, [])
        assert [r.place for r in own] == list(range(len(own)))
        assert SOUND.fullmatch("".join(r.role[0] for r in own))
        assert "".join(r.edit for r in own) == audit.replace("D", "")
