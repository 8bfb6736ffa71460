"""Archives by exact round trip, the filter cascade by brute force over its universe."""

from __future__ import annotations

import gzip
import hashlib
import re

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from starhouse.llm import url_cascade as uc
from starhouse.llm import warc_chunks as wc
from starhouse.llm.common import table
from starhouse.scratch import scratch_path

PAGES = "page_id bigint, url string, html string, record_id string, digest string, listed boolean"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", True) for r in rows], PAGES)


ODD = [
    (1, "http://a.net/x", "p" * 100),
    (2, "http://a.net/y", "p" * 100),
    (2, "http://a.net/y", "p" * 100),
    (None, "http://b.net/", "p" * 100),
    (3, None, "q" * 99),
    (4, "http://c.org\r\nX: y/", "q" * 99),
    (5, "no scheme", None),
    (6, None, ""),
    (7, "http://d.com", "line\r\n\r\nWARC/1.1\r\n\r\n" * 30_000 + "é𝒳" * 40_000),
    (8, "http://d.com", "line\r\n\r\nWARC/1.1\r\n\r\n" * 30_000 + "é𝒳" * 40_000),
    (9, "http://e.com", "z" * (wc.CHUNK_CHARS * 3)),
    (10, "http://e.com", "\r\n" * 60),
]


def expected(rows):
    """A row a record: the first of equal payloads by page_id (null last) and url is the response."""
    out, first = [], {}
    for page, url, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        payload = (html or "").encode()
        again = len(payload) >= 100 and payload in first
        kind = ("revisit", first[payload]) if again else ("response", None)
        first.setdefault(payload, page)
        out.append((page, len(payload), hashlib.sha256(payload).hexdigest(), *kind))
    return sorted(out, key=str)


def test_odd_pages_round_trip(spark):
    rows = wc.round_trip(pages(spark, ODD)).collect()
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows]
    assert sorted(got, key=str) == expected(ODD)
    assert wc.round_trip(pages(spark, [])).count() == 0


def test_repeated_rows_are_records_of_their_own(spark):
    """Also against the registered SQL."""
    rows = ODD * 3 + [(1, "http://a.net/x", "p" * 100)] * 50 + [(1, "http://0.net/", "p" * 100), (11, "u", "small")] * 2
    frame = pages(spark, rows)
    got = sorted((tuple(r) for r in wc.round_trip(frame).collect()), key=str)
    assert len(got) == len(rows) and got == expected(rows)
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url", "html"]).astype({"page_id": "Int64"}))
    assert sorted(con.execute(wc.oracle()).fetchall(), key=str) == got


def test_payloads_survive(spark):
    path = scratch_path(spark, "test-warc")
    wc.write(pages(spark, ODD), path)
    pieces = wc.read_chunks(spark, path).filter("data is not null").orderBy("segment", "piece").collect()
    assert max(len(p.data) for p in pieces) <= wc.PIECE_BYTES
    whole = {}
    for p in {(p.record_id, p.segment, p.piece): p for p in pieces}.values():
        whole.setdefault(p.record_id, []).append(bytes(p.data))
    assert {b"".join(v) for v in whole.values()} == {r[2].encode() for r in ODD if r[0] in (7, 9)}


def test_archives_of_others():
    """Several gzip members, none, unknown kinds of records, and a payload of many pieces."""
    record = lambda kind, block, more=b"": b"WARC/1.0\r\nWARC-Type: " + kind + b"\r\nWARC-Record-ID: <i>\r\n" + more + (
        b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"
    )
    http = b"Content-Type: application/http; msgtype=response\r\n"
    large = bytes(range(256)) * 1000
    parts = [
        record(b"warcinfo", b"software: x"),
        record(b"response", b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n" + large, http),
        record(b"response", b"HTTP/1.1 200 OK\r\n\r\n", http),
        record(b"request", b"GET / HTTP/1.1\r\n\r\n" * 9000),
    ]
    for content in (b"".join(parts), b"".join(map(gzip.compress, parts)), gzip.compress(b"".join(parts))):
        rows = list(wc.chunks_of(content))
        assert b"".join(r["data"] for r in rows[:-1]) == large
        assert len(rows) == 5 and rows[-1]["n_bytes"] == 0 and rows[-1]["digest"] == hashlib.sha256(b"").hexdigest()


def test_every_page_round_trips(spark, sf_dir):
    source = table(spark, sf_dir, "pages")
    want = expected([(r.page_id, r.url, r.html) for r in source.collect()])
    got = [tuple(r) for r in wc.round_trip(source).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(got, key=str) == want


def test_cascade_is_exact_on_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"))
    for share in (2, 10, 300, 20_001):
        listed = universe.filter(F.crc32("key") % share == 0)
        levels = uc.cascade(universe, listed)
        words = [F.lit(level.words.first().words) for level in levels]
        got = universe.filter(uc.member(levels, F.col("key"), words)).collect()
        assert sorted(r.key for r in got) == sorted(r.key for r in listed.collect())
        if share == 300:
            assert len(levels) > 1
    assert uc.cascade(universe, universe.limit(0)) == []
    everything = uc.cascade(universe, universe)
    assert len(everything) == 1


URLS = [
    None, "", "no scheme/en/", "HTTP://WWW.Example.NET/en/x?q#f", "http://example.net/EN/x", "x://net", "x://net/", "x://internet/a",
    "http://a.example.com/de/", "http://a.example.com/de", "http://example.org/fr/?x", "http://example.org?/fr/", "a://b://c/d",
    "http://free-bets.example.com/x", "http://m.free-bets.example.com/x", "http://xfree-bets.example.com/x", "http://free-bets/x",
    "http://spam-farm.example.org/fr/a", "http://SPAM-farm.example.co/#x", "http://a..b/", "http://ÄÖ.example.net/en/", "x://h\n/p\nq?r",
]


def judge(url):
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = match.groups() if match else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in uc.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        rule = max(fits, key=lambda r: len(r.name))
        return host, path, rule.name, rule.verdict
    labels = host.split(".")
    blocked = any(x in uc.LISTED_NAMES for x in labels[:-1])
    return host, path, None, "block" if blocked else "allow"


def test_odd_urls(spark):
    rows = pages(spark, [(i, u, None) for i, u in enumerate(URLS + URLS[:3])])
    out = uc.judged(rows, uc.RULES, uc.listed_domains(rows)).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out}
    assert len(out) == len(URLS) + 3
    assert got == {i: judge(u) for i, u in enumerate(URLS + URLS[:3])}
    none = pages(spark, [])
    assert uc.judged(none, uc.RULES, uc.listed_domains(none)).count() == 0


def test_larger_lists_are_dealt_into_shards(spark, monkeypatch):
    """Exact on the whole universe, whatever the number of shards; each shard's filters are within the bound."""
    rows = spark.range(3000).select("id", F.array(F.concat(F.lit("a"), "id"), F.concat(F.lit("b"), F.col("id") % 7)).alias("keys"), F.lit("x").alias("listed"))
    listed = spark.range(4000).select(F.concat(F.lit("a"), "id").alias("key")).filter(F.crc32("key") % 3 == 0)
    want = {r.key for r in listed.collect()}
    made = []
    plain = uc.cascade

    def seen(universe, own):
        levels = plain(universe, own)
        made.append(sum(level.n_words for level in levels))
        return levels

    monkeypatch.setattr(uc, "cascade", seen)
    for bound, shards in ((1_000_000, 1), (50, 3)):
        monkeypatch.setattr(uc, "MAX_WORDS", bound)
        made.clear()
        got = uc.with_listed(rows, F.col("keys"), listed).collect()
        assert len(got) == 3000 and {r.id for r in got if r.listed} == {r.id for r in got if f"a{r.id}" in want}
        assert len(made) >= shards and all(n <= bound * 1.5 for n in made)
    pages_ = pages(spark, [(i, u, None) for i, u in enumerate(URLS)] + [(0, URLS[0], None)])
    monkeypatch.setattr(uc, "MAX_WORDS", 0.05)
    out = uc.judged(pages_, uc.RULES, uc.listed_domains(pages_)).collect()
    assert len(out) == len(URLS) + 1
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out} == {i: judge(u) for i, u in enumerate(URLS)}
