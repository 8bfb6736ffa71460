"""Secrets, fingerprints, lines and token counts against plain versions over every document."""

from __future__ import annotations

import hashlib
import re

import duckdb
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from starhouse.llm import (
    dart_minhash,
    edit_matching,
    language_crf,
    line_spread,
    one_permutation,
    pfair_mix,
    queries,
    secret_links,
    token_cache,
)
from starhouse.llm.common import table

KEY = "password|passwd|secret|token|api_?key".split("|")


def base_spans(text):
    out = []
    pattern = re.compile(
        "(?:" + "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k) for k in KEY) + ")"
        """["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    out += [(m.start(), 0, m.end()) for m in pattern.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def digest(spans):
    text = ",".join(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" for s, k, e in spans)
    return hashlib.sha256(text.encode()).hexdigest()


PLANTED = [
    "𝒳𝒴 PASSWORD = 'hunter22' and token:abc and secret=token=abcdefg",
    "api_key: token: abcdef0123 passwdpasswd=123456",
    "AKIAAKIA" + "A" * 12 + " AKIA" + "B" * 15 + " AKIA" + "C" * 40,
    "f" * 23 + " " + "0123456789abcdef" * 2 + "G" + "e" * 24,
    "paſſword=longenough Key toKen=longenough",
    "secret=" + "x" * 5 + " secret==" + "y" * 5,
]


def test_base_spans_of_every_document(spark, sf_dir, documents):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    extra = {10_000_000 + i: t for i, t in enumerate(PLANTED)}
    docs = docs.union(spark.createDataFrame(list(extra.items()), docs.schema))
    texts |= extra
    rows = secret_links.report(docs).collect()
    assert len(rows) == len(texts)
    assert any(r.n_assign for r in rows) and any(r.n_access for r in rows)
    for r in rows:
        want = base_spans(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in want) for i in range(3)]
        assert r.base_sha256 == digest(want)
        assert all(f"{('assign', 'access', 'hex')[k]}:{s}:{e}" in r.spans for s, k, e in want)


def linked_by_definition(text, scope):
    """All six kinds anew: spans, whose text is whose, and who has a complement within the scope."""
    strong = base_spans(text)
    names = r"(?i:access_?key_?id|client_?id|user_?name|user_?id|login|account)"
    weak = {
        3: [m.span() for m in re.finditer(names + r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{4,}""", text)],
        4: [
            m.span()
            for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", text)
            if re.search("[A-Z]", m[0]) and re.search("[a-z]", m[0]) and re.search("[0-9]", m[0])
        ],
        5: [m.span() for m in re.finditer(r"""(?:https?|jdbc:[A-Za-z0-9_]+|postgres|mysql|mongodb|redis|amqp)://[^\s"'<>]{4,}""", text)],
    }
    owner = [None] * len(text)
    parts = []
    for kind, start, end in [(k, s, e) for s, k, e in strong] + [(k, *span) for k in (5, 3, 4) for span in weak[k]]:
        if not any(owner[start:end]):
            owner[start:end] = [True] * (end - start)
            parts.append((start, kind, end))
    role = {0: "secret", 1: "name", 2: "secret", 3: "name", 4: "secret", 5: "place"}

    def near(start, wanted):
        return any(role[k] == wanted and abs(s - start) <= scope for s, k, _ in parts)

    needs = {3: ["secret"], 4: ["name"], 5: ["name", "secret"]}
    linked = [p for p in parts if p[1] >= 3 and all(near(p[0], w) for w in needs[p[1]])]
    return sorted(strong + linked)


def test_no_part_completes_itself(documents):
    """A value inside an identifier, a piece of an address, a key inside an assignment."""
    texts = [
        "client_id: AbCdEf0123456789XyZw",
        "login: john_smith then see https://Example.com/Page1/AbcDefGhijklmnop2",
        "https://host.example/x secret=AKIA" + "Z" * 16,
        "see https://a.example/?user_name=robert and aB3aB3aB3aB3aB3aB3aB3aB3",
    ]
    rows = [(i, t, "en", "s", 1, "x", "y", "z") for i, t in enumerate(texts)]
    got = {r.doc_id: [(p.start, p.kind, p.end) for p in r.spans] for r in secret_links.find_secrets(documents(rows)).collect()}
    assert got == {i: base_spans(t) for i, t in enumerate(texts)}


def test_links_within_scopes(documents):
    blob, pad = "aB3" * 8, " filler"
    texts = []
    for gap in (0, 5, 20, 56, 57, 58, 60, 200):
        texts.append(f"user_name: robert{pad * gap} {blob}{pad * gap} https://host.example/x{pad * gap} token=abcdefgh")
        texts.append(f"{blob}{pad * gap} AKIA{'Z' * 16}{pad * gap} postgres://db/x {pad * gap} client_id=robert")
    texts += [blob, "https://host.example", "user_name=robert https://host.example", "login: someone " + " ".join([blob] * 300)]
    rows = [(i, t, "en", "s", 1, "x", "y", "z") for i, t in enumerate(texts)]
    got = {r.doc_id: [(p.start, p.kind, p.end) for p in r.spans] for r in secret_links.find_secrets(documents(rows)).collect()}
    want = {i: linked_by_definition(t, secret_links.SCOPE) for i, t in enumerate(texts)}
    assert got == want
    assert any(k >= 3 for spans in want.values() for _, k, _ in spans) and not want[16] and not want[17] and not want[18]


def test_odd_rows_have_no_secrets(documents, odd_rows):
    rows = secret_links.report(documents(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    assert {r.base_sha256 for r in rows} == {digest([])} and {r.spans for r in rows} == {""}
    assert secret_links.report(documents([])).count() == 0


def h(*values):
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else v.to_bytes(8, "little", signed=True) if not isinstance(v, tuple) else v[0]
        seed = xxhash.xxh64(data, seed=seed).intdigest()
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def h32(seed_and_int, k):
    """Spark's hash of two ints."""
    seed = xxhash.xxh64(seed_and_int.to_bytes(4, "little", signed=True), seed=42).intdigest()
    return xxhash.xxh64(k.to_bytes(4, "little", signed=True), seed=seed).intdigest()


def plain_shingles(text):
    words = re.findall(r"[^\W_]+", text.lower())
    hashed = [h(w) for w in words]
    if len(words) >= 5:
        return [h(*hashed[i : i + 5]) for i in range(len(words) - 4)]
    return None


def jaccard(a, b):
    x, y = set(plain_shingles(a)), set(plain_shingles(b))
    return len(x & y) / len(x | y)


def test_shingle_hashes(spark, documents, prose):
    texts = [prose(60, i) for i in range(5)]
    rows = [(i, t, "en", "s", 1, "x", "y", "z") for i, t in enumerate(texts)]
    got = documents(rows).select("doc_id", one_permutation.shingle_hashes(F.col("text")).alias("h")).collect()
    assert {r.doc_id: r.h for r in got} == {i: plain_shingles(t) for i, t in enumerate(texts)}


def test_densification_copies_the_first_full_bin(spark, documents, prose):
    texts = [prose(n, n) for n in (5, 6, 9, 40, 300, 3000)]
    rows = [(i, t, "en", "s", 1, "x", "y", "z") for i, t in enumerate(texts)]
    minima = one_permutation.bin_minima(one_permutation.shingle_hashes(F.col("text")))
    got = documents(rows).select("doc_id", "text", minima.alias("m"), one_permutation.densified(minima).alias("d")).collect()
    empty = one_permutation._EMPTY
    for r in got:
        by_bin = {}
        for x in plain_shingles(r.text):
            by_bin[x >> 56] = min(by_bin.get(x >> 56, x), x)
        assert [x for x in r.m if x & empty != empty] == [by_bin[b] for b in sorted(by_bin)]
        assert len(r.m) == len(r.d) == one_permutation.BINS and set(r.d) <= set(by_bin.values())
        for i, (m, d) in enumerate(zip(r.m, r.d)):
            full = [r.m[h32(i, k) % 256 if h32(i, k) < 1 << 63 else (h32(i, k) - (1 << 64)) % 256] for k in range(6)]
            full = [x for x in [m, *full] if x & empty != empty]
            if full:
                assert d == full[0]


def test_edited_texts_of_every_document(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    texts = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    rows = {r.doc_id: r for r in one_permutation.edited(docs).collect()}
    assert len(rows) == len(texts)
    errors, prints = [], {}
    for (d, t), (_, after) in zip(texts, texts[1:] + texts[:1]):
        m = len(t) // 4
        edited = t[: len(t) - m] + after[:m]
        r = rows[d]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if plain_shingles(t) and plain_shingles(edited) and plain_shingles(after):
            errors += [r.near_edited - jaccard(t, edited), r.near_next - jaccard(t, after)]
    assert abs(sum(errors) / len(errors)) < 0.01 and max(map(abs, errors)) < 0.3


def test_odd_rows_are_fingerprinted(documents, odd_rows):
    rows = one_permutation.edited(documents(odd_rows)).collect()
    assert len(rows) == len(odd_rows)
    empty = [r for r in rows if r.n_chars == 0]
    assert {r.fingerprint for r in empty} == {"0" * 512} and len(empty) == 3
    assert all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in rows)
    assert one_permutation.edited(documents([])).count() == 0
    alone = one_permutation.edited(documents([(1, "abcdefgh", None, None, None, None, None, None)])).collect()
    assert alone[0].near_next == 1 and alone[0].edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_lines_across_sites(documents):
    common, rare = "All rights reserved.", "Seen on few sites."
    rows = []
    for i in range(40):
        text = f"own line {i}\n  {common} \n\n" + (rare if i % 20 < 3 else f"other {i}") + f"\n{common}"
        rows.append((i, text, "en", f"s{i % 20}", 1, "x", "y", "z"))
    out = {r.doc_id: r for r in line_spread.without_boilerplate(documents(rows)).collect()}
    assert out[0].text.count(common) == 1 and rare in out[0].text and out[0].n_removed == 1
    for i in range(1, 40):
        assert common not in out[i].text and out[i].n_removed == 2 and out[i].n_lines == 5
        assert (rare in out[i].text) == (i % 20 < 3)


@pytest.mark.parametrize("sites", [9, 10, 11, 12, 60])
def test_exact_at_the_threshold(documents, sites):
    rows = [(i, f"own {i}\nshared line", "en", f"s{i % sites}", 1, "x", "y", "z") for i in range(sites * 2)]
    removed = line_spread.without_boilerplate(documents(rows), min_sites=10).agg(F.sum("n_removed")).first()[0]
    assert removed == (sites * 2 - 1 if sites >= 10 else 0)


@pytest.mark.parametrize("site", [lambda i: f"s{i % 9}", lambda i: "hot" if i % 3 == 0 else f"s{i % 8}", lambda i: f"s{i % 60}"])
def test_registered_query_takes_the_sites_from_the_corpus(spark, documents, tmp_path, site):
    """Few sites, one with a third of the copies, and many; the SQL states the same rule."""
    rows = [(i, f"own {i}\nshared line\n" + ("rare" if i < 2 else f"other {i}"), "en", site(i), 1, "x", "y", "z") for i in range(90)]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.op7_line_spread(spark, str(tmp_path)).collect()
    assert sum(r.n_removed for r in got) == 89
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(f"SELECT doc_id, n_lines, n_removed, text FROM ({line_spread.oracle()}) ORDER BY 1").fetchall()
    assert sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got) == want


def test_columns_with_the_operators_own_names_stay(spark, documents, prose):
    """Every general interface returns the caller's columns, whatever they are called."""
    names = ["_doc", "_gone", "_key", "_row", "_none", "_range", "_start", "_before", "_index", "_node", "_id", "_matches", "_label"]
    docs = documents([(i, prose(30, i), "en", f"s{i % 3}", 1, "x", "y", "z") for i in range(6)]).drop("_doc")
    docs = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])
    items = spark.createDataFrame([(1, "no such passage in any of these documents at all")], "item_id bigint, text string")
    model = language_crf.train(docs)
    for out in (
        line_spread.without_boilerplate(docs),
        pfair_mix.mixed(docs),
        dart_minhash.deduplicated(docs),
        edit_matching.decontaminated(docs, items),
        language_crf.with_language(docs, model),
    ):
        rows = out.collect()
        assert len(rows) == 6 and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)


def test_a_class_keeps_its_smallest_real_id(documents, prose):
    text = prose(40, 1)
    rows = [(i, text, "en", "s", 1, "x", "y", "z") for i in (None, 3, 8)]
    assert [r.doc_id for r in dart_minhash.deduplicated(documents(rows)).collect()] == [3]


def test_threshold_follows_the_sites(spark, documents):
    passage = "A passage that many documents of this corpus share."

    def kept(site, copies):
        rows = [(i, f"own {i}" + f"\n{passage}" * (i in copies), "en", site(i), 1, "x", "y", "z") for i in range(180)]
        out = corpus_pipeline.dedup_lines(spark, documents(rows), "").collect()
        assert len(out) == 180
        return sum(passage in r.text for r in out)

    def hot(i):
        return "hot" if i % 3 == 0 else f"s{i % 20}"

    copies = [i for i in range(180) if i % 3 == 0][:4] + [i for i in range(20) if i % 3][:8]
    assert len({hot(i) for i in copies}) == 9
    assert kept(hot, copies) == 1
    assert kept(lambda i: f"s{i % 5}", range(40)) == 1
    assert kept(lambda i: f"s{i % 20}", range(9)) == 9
    assert kept(lambda i: f"s{i % 20}", range(10)) == 1
    assert line_spread.threshold(documents([])) == line_spread.MIN_SITES


def test_odd_rows_keep_their_lines(documents, odd_rows):
    out = line_spread.without_boilerplate(documents(odd_rows), min_sites=2)
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    assert all(r.text is not None for r in rows)
    words = [r.text for r in rows if r.doc_id == 4]
    assert sorted(words) == ["other word", "word", "word"]
    assert line_spread.without_boilerplate(documents([])).count() == 0


TOKENIZERS = [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False), ("piece_bpe_32k.model", False)]
SPECIAL = ["a <|endoftext|> b", "x<|startoftext|>y's", "é é İ   \x1c  z", "don't we'll\tI'd\r\n 12345 ?!?"]


@pytest.mark.parametrize("name, splits", TOKENIZERS)
def test_counts_are_the_librarys(spark, sf_dir, tmp_path, documents, odd_rows, name, splits):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    docs = documents(odd_rows).select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(SPECIAL)], docs.schema))
    docs = docs.union(table(spark, sf_dir, "documents").filter("doc_id % 3 = 0").select(F.col("doc_id") + 1000, "text"))
    counts = token_cache.count_tokens(docs, path, str(tmp_path / "cache"), splits)
    if name.endswith(".model"):
        import sentencepiece

        encode = sentencepiece.SentencePieceProcessor(model_file=path).encode
    else:
        tokenizer = Tokenizer.from_file(path)
        encode = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    want = sorted(((r.doc_id, len((r.text or "").encode()), len(encode(r.text or ""))) for r in docs.collect()), key=str)
    got = counts.collect()
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=str) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)


def test_cache_is_used_and_extended(spark, tmp_path, documents, monkeypatch):
    import public_tokenizers

    path, cache = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "cache")
    first = documents([(1, "one two", None, None, None, None, None, None), (2, "one  two ", None, None, None, None, None, None)])
    assert [r.n_tokens for r in token_cache.count_tokens(first, path, cache, True).collect()] == [2, 2]
    assert spark.read.parquet(cache).count() == 1
    second = documents([(3, "\tone two", None, None, None, None, None, None), (4, "three", None, None, None, None, None, None)])
    assert sorted(r.n_tokens for r in token_cache.count_tokens(second, path, cache, True).collect()) == [1, 2]
    assert spark.read.parquet(cache).count() == 2
    assert token_cache.count_tokens(documents([]), path, cache, True).count() == 0
    assert spark.read.parquet(cache).count() == 2
