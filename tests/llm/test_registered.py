"""Registered queries with SQL against it, and each pipeline stage against a plain version of it."""

from __future__ import annotations

import re
from collections import Counter

import duckdb
import pytest
from compare import differences
from test_matching_and_mix import lags_within_one
from test_language import plain_familiar
from test_near_duplicates import brute

import __spark_entry__ as driver
import corpus_pipeline
from starhouse.llm import edit_matching, language_crf, line_spread, pfair_mix, queries
from starhouse.llm.common import DOCUMENT_COLUMNS, table

SMALL = "/root/testdata/sf0.001"


def connect(sf_dir):
    con = duckdb.connect()
    for name in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def test_every_operator_is_registered_once():
    numbers = sorted(int(re.match(r"op(\d+)_", key)[1]) for key in queries.jobs())
    assert numbers == sorted(set(numbers)) and set(range(1, 14)) == set(numbers)
    assert set(queries.jobs()) | {"pipeline"} <= set(driver.queries())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "lines", "near_duplicates", "decontamination", "mix"]


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_matches_sql(spark, sf_dir, key):
    assert differences(driver.queries()[key](spark, sf_dir), connect(sf_dir), queries.oracle_sql()[key]) == []


def collected(df):
    return [tuple(r) for r in df.select(*DOCUMENT_COLUMNS).collect()]


def check_stages(spark, docs, sf_dir, tmp_path):
    """Runs the stages; each result is compared with what a plain version makes of its input."""
    by_stage = {}
    for name, stage in corpus_pipeline.STAGES:
        before = collected(docs)
        docs = stage(spark, docs, sf_dir)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        by_stage[name] = before, docs
        if name != "mix":
            assert docs.columns == list(DOCUMENT_COLUMNS)

    before, after = by_stage["language"]
    model = language_crf.train(spark.createDataFrame(before, after.schema))
    kept = [r for r in before if plain_familiar(model, r[1] or "") >= corpus_pipeline.MIN_FAMILIAR]
    assert Counter(collected(after)) == Counter(kept)

    before, after = by_stage["lines"]
    needed = line_spread.threshold(spark.createDataFrame(before, after.schema))
    first, sites = {}, {}
    for doc, text, _, site, _ in before:
        for i, line in enumerate((text or "").split("\n")):
            if key := line.strip(" "):
                sites.setdefault(key, set()).add(site)
                first[key] = min(first.get(key, (doc, i)), (doc, i))
    want = []
    for doc, text, lang, site, _ in before:
        lines = [
            line
            for i, line in enumerate((text or "").split("\n"))
            if not line.strip(" ")
            or len(sites[line.strip(" ")]) < needed
            or first[line.strip(" ")] == (doc, i)
        ]
        want.append((doc, "\n".join(lines), lang, site, len("\n".join(lines))))
    assert Counter(collected(after)) == Counter(want)

    before, after = by_stage["near_duplicates"]
    assert {r[0] for r in collected(after)} == {c for _, c in brute([r[:2] for r in before])}
    assert set(collected(after)) <= set(before)

    before, after = by_stage["decontamination"]
    items = table(spark, sf_dir, "benchmark").collect()
    matcher = edit_matching.Matcher([(r.item_id, t) for r, t in zip(items, edit_matching.normal([r.text for r in items]))], 0)
    clean = [r for r, t in zip(before, edit_matching.normal([r[1] for r in before])) if not matcher.matches(t)]
    assert set(collected(after)) <= set(clean) and len(clean) - len(collected(after)) <= 2

    before, after = by_stage["mix"]
    rows = after.collect()
    assert Counter(collected(after)) == Counter(before)
    lags_within_one(rows, pfair_mix.tempered(Counter(r.source for r in rows)), pfair_mix.BLOCK_ROWS)
    return by_stage


def test_stages_on_documents(spark, tmp_path):
    check_stages(spark, table(spark, SMALL, "documents"), SMALL, tmp_path)
    assert corpus_pipeline.run(spark, SMALL).count() == spark.read.parquet(str(tmp_path / "mix")).count()


def test_stages_take_odd_rows(spark, tmp_path, documents, odd_rows):
    docs = documents(odd_rows)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert set(DOCUMENT_COLUMNS) <= set(docs.columns)
    none = documents([])
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, none, SMALL)
    assert none.count() == 0
