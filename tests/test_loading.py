from __future__ import annotations

from datetime import timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from planted import BOTH, HALE, HEALTH_LOADED, HEALTH_ROWS, LE, LE60, MORT, frames
from pyspark.sql import functions as F

from starhouse import HEALTH
from starhouse.operators.loading import build_country_dim, keyed_update, match_ignoring_case, record_id, with_outcome
from starhouse.operators.rules import split, strict
from starhouse.plans import core, refresh
from starhouse.plans.refresh import SUMMARY_SCHEMA, RefreshRejected, changes, publish_repaired, refresh_core, replay_rejects, staging_gate
from starhouse.plans.views import VIEWS, publish_views
from starhouse.plans.warehouse import DerivedWarehouse, PublishedWarehouse
from starhouse.schemas import COMM_FACT, FACTS, HEALTH_FACT, NCD_FACT, STG_COMM, STG_COUNTRY, STG_HEALTH, staging_schema
from starhouse.scratch import shared_folder
from starhouse.sinks.versions import manifests, new_version, publish, published_summary, published_version, remove_unreachable


def test_country_dimension(wh):
    rows = {r.country_code: r for r in wh.country().collect()}
    assert set(rows) == {"AAA", "BBB", "CCC", "DDD", "EEE"}
    assert {rows["AAA"].region_name, rows["BBB"].region_name} == {"Africa"}
    assert rows["DDD"].country_name == "Delta"


def test_loaded_rows_and_reasons(wh, spark):
    assert wh.health.count() == HEALTH_LOADED
    outcome = with_outcome(wh.stg(STG_HEALTH), HEALTH_FACT, wh.dims(), HEALTH)
    counts = {r.outcome: r["count"] for r in outcome.groupBy("outcome").count().collect()}
    assert counts == {
        "loaded": HEALTH_LOADED,
        "not_country": 1,
        "bad_year": 3,
        "bad_value": 5,
        "unknown_country": 2,
        "unknown_category": 1,
        "unknown_sex": 1,
        "rule_rejected": 3,
    }
    assert sum(counts.values()) == len(HEALTH_ROWS)


def _bounds(wh, indicator, country, year=2021):
    row = wh.health.filter(
        (F.col("indicator_code") == indicator)
        & (F.col("country_code") == country)
        & (F.col("year_val") == year)
        & (F.col("sex_code") == BOTH)
    ).first()
    return row.low_ci, row.high_ci


def test_bounds_load_as_pairs(wh):
    assert _bounds(wh, LE, "AAA") == (Decimal(59), Decimal(61))
    assert _bounds(wh, LE60, "CCC") == (None, None)
    assert _bounds(wh, MORT, "AAA", 2007) == (None, None)
    assert _bounds(wh, HALE, "BBB") == (Decimal(9), Decimal(3))


def test_two_step_load_equals_one_pass(wh):
    for spec in FACTS:
        folded = wh.fact(spec).select(*spec.key, *core.BOUNDS)
        assert sorted(map(repr, core.fact_bounds(wh, spec).collect())) == sorted(
            map(repr, folded.collect())
        )


def test_death_counts_round(wh):
    value = wh.ncd.filter("country_code = 'BBB'").first().death_count
    assert value == Decimal("10.01")


def test_ids_are_dense_in_load_order(wh):
    rows = wh.health.orderBy("fact_id").collect()
    assert [r.fact_id for r in rows] == list(range(1, HEALTH_LOADED + 1))
    keys = [(r.year_val, r.indicator_code, r.country_code, r.sex_code) for r in rows]
    assert keys == sorted(keys)


def test_keyed_update_never_fans_out(spark):
    target = spark.createDataFrame([("a", 1, None), ("b", 2, 5), ("c", 3, None)], "k string, v int, w int")
    updates = spark.createDataFrame([("a", 9)] * 500 + [("a", 7), ("b", 6)], "k string, w int")
    rows = {tuple(r) for r in keyed_update(target, updates, ["k"], ["w"]).collect()}
    assert rows == {("a", 1, 7), ("b", 2, 6), ("c", 3, None)}


def test_loose_match(spark):
    left = spark.createDataFrame([("É ",), ("curaçao",), ("x",)], "a string")
    right = spark.createDataFrame([("e",), ("CURACAO",)], "b string")
    got = {tuple(r) for r in match_ignoring_case(left, right, "a", "b").collect()}
    assert got == {("É ", "e"), ("curaçao", "CURACAO")}


def test_reconciliation_adds_up(wh):
    for row in core.reconciliation(wh).collect():
        reasons = sum(row[c] for c in core.OUTCOMES[1:])
        assert row.staged_rows == row.core_rows + row.filtered_out
        assert row.filtered_out == reasons


def test_split_keeps_every_row_with_its_reason(wh):
    from starhouse.plans.quality import rule_candidates

    candidates = rule_candidates(wh)
    accepted, rejects = split(candidates, HEALTH_FACT, HEALTH)
    assert accepted.count() + rejects.count() == candidates.count()
    assert sorted(r.reason for r in rejects.collect()) == [
        "negative_value",
        "year_out_of_range",
        "year_out_of_range",
    ]


def test_strict_mode_aborts(wh):
    from starhouse.plans.quality import rule_candidates

    candidates = rule_candidates(wh)
    with pytest.raises(Exception, match="negative_value|year_out_of_range"):
        strict(candidates, HEALTH_FACT, HEALTH).agg(F.sum("metric_value")).collect()
    valid = split(candidates, HEALTH_FACT, HEALTH)[0]
    assert strict(valid, HEALTH_FACT, HEALTH).count() == HEALTH_LOADED


# --- refresh -----------------------------------------------------------------


def test_refresh_is_repeatable_and_switches_versions(spark, staged, tmp_path):
    root = str(tmp_path / "core")
    assert published_version(spark, root) is None
    first = refresh_core(spark, HEALTH, staged, root, verbose=True).first()
    one = published_version(spark, root)
    second = refresh_core(spark, HEALTH, staged, root, verbose=True).first()
    two = published_version(spark, root)
    assert tuple(first) == tuple(second) == (5, HEALTH_LOADED, 8 + 5, 3)
    rejects = PublishedWarehouse(spark, HEALTH, root).rejects().collect()
    assert sorted(r.reason for r in rejects) == ["negative_value", "year_out_of_range", "year_out_of_range"]
    assert one < two
    assert refresh_core(spark, HEALTH, staged, root) is None


def test_failed_refresh_leaves_the_published_version(spark, staged, tmp_path):
    root = str(tmp_path / "core")
    refresh_core(spark, HEALTH, staged, root)
    before = published_version(spark, root)
    twice = spark.createDataFrame(
        [("AAA", "One name", "AFR", "Africa"), ("AAA", "Other name", "AFR", "Africa")],
        staging_schema(STG_COUNTRY),
    )
    with pytest.raises(RefreshRejected, match="unique:country_code"):
        refresh_core(spark, HEALTH, lambda t: twice if t == STG_COUNTRY else staged(t), root)
    assert published_version(spark, root) == before
    assert PublishedWarehouse(spark, HEALTH, root).country().count() == 5


def test_repeated_business_key_is_refused(spark, staged, tmp_path):
    doubled = frames(spark)[STG_HEALTH]
    doubled = doubled.unionByName(doubled.filter("raw_country_code = 'BBB'"))
    with pytest.raises(RefreshRejected, match="unique:indicator_code"):
        refresh_core(
            spark, HEALTH, lambda t: doubled if t == STG_HEALTH else staged(t), str(tmp_path / "core")
        )


def test_abort_leaves_the_published_version(spark, staged, tmp_path):
    root = str(tmp_path / "core")
    refresh_core(spark, HEALTH, staged, root)
    before = published_version(spark, root)
    with pytest.raises(Exception, match="negative_value|year_out_of_range"):
        refresh_core(spark, HEALTH, staged, root, on_violation="abort")
    assert published_version(spark, root) == before
    with pytest.raises(ValueError):
        refresh_core(spark, HEALTH, staged, root, on_violation="ignore")


def test_staging_gate(spark, staged, tmp_path):
    assert all(r.passes for r in staging_gate(staged, HEALTH).collect())
    broken = staged(STG_HEALTH).withColumn("raw_year", F.lit("?"))
    for table in (broken, staged(STG_HEALTH).filter("false")):
        with pytest.raises(RefreshRejected, match="staging not loaded: stg_health"):
            refresh_core(spark, HEALTH, lambda t: table if t == STG_HEALTH else staged(t), str(tmp_path / "core"))
    assert published_version(spark, str(tmp_path / "core")) is None


def test_the_version_published_last_is_current(spark, tmp_path):
    root, summary = str(tmp_path / "core"), spark.range(1).selectExpr("1L AS countries_loaded")
    began_first, began_second = new_version(), new_version()
    publish(summary, root, began_second)
    publish(summary, root, began_first)
    assert published_version(spark, root) == began_first


def test_an_unreadable_marker_is_not_nothing(spark, tmp_path):
    (tmp_path / "core" / "published").mkdir(parents=True)
    assert published_version(spark, str(tmp_path / "core")) is None
    with pytest.raises(Exception):
        published_version(spark, "nosuchscheme://core")


def test_readers_see_repaired_bounds(spark, staged, tmp_path):
    root = str(tmp_path / "core")
    refresh_core(spark, HEALTH, staged, root)
    before = PublishedWarehouse(spark, HEALTH, root)
    wrong = before.health.filter("low_ci > high_ci").count()
    assert wrong > 0
    after = publish_repaired(spark, HEALTH, root)
    assert after.version != before.version
    publish_views(after)
    assert spark.sql("SELECT count(*) FROM vw_health_enriched WHERE low_ci > high_ci").first()[0] == 0
    assert after.health.count() == before.health.count() and after.ncd.count() == before.ncd.count()
    again = publish_repaired(spark, HEALTH, root)
    assert again.comm.count() == before.comm.count() and again.rejects().count() == 3


def _folders(root, version):
    """Year folders of each fact that a version wrote itself."""
    return {
        spec.name: sorted(p.name for p in (root / f"version={version}" / spec.name).glob("year_val=*")) for spec in FACTS
    }


def _rows(warehouse, spec):
    return sorted(map(repr, warehouse.fact(spec).drop("created_at").collect()))


def test_a_refresh_writes_the_years_that_changed(spark, staged, tmp_path):
    """One value of one year differs: that year's folder is written, and all reads as after a whole refresh."""
    refresh_core(spark, HEALTH, staged, str(tmp_path / "core"))
    first = PublishedWarehouse(spark, HEALTH, str(tmp_path / "core"))
    refresh_core(spark, HEALTH, staged, str(tmp_path / "core"))
    same = PublishedWarehouse(spark, HEALTH, str(tmp_path / "core"))
    assert not any(_folders(tmp_path / "core", same.version).values())
    assert all(_rows(first, spec) == _rows(same, spec) for spec in FACTS)

    year = first.health.agg(F.min("year_val")).first()[0]
    other = F.when(F.trim("raw_year") == str(year), "1.5").otherwise(F.col("raw_numeric_value"))
    table = staged(STG_HEALTH).withColumn("raw_numeric_value", other)

    def mended(name):
        return table if name == STG_HEALTH else staged(name)

    refresh_core(spark, HEALTH, mended, str(tmp_path / "core"))
    refresh_core(spark, HEALTH, mended, str(tmp_path / "anew"), whole=True)
    after, anew = (PublishedWarehouse(spark, HEALTH, str(tmp_path / x)) for x in ("core", "anew"))
    assert _folders(tmp_path / "core", after.version) == {
        HEALTH_FACT.name: [f"year_val={year}"], **{s.name: [] for s in FACTS if s is not HEALTH_FACT}
    }
    assert all(_rows(after, spec) == _rows(anew, spec) for spec in FACTS)
    assert sorted(r.fact_id for r in after.health.collect()) == list(range(1, HEALTH_LOADED + 1))

    # A year less and rows more elsewhere: ids move on, the folders of other years stay.
    dropped = table.filter(F.trim("raw_year") != str(year))
    refresh_core(spark, HEALTH, lambda t: dropped if t == STG_HEALTH else staged(t), str(tmp_path / "core"))
    less = PublishedWarehouse(spark, HEALTH, str(tmp_path / "core"))
    assert not any(_folders(tmp_path / "core", less.version).values())
    assert year not in less.manifest.years(HEALTH_FACT.name)
    assert sorted(r.fact_id for r in less.health.collect()) == list(range(1, less.health.count() + 1))


def test_a_refresh_parses_staging_once(spark, staged, tmp_path):
    """Each facts staging table is asked for once; its counts come with the write."""
    asked = []

    def stage(name):
        asked.append(name)
        return staged(name)

    refresh_core(spark, HEALTH, stage, str(tmp_path / "core"))
    assert sorted(asked) == sorted([STG_COUNTRY, *[spec.staging for spec in FACTS]])


def test_a_repair_writes_the_years_it_touches(spark, staged, tmp_path):
    root = str(tmp_path / "core")
    refresh_core(spark, HEALTH, staged, root)
    before = PublishedWarehouse(spark, HEALTH, root)
    years = {r.year_val for r in before.health.filter("low_ci > high_ci").collect()}
    after = publish_repaired(spark, HEALTH, root)
    written = _folders(tmp_path / "core", after.version)
    assert written.pop(HEALTH_FACT.name) == sorted(f"year_val={y}" for y in years) and not any(written.values())
    assert 0 < len(years) < len(before.manifest.years(HEALTH_FACT.name))
    assert sorted(r.fact_id for r in after.health.collect()) == sorted(r.fact_id for r in before.health.collect())
    assert publish_repaired(spark, HEALTH, root).version == after.version
    assert changes(before, after, NCD_FACT).count() == 0

    # The digests are those of what lies there, so a refresh brings back what staging says.
    refresh_core(spark, HEALTH, staged, root)
    again = PublishedWarehouse(spark, HEALTH, root)
    assert _rows(again, HEALTH_FACT) == _rows(before, HEALTH_FACT)
    assert _folders(tmp_path / "core", again.version)[HEALTH_FACT.name] == sorted(f"year_val={y}" for y in years)


def test_changes_between_versions(spark, staged, tmp_path):
    """Inserted, deleted and updated rows, nulls compared as values."""
    root = str(tmp_path / "core")
    refresh_core(spark, HEALTH, staged, root)
    before = PublishedWarehouse(spark, HEALTH, root)
    keys = [tuple(r) for r in before.comm.orderBy(*COMM_FACT.key).select(*COMM_FACT.key).collect()]
    disease, country, year = keys[0]
    mine = (F.trim("raw_indicator_code") == disease) & (F.trim("raw_country_code") == country) & (F.trim("raw_year") == str(year))
    rows = staged(STG_COMM)
    moved = rows.filter(mine).withColumn("raw_year", F.lit("1950"))
    other = rows.filter(mine).withColumn("raw_low", F.lit(None).cast("string")).withColumn("raw_numeric_value", F.lit("77"))
    for table, want in (
        (rows.filter(~mine), [("deleted", year)]),
        (rows.filter(~mine).unionByName(moved), [("deleted", year), ("inserted", 1950)]),
        (rows.filter(~mine).unionByName(other), [("updated", year)]),
        (rows, []),
    ):
        refresh_core(spark, HEALTH, lambda t, own=table: own if t == STG_COMM else staged(t), root)
        after = PublishedWarehouse(spark, HEALTH, root)
        found = changes(before, after, COMM_FACT).collect()
        assert sorted((r.change, r.year_val) for r in found) == want
        assert all(r.new_death_count == 77 and r.new_low_ci is None for r in found if r.change == "updated")


def test_retention(spark, staged, tmp_path):
    """Three versions, one of which lends folders, and what a failed refresh left."""
    root, core = str(tmp_path / "core"), tmp_path / "core"
    refresh_core(spark, HEALTH, staged, root)
    first = PublishedWarehouse(spark, HEALTH, root)
    second = publish_repaired(spark, HEALTH, root)
    refresh_core(spark, HEALTH, staged, root, whole=True)
    third = PublishedWarehouse(spark, HEALTH, root)
    doubled = staged(STG_HEALTH).unionByName(staged(STG_HEALTH).filter("raw_country_code = 'BBB'"))
    with pytest.raises(RefreshRejected):
        refresh_core(spark, HEALTH, lambda t: doubled if t == STG_HEALTH else staged(t), root)
    assert len(list(core.glob("version=*"))) == 4

    assert remove_unreachable(spark, root, keep=2) == []
    want = _rows(second, HEALTH_FACT)
    gone = remove_unreachable(spark, root, keep=2, older_than=timedelta(0))
    left = {p.name for p in core.glob("version=*")}
    assert left == {f"version={w.version}" for w in (first, second, third)} and len(gone) > 1
    # The first version keeps only what the second reads: the years that were not repaired, and dimensions.
    repaired = {p.year for p in second.manifest.parts if p.version == second.version}
    assert not any(f"year_val={y}" in _folders(core, first.version)[HEALTH_FACT.name] for y in repaired)
    manifest = next(m for m in manifests(spark, root) if m.version == second.version)
    reopened = PublishedWarehouse(spark, HEALTH, root, manifest=manifest)
    assert _rows(reopened, HEALTH_FACT) == want and reopened.country().count() == 5 and reopened.rejects().count() == 3

    remove_unreachable(spark, root, keep=1, older_than=timedelta(0))
    assert {p.name for p in core.glob("version=*")} == {f"version={third.version}"}
    assert _rows(PublishedWarehouse(spark, HEALTH, root), HEALTH_FACT) == _rows(third, HEALTH_FACT)
    with pytest.raises(ValueError):
        remove_unreachable(spark, root, keep=0)


def test_repeated_countries_are_told_apart(spark, wh, staged):
    twice = staged(STG_COUNTRY).unionByName(staged(STG_COUNTRY).filter("raw_country_code = 'AAA'"))
    doubled = DerivedWarehouse(spark, HEALTH, lambda t: twice if t == STG_COUNTRY else staged(t))
    row = core.reconciliation(doubled).filter("table_name = 'dim_country'").first()
    assert row.core_rows == 5 and row.repeated == 1
    assert row.filtered_out == row.missing_region + row.repeated


def test_published_warehouse_answers_like_the_derived_one(spark, wh, staged, tmp_path):
    root = str(tmp_path / "core")
    refresh_core(spark, HEALTH, staged, root)
    published = PublishedWarehouse(spark, HEALTH, root)
    for name, view in VIEWS.items():
        assert sorted(map(repr, view(published).collect())) == sorted(map(repr, view(wh).collect())), name


def test_missing_version_is_reported(spark, tmp_path):
    with pytest.raises(LookupError):
        PublishedWarehouse(spark, HEALTH, str(tmp_path / "nothing"))


def test_views_are_replaceable_by_name(spark, wh):
    assert publish_views(wh) == publish_views(wh) == list(VIEWS)
    total = spark.sql("SELECT count(*) FROM vw_health_enriched WHERE region_name = 'Africa'").first()[0]
    assert total > 0


def test_sql_users_find_tables_functions_and_staging(spark, wh):
    publish_views(wh, staging=True)
    widest = spark.sql(
        """SELECT disease_code, max(fn_ci_width(low_ci, high_ci)) AS width
           FROM fct_communicable_deaths NATURAL JOIN dim_disease GROUP BY disease_code"""
    ).collect()
    facts = [r for r in wh.comm.collect() if r.low_ci is not None]
    want = {d: max(r.high_ci - r.low_ci for r in facts if r.disease_code == d) for d in {r.disease_code for r in facts}}
    assert {r.disease_code: r.width for r in widest if r.width is not None} == {d: round(w, 2) for d, w in want.items()}
    staged = spark.sql("SELECT count(*) FROM stg_health_estimates_raw").first()[0]
    assert staged == len(HEALTH_ROWS)


def test_constraint_report_sees_staged_defects(wh):
    rows = {(r.table_name, r.constraint_name): r.n_violations for r in core.constraint_report(wh).collect()}
    assert rows[(STG_HEALTH, "not_null:year_val")] == 3
    assert rows[(STG_HEALTH, "not_null:metric_value")] == 5
    assert rows[(STG_COUNTRY, "not_null:region_code")] == 2
    core_tables = {"dim_country", *(s.name for s in FACTS)}
    assert all(n == 0 for (table, _), n in rows.items() if table in core_tables)


def test_distinct_countries(spark):
    rows = [("AAA", "A", "R", "Region\r"), (" AAA", "A ", "R", "Region")]
    df = spark.createDataFrame(rows, staging_schema(STG_COUNTRY))
    assert build_country_dim(df).count() == 1


def test_facts_know_their_tables():
    assert [s.name for s in (HEALTH_FACT, NCD_FACT, COMM_FACT)] == [s.name for s in FACTS]


def test_a_refresh_leaves_no_copy_of_its_facts(spark, staged, tmp_path):
    folder = Path(shared_folder(spark)) / "starhouse" / spark.sparkContext.applicationId
    before = set(folder.glob("ordered-*"))
    refresh_core(spark, HEALTH, staged, str(tmp_path / "core"))
    assert set(folder.glob("ordered-*")) == before


# --- replay of rejects --------------------------------------------------------


def _mended(spark, warehouse, stage, change):
    """The rejected staging records with ``change`` made, under the ids of the rejects."""
    staged_rows = stage(STG_HEALTH).withColumn("record_id", record_id(HEALTH_FACT))
    found = staged_rows.join(warehouse.rejects().select("record_id", "reason"), "record_id")
    return found.withColumns(change).drop("reason")


def test_rejects_mended_and_replayed_equal_a_clean_load(spark, staged, tmp_path):
    root = str(tmp_path / "core")
    refresh_core(spark, HEALTH, staged, root)
    first = PublishedWarehouse(spark, HEALTH, root)
    negative = F.col("raw_numeric_value") == "-5.0"
    value = {"raw_numeric_value": F.when(negative, "5.0").otherwise(F.col("raw_numeric_value"))}
    year = {"raw_year": F.when(F.col("raw_year").isin("1850", "2150"), "1990").otherwise(F.col("raw_year"))}

    # One is mended, two still break their rule.
    second = replay_rejects(spark, HEALTH, root, _mended(spark, first, staged, value))
    assert second.health.count() == HEALTH_LOADED + 1
    assert [r.reason for r in second.rejects().collect()] == ["year_out_of_range"] * 2
    assert _folders(tmp_path / "core", second.version)[HEALTH_FACT.name] == ["year_val=2006"]
    # What still fails keeps its id; both get one year, but they would have the same key.
    both = _mended(spark, second, staged, year)
    assert both.count() == 2
    with pytest.raises(RefreshRejected, match="unique:indicator_code"):
        replay_rejects(spark, HEALTH, root, both)
    apart = both.withColumn("raw_country_code", F.when(F.col("raw_numeric_value") == "90", "BBB").otherwise(F.col("raw_country_code")))
    third = replay_rejects(spark, HEALTH, root, apart)
    assert third.rejects().count() == 0 and published_version(spark, root) == third.version
    assert published_summary(spark, root, third.version, SUMMARY_SCHEMA).first() == (5, HEALTH_LOADED + 3, 13, 0)

    moved = (F.col("raw_year") == "2150") & (F.col("raw_country_code") == "AAA")
    clean = staged(STG_HEALTH).withColumn("raw_country_code", F.when(moved, "BBB").otherwise(F.col("raw_country_code")))
    clean = clean.withColumns({**value, **year})
    refresh_core(spark, HEALTH, lambda t: clean if t == STG_HEALTH else staged(t), str(tmp_path / "clean"))
    want = PublishedWarehouse(spark, HEALTH, str(tmp_path / "clean"))
    for spec in FACTS:
        assert _rows(third, spec) == _rows(want, spec)
        digests = [{y: p.digest for y, p in w.manifest.years(spec.name).items()} for w in (third, want)]
        assert digests[0] == digests[1]


def test_a_replay_takes_only_what_was_refused(spark, staged, tmp_path):
    root = str(tmp_path / "core")
    refresh_core(spark, HEALTH, staged, root)
    first = PublishedWarehouse(spark, HEALTH, root)
    loaded = staged(STG_HEALTH).withColumn("record_id", record_id(HEALTH_FACT))
    for rows in (loaded, _mended(spark, first, staged, {}).unionByName(_mended(spark, first, staged, {}))):
        with pytest.raises(RefreshRejected, match="not replayed"):
            replay_rejects(spark, HEALTH, root, rows)
    nothing = _mended(spark, first, staged, {}).filter("false")
    unreadable = _mended(spark, first, staged, {"raw_year": F.lit("?")})
    for rows in (nothing, unreadable):
        assert replay_rejects(spark, HEALTH, root, rows).version == first.version
    assert first.rejects().filter("record_id IS NULL").count() == 0


def test_only_refused_rows_are_named_by_their_record(spark, staged, tmp_path):
    paths = {spec.name: str(tmp_path / spec.name) for spec in FACTS}
    refresh._typed_once(spark, HEALTH, staged, paths, 0.9)
    _, refused = split(spark.read.parquet(paths[HEALTH_FACT.name]), HEALTH_FACT, HEALTH)
    named = spark.read.parquet(paths[HEALTH_FACT.name]).filter("record_id IS NOT NULL")
    ids = {bytes(r.record_id) for r in named.collect()}
    assert named.count() == refused.count() > 0
    records = staged(STG_HEALTH).withColumn("record_id", record_id(HEALTH_FACT)).collect()
    assert ids < {bytes(r.record_id) for r in records}
