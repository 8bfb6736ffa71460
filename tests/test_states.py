"""KPI views from states: equal to the views, computed once a year's content, sketches near."""

from __future__ import annotations

import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starhouse import HEALTH
from starhouse.plans import states, views
from starhouse.plans.refresh import refresh_core
from starhouse.plans.states import KpiStates
from starhouse.plans.warehouse import PublishedWarehouse
from starhouse.schemas import COMM_FACT, FACTS, HEALTH_FACT, NCD_FACT, STG_COUNTRY, STG_HEALTH

PAIRS = [
    (states.yearly_kpi, views.yearly_kpi),
    (states.region_yearly_kpi, views.region_yearly_kpi),
    (states.yearly_deaths_by_cause, views.yearly_deaths_by_cause),
]


def opened(spark, stage, root):
    refresh_core(spark, HEALTH, stage, root)
    return PublishedWarehouse(spark, HEALTH, root)


def same_views(wh):
    kept = KpiStates(wh)
    for merged, plain in PAIRS:
        assert merged(kept).columns == plain(wh).columns
        assert sorted(map(repr, merged(kept).collect())) == sorted(map(repr, plain(wh).collect())), plain.__name__


def test_views_from_states_equal_the_views(spark, staged, tmp_path):
    wh = opened(spark, staged, str(tmp_path / "core"))
    same_views(wh)
    read = states.yearly_kpi(KpiStates(wh)).inputFiles()
    assert any("/states/" in f for f in read) and all("/states/" in f or "/dim_" in f for f in read)


def test_a_changed_year_recomputes_its_state(spark, staged, tmp_path):
    root = str(tmp_path / "core")
    first = opened(spark, staged, root)
    assert KpiStates(first).bring_up_to_date(HEALTH_FACT) == sorted(first.manifest.years(HEALTH_FACT.name))
    assert KpiStates(first).bring_up_to_date(HEALTH_FACT) == []
    other = F.when(F.trim("raw_year") == "2019", F.lit("33")).otherwise(F.col("raw_numeric_value"))
    table = staged(STG_HEALTH).withColumn("raw_numeric_value", other)
    second = opened(spark, lambda t: table if t == STG_HEALTH else staged(t), root)
    assert KpiStates(second).bring_up_to_date(HEALTH_FACT) == [2019]
    same_views(second)
    # The first version's states are still there, and a return to it needs none.
    assert KpiStates(first).bring_up_to_date(HEALTH_FACT) == []
    same_views(first)
    third = opened(spark, staged, root)
    assert KpiStates(third).bring_up_to_date(HEALTH_FACT) == []


def test_another_region_of_a_country_renews_the_states(spark, staged, tmp_path):
    root = str(tmp_path / "core")
    KpiStates(opened(spark, staged, root)).frame(HEALTH_FACT)
    code = F.trim("raw_country_code")
    moved = staged(STG_COUNTRY).withColumn(
        "raw_region_name", F.when(code == "AAA", "Elsewhere").otherwise(F.col("raw_region_name"))
    )
    after = opened(spark, lambda t: moved if t == STG_COUNTRY else staged(t), root)
    assert KpiStates(after).bring_up_to_date(HEALTH_FACT) == sorted(after.manifest.years(HEALTH_FACT.name))
    same_views(after)


def test_a_state_without_its_marker_is_not_read(spark, staged, tmp_path):
    """A job that fails before the marker leaves a folder that nobody reads."""
    wh = opened(spark, staged, str(tmp_path / "core"))
    left = tmp_path / "core" / "states" / HEALTH_FACT.name / "batch=left" / "year_val=2021"
    left.mkdir(parents=True)
    (left / "part-0.parquet").write_bytes(b"half")
    same_views(wh)


@pytest.mark.parametrize("spec", FACTS)
def test_countries_over_years(spark, staged, tmp_path, spec):
    kept = KpiStates(opened(spark, staged, str(tmp_path / "core")))
    exact = sorted(map(tuple, states.countries_over_years(kept, spec).collect()))
    assert exact == sorted(map(tuple, states.countries_over_years(kept, spec, exact=False).collect()))


def test_merging_over_sexes_and_years(spark, staged, tmp_path):
    wh = opened(spark, staged, str(tmp_path / "core"))
    for spec in (NCD_FACT, COMM_FACT, HEALTH_FACT):
        value = F.col(spec.measure)
        plain = wh.fact(spec).groupBy(spec.category).agg(
            F.count("*"), F.sum(value), F.round(F.stddev_pop(value), 6), F.min(value), F.max(value)
        )
        found = states.merged(KpiStates(wh).frame(spec), spec, [spec.category]).select(
            spec.category, "n", "total", F.round("deviation", 6), "low", "high"
        )
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))


def test_value_sketch_is_near_at_every_rank(spark):
    """20,000 values in 40 states: quartiles lie within 4 % of their ranks, countries within 6.4 %."""
    rows = spark.range(20000).select(
        F.lit("I").alias("indicator_code"),
        F.concat(F.lit("C"), (F.col("id") % 3000).cast("string")).alias("country_code"),
        (F.col("id") % 20 + 2000).cast("smallint").alias("year_val"),
        F.lit("S").alias("sex_code"),
        (F.hash("id") % 100000).cast("decimal(18,6)").alias("metric_value"),
    )
    regions = rows.select("country_code", (F.hash("country_code") % 2).cast("string").alias("region_name")).distinct()
    kept = states.merged(states.states_of(rows, regions, HEALTH_FACT), HEALTH_FACT, ["indicator_code"])
    ranks = (0.1, 0.25, 0.5, 0.75, 0.9)
    row = kept.select(
        "n", F.hll_sketch_estimate("countries"), *[F.kll_sketch_get_quantile_double("sketch", F.lit(r)) for r in ranks]
    ).first()
    values = sorted(float(r[0]) for r in rows.select("metric_value").collect())
    assert row[0] == 20000 and abs(row[1] - 3000) <= 0.064 * 3000
    for rank, value in zip(ranks, row[2:]):
        assert abs(sum(v <= value for v in values) / 20000 - rank) < 0.04


def test_sketches_are_kept_a_group_and_not_a_country(spark):
    """Beside a distinct count, one aggregation would make and shuffle both sketches for every country of a group."""
    columns = "country_code string, year_val smallint, sex_code string, indicator_code string, metric_value decimal(18,6)"
    row = [(f"c{i % 40}", 2019, "N", "I", i) for i in range(80)] + [(None, 2019, "N", "I", 1), ("c1", None, "N", None, 7)]
    rows = spark.createDataFrame([(*r[:4], Decimal(r[4])) for r in row], columns)
    regions = spark.createDataFrame([(f"c{i}", "R") for i in range(30)], "country_code string, region_name string")
    found = states.states_of(rows, regions, HEALTH_FACT)
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "simple")
    sketching = [re.search(r"keys=\[([^]]*)\]", x).group(1) for x in plan.splitlines() if "hll_sketch_agg" in x and "keys=[" in x]
    assert sketching and not any("country_code" in keys for keys in sketching)
    got = {(r.indicator_code, r.year_val): (r.n, r.n_countries, r.total) for r in found.collect()}
    assert got == {("I", 2019): (60, 30, sum(i for i in range(80) if i % 40 < 30)), (None, None): (1, 1, 7)}
