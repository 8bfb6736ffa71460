"""Each check on planted defects, where it has to report exactly them."""

from __future__ import annotations

from decimal import Decimal

import pytest

from starhouse.operators.quality import duplicates, repair_inverted
from starhouse.plans import staging_reports
from starhouse.plans.quality import CHECKS


def one(wh, key):
    return CHECKS[key](wh).first().asDict()


@pytest.mark.parametrize(
    ("key", "want"),
    [
        (
            "dq_nulls_health",
            {"null_indicator": 0, "null_country": 1, "null_year": 3, "null_sex": 0, "null_metric": 5},
        ),
        ("dq_orphan_country_health", {"orphan_country": 3}),
        ("dq_orphan_indicator", {"orphan_indicator": 1}),
        ("dq_orphan_sex", {"orphan_sex": 1}),
        ("dq_year_range_health", {"min_year": 2000, "max_year": 2021, "n_distinct_years": 5}),
        ("dq_negative_le", {"negative_life_expectancy": 1}),
        ("dq_negative_mortality", {"negative_mortality": 1}),
        ("dq_inverted_health", {"issue": "inverted interval", "n_affected": 1}),
        ("dq_repair_verify", {"remaining_inverted": 0}),
        ("dq_nulls_ncd", {"null_cause": 1, "null_country": 0, "null_year": 0, "null_deaths": 1}),
        ("dq_orphan_cause", {"orphan_cause": 2}),
        ("dq_orphan_country_ncd", {"orphan_country_deaths": 1}),
        ("dq_negative_ncd", {"negative_deaths": 1}),
        ("dq_year_range_ncd", {"min_year": 2000, "max_year": 2019}),
        ("dq_inverted_ncd", {"inverted_ci_deaths": 1}),
        ("dq_nulls_comm", {"null_disease": 0, "null_country": 0, "null_year": 0, "null_deaths": 0}),
        ("dq_orphan_disease", {"orphan_disease": 1}),
        ("dq_orphan_country_comm", {"orphan_country_comm": 1}),
        ("dq_negative_comm", {"negative_comm_deaths": 1}),
        ("dq_year_range_comm", {"min_year": 2000, "max_year": 2019}),
        ("dq_inverted_comm", {"inverted_ci_comm": 1}),
    ],
)
def test_counts(wh, key, want):
    assert one(wh, key) == want


def test_listings(wh):
    above = CHECKS["dq_above_bound"](wh).collect()
    assert [(r.country_code, int(r.metric_value)) for r in above] == [("CCC", 101)]
    detail = CHECKS["dq_inverted_detail"](wh).collect()
    assert [(r.country_code, int(r.low_ci), int(r.high_ci)) for r in detail] == [("BBB", 9, 3)]
    crossed = CHECKS["dq_cross_consistency"](wh).collect()
    assert [(r.country_code, r.gap) for r in crossed] == [("BBB", Decimal("-1.0"))]
    # Three staged rows without a readable year share the rest of their key.
    assert [(r.year_val, r.n_dups) for r in CHECKS["dq_dups_health"](wh).collect()] == [(None, 3)]


def test_coverage(wh):
    rows = {r.indicator_code[-1]: (r.total_rows, r.with_ci, r.without_ci) for r in CHECKS["dq_ci_coverage"](wh).collect()}
    assert rows == {"1": (16, 2, 14), "2": (5, 2, 3), "4": (5, 0, 5), "5": (1, 0, 1)}


def test_repair_swaps_and_keeps_values(spark):
    data = [(9, 3), (5, 5), (1, 2), (None, 4), (4, None), (None, None)]
    df = spark.createDataFrame(data, "low_ci int, high_ci int")
    assert [tuple(r) for r in repair_inverted(df).collect()] == [(3, 9), *data[1:]]


def test_duplicates_are_found(spark):
    df = spark.createDataFrame([("a", 1)] * 3 + [("b", 1)] * 2 + [("c", 1)], "k string, y int")
    assert [tuple(r) for r in duplicates(df, ["k", "y"], 10).collect()] == [("a", 1, 3), ("b", 1, 2)]
    assert duplicates(df, ["k", "y"], 1).count() == 1


def test_parse_reports(wh):
    assert staging_reports.parse_health(wh).first().asDict() == {
        "bad_year": 3,
        "bad_numeric_value": 5,
        "bad_low": 1,
        "bad_high": 0,
        "empty_country_code": 1,
        "empty_sex_code": 0,
    }
    assert staging_reports.parse_ncd(wh).first().asDict() == {
        "bad_year": 0,
        "bad_numeric_value": 1,
        "empty_cause_code": 1,
        "empty_country_code": 0,
    }
    assert staging_reports.parse_comm(wh).first().asDict() == {
        "bad_year": 0,
        "bad_numeric_value": 0,
        "empty_disease_name": 1,
    }


def test_missing_region_and_control_characters(wh):
    assert {r.raw_country_code for r in staging_reports.missing_region(wh).collect()} == {"FFF", "GGG", "HHH"}
    found = {r.column_name: (r.n_rows, r.sample_hex) for r in staging_reports.control_characters(wh).collect()}
    assert found == {"raw_region_name": (4, "200D")}


def test_text_year_range_is_lexicographic(wh):
    row = staging_reports.text_year_range(wh).first()
    assert (row.min_year, row.max_year) == ("", "2150")
