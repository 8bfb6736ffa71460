"""The questions on the health profile: ties, missing sides, labels and column names."""

from __future__ import annotations

from decimal import Decimal as D

from starhouse.plans import analytics as A
from starhouse.plans import reports as R


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_trend_and_change(wh):
    trend = {r.year_val: (r.avg_life_expectancy, r.n_countries) for r in A.q01_yearly_trend(wh).collect()}
    assert trend[2000] == (D("60.00"), 3)
    assert trend[2021] == (D("71.26"), 5)
    change = A.q02_yoy_change(wh).collect()
    assert change[0].prev_year_le is None and change[0].yoy_change_pct is None
    assert change[1].yoy_change_pct == D("68.333")
    assert len(R.rp02_yoy_signed(wh).collect()) == len(change) - 1


def test_column_names_carry_the_years(wh):
    assert A.q03_top10(wh).columns == ["country_name", "region_name", "life_expectancy_2021"]
    assert A.q07_region_improvement(wh).columns[1:3] == ["avg_le_2000", "avg_le_2021"]
    assert "deaths_2019" in A.q12_top_cause(wh).columns


def test_ties_go_by_country_code(wh):
    assert [r[0] for r in rows(A.q03_top10(wh))] == ["Delta", "Türkiye", "Curaçao", "Alpha, Republic of", "Bravo"]
    europe = [r for r in rows(A.q04_top3_per_region(wh)) if r[0] == "Europe"]
    assert [(r[1], r[3]) for r in europe] == [("Delta", 1), ("Türkiye", 2), ("Curaçao", 3)]


def test_dense_rank_shares_ranks(wh):
    ranks = {r.country_name: r.region_rank for r in A.q09_dense_rank(wh).collect()}
    assert ranks == {"Alpha, Republic of": 2, "Bravo": 1, "Curaçao": 1, "Delta": 1, "Türkiye": 2}


def test_gap_and_improvement(wh):
    assert rows(A.q05_gap_pivot(wh)) == [
        ("Europe", D("82.25"), D("77.50"), D("4.75")),
        ("Africa", D("62.00"), D("58.00"), D("4.00")),
    ]
    improvement = {r.region_name: (r.improvement, r.improvement_pct) for r in A.q07_region_improvement(wh).collect()}
    assert improvement["Africa"] == (D("4.15"), D("7.90"))


def test_concentration_peers(wh):
    got = [(r.country_name, r.cumulative_pct) for r in A.q08_concentration(wh).collect()]
    assert got == [
        ("Alpha, Republic of", D("37.50")),
        ("Bravo", D("87.50")),
        ("Curaçao", D("87.50")),
        ("Delta", D("100.00")),
    ]


def test_pairs_and_decliners(wh):
    assert {r[0] for r in rows(A.q06_indicator_pair(wh))} == {
        "Alpha, Republic of",
        "Bravo",
        "Curaçao",
        "Delta",
    }
    assert rows(A.q10_decliners(wh)) == [("Bravo", "Africa", D("55.0"), D("53.1"), D("-1.95"))]


def test_top_cause_tie_and_shares(wh):
    top = rows(A.q12_top_cause(wh))
    assert top[0][:3] == ("Alpha, Republic of", "Africa", "Malignant neoplasms (cancers)")
    matrix = {r.region_name: r.asDict() for r in R.rp13_share_matrix(wh).collect()}
    assert matrix["Europe"]["Diabetes mellitus"] == 0
    assert matrix["Europe"]["Chronic respiratory diseases"] == D("70.0")


def test_latest_year_per_disease(wh):
    got = [(r.disease_name, r.year_val, r.country_name) for r in A.q16_latest_top5(wh).collect()]
    assert got == [
        ("HIV/AIDS", 2015, "Alpha, Republic of"),
        ("Tuberculosis", 2019, "Alpha, Republic of"),
        ("Tuberculosis", 2019, "Curaçao"),
    ]


def test_missing_sides(wh):
    burden = {r.country_name: r.communicable_deaths for r in A.q19_total_burden(wh).collect()}
    assert burden["Bravo"] == 0
    assert [r.country_name for r in A.q20_double_burden(wh).collect()] == ["Alpha, Republic of"]
    ratio = {(r.region_name, r.year_val): r.ncd_to_comm_ratio for r in A.q18_transition_ratio(wh).collect()}
    assert ratio[("Europe", 2000)] is None
    assert ratio[("Africa", 2000)] == D("0.5")


def test_shares_sum_to_hundred(wh):
    totals = {}
    for r in A.q17_union_share(wh).collect():
        totals[r.region_name] = totals.get(r.region_name, 0) + r.pct_of_region
    assert all(abs(t - 100) <= D("0.2") for t in totals.values())


def test_region_vs_global(wh):
    got = {r.region_name: r.pct_of_global_avg for r in A.region_vs_global(wh).collect()}
    assert got == {"Europe": D("113.67"), "Africa": D("79.50")}


def test_labels_flag_the_largest(wh):
    flagged = [r.labelled for r in R.rp14_cross_fact_labels(wh).collect()]
    assert flagged == [True] * 3
