"""Distributed ordering operators against brute force, with a group holding most rows."""

from __future__ import annotations

import random
from collections import defaultdict
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from starhouse.operators.ordering import (
    concentration,
    group_quantiles,
    top_n_per_group,
    with_dense_rank,
    with_global_index,
    with_running_total,
)


@pytest.fixture(scope="module")
def rows():
    """3,000 rows: one group and one value hold well over a third of them."""
    rng = random.Random(7)
    out = []
    for i in range(3000):
        group = "hot" if i % 5 < 3 else f"g{i % 7}"
        value = Decimal("5.00") if i % 2 else Decimal(rng.randrange(1, 4000)) / 100
        out.append((f"c{i:05d}", group, value))
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "code string, grp string, value decimal(18,2)").repartition(5)


def test_global_index(df, rows):
    got = {r.code: r.i for r in with_global_index(df, [F.col("value").desc(), "code"], "i").collect()}
    ordered = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert got == {r[0]: n for n, r in enumerate(ordered, 1)}


def test_global_index_of_nothing(df):
    assert with_global_index(df.filter("false"), ["code"], "i").collect() == []


def test_running_total(df, rows):
    got = {
        r.code: r.upto for r in with_running_total(df, ["grp"], ["code"], "value", "upto").collect()
    }
    want, sums = {}, defaultdict(Decimal)
    for code, group, value in sorted(rows):
        sums[group] += value
        want[code] = sums[group]
    assert got == want


def test_dense_rank(df, rows):
    values = defaultdict(set)
    for _, group, value in rows:
        values[group].add(value)
    place = {g: {v: n for n, v in enumerate(sorted(vs, reverse=True), 1)} for g, vs in values.items()}
    got = {r.code: r.rk for r in with_dense_rank(df, "grp", "value", "rk").collect()}
    assert got == {code: place[group][value] for code, group, value in rows}


def test_quantiles(df, rows):
    values = defaultdict(list)
    for _, group, value in rows:
        values[group].append(float(value))
    result = group_quantiles(df, "grp", "value", {"lo": "0", "q1": "0.25", "mid": "0.5", "q3": "0.75", "hi": "1"})
    for r in result.collect():
        want = np.quantile(values[r.grp], [0, 0.25, 0.5, 0.75, 1])
        assert r.n_rows == len(values[r.grp])
        assert [float(r[c]) for c in ("lo", "q1", "mid", "q3", "hi")] == pytest.approx(list(want))


def test_quantiles_of_one_row(spark):
    one = spark.createDataFrame([("g", Decimal("2.5"))], "grp string, value decimal(18,2)")
    assert float(group_quantiles(one, "grp", "value", {"mid": "0.5"}).first().mid) == 2.5


def test_top_n_per_group(df, rows):
    got = defaultdict(list)
    for r in top_n_per_group(df, "grp", [F.col("value").desc(), F.col("code")], 3).orderBy("rn").collect():
        got[r.grp].append(r.code)
    by_group = defaultdict(list)
    for code, group, value in rows:
        by_group[group].append((-value, code))
    assert dict(got) == {g: [c for _, c in sorted(v)[:3]] for g, v in by_group.items()}


def test_concentration_counts_all_peers(spark):
    # Five rows tie at the cut: three make the top four, all five count.
    data = [("a", "10"), *((c, "4") for c in "bcdef"), ("z", "1")]
    df = spark.createDataFrame([(c, Decimal(v)) for c, v in data], "code string, value decimal(18,2)")
    rows = concentration(df, "code", "value", 4).orderBy("rn").collect()
    assert [(r.rn, r.code, int(r.running_total), int(r.grand_total)) for r in rows] == [
        (1, "a", 10, 31),
        (2, "b", 30, 31),
        (3, "c", 30, 31),
        (4, "d", 30, 31),
    ]


@pytest.fixture(scope="module")
def with_nulls(spark):
    data = [("a", "g", "1"), ("b", "g", None), ("c", "g", "3"), ("d", None, "5"), ("e", None, "5"), ("f", "none", None)]
    rows = [(c, g, Decimal(v) if v else None) for c, g, v in data]
    return spark.createDataFrame(rows, "code string, grp string, value decimal(18,2)")


def test_dense_rank_keeps_nulls(with_nulls):
    got = {r.code: r.rk for r in with_dense_rank(with_nulls, "grp", "value", "rk").collect()}
    assert got == {"c": 1, "a": 2, "b": 3, "d": 1, "e": 1, "f": 1}


def test_running_total_keeps_nulls(with_nulls):
    got = {r.code: r.upto for r in with_running_total(with_nulls, ["grp"], ["code"], "value", "upto").collect()}
    assert got == {"a": 1, "b": 1, "c": 4, "d": 5, "e": 10, "f": 0}


def test_quantiles_leave_nulls_out(with_nulls):
    got = {r.grp: (r.n_rows, r.mid) for r in group_quantiles(with_nulls, "grp", "value", {"mid": "0.5"}).collect()}
    assert got == {"g": (2, 2), None: (2, 5), "none": (0, None)}
    assert group_quantiles(with_nulls.filter("false"), "grp", "value", {"mid": "0.5"}).count() == 0
