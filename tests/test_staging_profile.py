"""One pass over each staging table answers all that the single reports do."""

from __future__ import annotations

import pytest
from test_plans import physical

from starhouse.plans import staging_reports as S
from starhouse.plans.staging_profile import COLUMNS, SCHEMA, StagingProfile, profile, profiles
from starhouse.schemas import STG_COMM, STG_HEALTH, STG_NCD, staging_schema


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.fixture(scope="module")
def found(wh, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("profile") / "t")
    profiles(wh).write.parquet(path)
    return StagingProfile(wh.spark.read.schema(SCHEMA).parquet(path))


def test_answers_equal_the_reports(wh, found):
    assert rows(found.row_counts()) == rows(S.row_counts(wh))
    assert rows(found.text_year_range()) == rows(S.text_year_range(wh))
    for table, plain in ((STG_HEALTH, S.parse_health), (STG_NCD, S.parse_ncd), (STG_COMM, S.parse_comm)):
        assert found.parse(table).columns == plain(wh).columns
        assert rows(found.parse(table)) == rows(plain(wh))
    for table, columns in COLUMNS.items():
        for column in columns:
            assert found.frequency(table, column).collect() == S.frequency(wh, table, column).collect()
    with pytest.raises(ValueError):
        found.frequency(STG_HEALTH, "raw_low")


@pytest.mark.parametrize("table", S.TABLES)
def test_one_scan_a_table(wh, table):
    assert physical(profile(wh, table)).count("FileScan") == 1


def test_null_codes_and_empty_tables(spark, wh):
    class Odd:
        def __init__(self, data):
            self.spark, self.data = spark, data

        def stg(self, table):
            return spark.createDataFrame(self.data, staging_schema(table))

    nulls = Odd([(None,) * 8, ("", "", "", "", "", "", "", "")])
    found = StagingProfile(profile(nulls, STG_HEALTH))
    assert rows(found.parse(STG_HEALTH)) == rows(S.parse_health(nulls))
    assert rows(found.frequency(STG_HEALTH, "raw_sex_code")) == rows(S.frequency(nulls, STG_HEALTH, "raw_sex_code"))
    nothing = StagingProfile(profile(Odd([]), STG_HEALTH))
    assert nothing.row_counts().collect()[0].n_rows == 0
    assert rows(nothing.parse(STG_HEALTH)) == rows(S.parse_health(Odd([])))
    assert nothing.frequency(STG_HEALTH, "raw_sex_code").collect() == []
