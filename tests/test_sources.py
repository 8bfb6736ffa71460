from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from starhouse import HEALTH
from starhouse.plans.landing import arrived, land_arriving, landed_batch
from starhouse.schemas import STG_COUNTRY, STG_HEALTH, staging_columns
from starhouse.sinks.files import write_csv
from starhouse.sources import read_pages, read_text_csv, static_dim, union_pulls
from starhouse.sources.csv_text import csv_rejects
from starhouse.sources.json_pages import COMM_RECORD, COUNTRY_RECORD, HEALTH_RECORD, page_rejects, page_schema

LINES = [
    "country_code,country_name,parent_code,parent_title",
    'BHS,"Alpha, Commonwealth of",AMR,Americas',
    "CUW,Curaçao,AMR,Americas",
    'QUO,"Say ""hi""",EUR,Europe',
    "XKX,Kilo (area),,",
]


def _crlf(tmp_path):
    path = tmp_path / "countries.csv"
    path.write_bytes(("\r\n".join(LINES) + "\r\n").encode())
    return str(path)


def test_csv_is_all_text_with_lineage(spark, tmp_path):
    df = read_text_csv(spark, _crlf(tmp_path), STG_COUNTRY)
    assert df.columns == [*staging_columns(STG_COUNTRY), "source_file", "ingested_at"]
    rows = {r.raw_country_code: r for r in df.collect()}
    assert rows["BHS"].raw_country_name == "Alpha, Commonwealth of"
    assert rows["CUW"].raw_country_name == "Curaçao"
    assert rows["QUO"].raw_country_name == 'Say "hi"'
    assert rows["XKX"].raw_region_code == "" and rows["XKX"].raw_region_name == ""
    assert rows["BHS"].raw_region_name == "Americas"
    assert {r.source_file for r in rows.values()} == {"countries.csv"}
    assert all(r.ingested_at is not None for r in rows.values())


def test_line_feed_import_keeps_the_carriage_return(spark, tmp_path):
    rows = read_text_csv(spark, _crlf(tmp_path), STG_COUNTRY, line_sep="\n").collect()
    assert {r.raw_region_name for r in rows} == {"Americas\r", "Europe\r", "\r"}


def test_csv_round_trip_keeps_padding_quotes_and_blanks(spark, tmp_path):
    data = [(" 2021 ", 'a "b", c', ""), (None, "x", "y")]
    df = spark.createDataFrame(data, "b string, a string, c string")
    path = str(tmp_path / "out")
    write_csv(df, path, [("a", "A"), ("b", "B"), ("c", "C")])
    text = "".join(p.read_bytes().decode() for p in (tmp_path / "out").glob("*.csv"))
    assert "A,B,C\r\n" in text and "x,,y\r\n" in text
    back = spark.read.option("header", True).option("escape", '"').csv(path).collect()
    assert {tuple(r) for r in back} == {('a "b", c', " 2021 ", None), ("x", None, "y")}


def test_pages_one_per_file(spark, tmp_path):
    full = {
        "IndicatorCode": "I1",
        "SpatialDim": "AAA",
        "SpatialDimType": "COUNTRY",
        "TimeDim": 2021,
        "Dim1": "SEX_BTSX",
        "NumericValue": 83.2,
        "Low": None,
        "Ignored": "x",
    }
    (tmp_path / "p1.json").write_text(json.dumps({"value": [full, {"IndicatorCode": "I2"}]}, indent=2))
    (tmp_path / "p2.json").write_text(json.dumps({"value": []}))
    df = read_pages(spark, str(tmp_path), HEALTH_RECORD, one_page_per_file=True)
    rows = {r.indicator_code: r for r in df.collect()}
    assert df.columns == list(HEALTH_RECORD)
    assert tuple(rows["I1"]) == ("I1", "AAA", "COUNTRY", "2021", "SEX_BTSX", "83.2", "", "")
    assert tuple(rows["I2"]) == ("I2", "", "", "", "", "", "", "")


def test_pages_one_per_line_with_constant(spark, tmp_path):
    page = {"value": [{"IndicatorCode": "TB", "NumericValue": 5, "TimeDim": 2019}]}
    (tmp_path / "pages.json").write_text(json.dumps(page) + "\n" + json.dumps(page) + "\n")
    df = read_pages(spark, str(tmp_path), COMM_RECORD, constants={"disease_name": "Tuberculosis"})
    rows = df.collect()
    assert len(rows) == 2 and all(r.disease_name == "Tuberculosis" for r in rows)
    assert rows[0].numeric_value == "5"


def test_dimension_pages(spark, tmp_path):
    page = {"value": [{"Code": "AAA", "Title": "Alpha", "ParentCode": "AFR", "ParentTitle": "Africa"}]}
    (tmp_path / "c.json").write_text(json.dumps(page))
    assert [tuple(r) for r in read_pages(spark, str(tmp_path), COUNTRY_RECORD).collect()] == [
        ("AAA", "Alpha", "AFR", "Africa")
    ]


def test_union_keeps_duplicates(spark):
    a = spark.createDataFrame([("1", "x")], "k string, v string")
    b = spark.createDataFrame([("x", "1")], "v string, k string")
    assert [tuple(r) for r in union_pulls([a, b]).collect()] == [("1", "x"), ("1", "x")]


def test_static_dims(spark):
    sizes = {n: static_dim(spark, HEALTH, n).count() for n in ("dim_sex", "dim_indicator", "dim_cause", "dim_disease")}
    assert sizes == {"dim_sex": 3, "dim_indicator": 4, "dim_cause": 4, "dim_disease": 5}


def test_csv_to_staging_schema(spark, tmp_path):
    (tmp_path / "h.csv").write_text(
        "indicator_code,country_code,spatial_dim_type,year,sex_code,numeric_value,low,high\n"
        "I,AAA,COUNTRY,2021,S,1.5,,\n"
    )
    row = read_text_csv(spark, str(tmp_path / "h.csv"), STG_HEALTH).first()
    assert (row.raw_numeric_value, row.raw_low, row.raw_high) == ("1.5", "", "")


HEADER = "country_code,country_name,parent_code,parent_title"


@pytest.mark.parametrize(
    "lines, record",
    [
        ([HEADER, "AAA,Alpha,AFR,Africa", "BBB,Beta,AFR,Africa,more"], "BBB,Beta,AFR,Africa,more"),
        ([HEADER, "AAA,Alpha,AFR,Africa", "BBB,Beta,AFR"], "BBB,Beta,AFR"),
    ],
)
def test_rows_that_do_not_fit_are_refused(spark, tmp_path, lines, record):
    path = tmp_path / "countries.csv"
    path.write_text("\n".join(lines) + "\n")
    with pytest.raises(Exception, match="not a row of the table"):
        read_text_csv(spark, str(path), STG_COUNTRY).collect()
    with pytest.raises(Exception, match="not a row of the table"):
        read_text_csv(spark, str(path), STG_COUNTRY).count()
    kept = read_text_csv(spark, str(path), STG_COUNTRY, accept_rejects=True).collect()
    assert [r.raw_country_code for r in kept] == ["AAA"]
    assert [tuple(r) for r in csv_rejects(spark, str(path), STG_COUNTRY).collect()] == [("countries.csv", record)]


def test_a_header_in_another_order_is_refused(spark, tmp_path):
    (tmp_path / "c.csv").write_text("country_name,country_code,parent_code,parent_title\nSpain,ESP,EUR,Europe\n")
    with pytest.raises(Exception, match="header|schema"):
        read_text_csv(spark, str(tmp_path / "c.csv"), STG_COUNTRY).collect()


def test_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "c.csv").write_text(HEADER + '\nESP,"Spa\nin",EUR,Europe\n')
    with pytest.raises(Exception, match="not a row of the table"):
        read_text_csv(spark, str(tmp_path / "c.csv"), STG_COUNTRY).collect()
    rows = read_text_csv(spark, str(tmp_path / "c.csv"), STG_COUNTRY, multi_line=True).collect()
    assert [r.raw_country_name for r in rows] == ["Spa\nin"]


@pytest.mark.parametrize("one_page_per_file", [False, True])
def test_damaged_pages_are_refused(spark, tmp_path, one_page_per_file):
    good = json.dumps({"value": [{"Code": "AAA", "Title": "Alpha"}]})
    (tmp_path / "a.json").write_text(good)
    for name, text in (("b.json", '{"value": [{"Code": "BBB"}, {"Code": "C'), ("c.json", '{"other": 1}')):
        (tmp_path / name).write_text(text)
        with pytest.raises(Exception, match="damaged page"):
            read_pages(spark, str(tmp_path), COUNTRY_RECORD, one_page_per_file=one_page_per_file).collect()
        with pytest.raises(Exception, match="damaged page"):
            read_pages(spark, str(tmp_path), COUNTRY_RECORD, one_page_per_file=one_page_per_file).count()
        kept = read_pages(
            spark, str(tmp_path), COUNTRY_RECORD, one_page_per_file=one_page_per_file, accept_rejects=True
        ).collect()
        assert [r.country_code for r in kept] == ["AAA"]
        refused = page_rejects(spark, str(tmp_path), COUNTRY_RECORD, one_page_per_file).collect()
        assert [r.source_file for r in refused] == [name]
        (tmp_path / name).unlink()


def test_arriving_pages_are_landed_once(spark, tmp_path):
    """Three calls give what one batch read gives; a repeated batch adds nothing; damaged pages are set aside."""
    folder, table = tmp_path / "pull", str(tmp_path / "landed")
    folder.mkdir()
    constants = {"disease_name": "D"}

    def page(number, *codes):
        records = [{"IndicatorCode": c, "SpatialDim": "AAA", "TimeDim": 2020, "NumericValue": 1.50} for c in codes]
        (folder / f"page-{number}.json").write_text(json.dumps({"value": records}, indent=1))

    page(1, "I1", "I2")
    land_arriving(spark, str(folder), COMM_RECORD, table, constants)
    page(2, "I3")
    (folder / "page-3.json").write_text('{"value": [{"Indi')
    land_arriving(spark, str(folder), COMM_RECORD, table, constants)
    land_arriving(spark, str(folder), COMM_RECORD, table, constants)
    page(4, "I1")
    land_arriving(spark, str(folder), COMM_RECORD, table, constants)

    want = read_pages(spark, str(folder), COMM_RECORD, constants, one_page_per_file=True, accept_rejects=True)
    got = arrived(spark, COMM_RECORD, table, constants)
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect()) and got.count() == 4
    set_aside = spark.read.parquet(f"{table}/quarantine").collect()
    assert [r.source_file for r in set_aside] == ["page-3.json"]

    again = spark.read.schema(page_schema(COMM_RECORD)).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt_record")
    batch = again.json(str(folder / "page-1.json")).withColumn("source_file", F.lit("page-1.json"))
    landed_batch(batch, 0, COMM_RECORD, constants, table)
    assert sorted(arrived(spark, COMM_RECORD, table, constants).collect()) == sorted(want.collect())
