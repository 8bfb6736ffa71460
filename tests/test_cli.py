from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path

from planted import BOTH, LE

from starhouse import HEALTH
from starhouse import __main__ as cli
from starhouse.__main__ import main
from starhouse.plans.landing import COUNTRY_PULL, NCD_PULL, REGION_PULL, write_pages
from starhouse.sources.json_pages import HEALTH_RECORD, read_pages

ROOT = Path(__file__).resolve().parent.parent


def _page(folder, records):
    folder.mkdir(parents=True)
    (folder / "page-1.json").write_text(json.dumps({"value": records}, indent=1))
    (folder / "page-2.json").write_text(json.dumps({"value": []}))


def test_pages_to_answers(spark, tmp_path, capsys):
    pages = tmp_path / "pages"
    base = {"SpatialDim": "AAA", "SpatialDimType": "COUNTRY", "TimeDim": 2021, "Dim1": BOTH}
    for n, (code, *_) in enumerate(HEALTH.indicators):
        _page(pages / code, [{**base, "IndicatorCode": code, "NumericValue": 60.5 + n, "Low": None}])
    for code, *_ in HEALTH.diseases:
        _page(pages / code, [{**base, "IndicatorCode": code, "TimeDim": 2019, "NumericValue": 7}])
    ncd = {**base, "IndicatorCode": "X", "TimeDim": 2019, "Dim2": HEALTH.cardiovascular, "NumericValue": 9}
    _page(pages / NCD_PULL, [ncd])
    _page(
        pages / COUNTRY_PULL,
        [
            {"Code": "AAA", "Title": "Alpha, R.", "ParentCode": "AFR", "ParentTitle": "Africa"},
            {"Code": "XXX", "Title": "No region"},
        ],
    )
    _page(pages / REGION_PULL, [{"Code": "AFR", "Title": "Africa"}])

    landed, root = str(tmp_path / "landed"), str(tmp_path / "core")
    main(["land", str(pages), landed])
    main(["refresh", landed, root])
    assert "|               1|           4|            6|            0|" in capsys.readouterr().out
    main(["run", "q03_top10", root])
    assert "Alpha, R." in capsys.readouterr().out
    main(["run", "stg_missing_region", root, "--landed", landed])
    assert "No region" in capsys.readouterr().out
    main(["run", "q20_double_burden", root, "--out", str(tmp_path / "out")])
    assert spark.read.parquet(str(tmp_path / "out")).first().communicable_deaths == 35


def test_settings_come_from_the_defaults_file(tmp_path):
    """No master, memory or partition count is set in code."""
    (tmp_path / "spark-defaults.conf").write_text(
        "spark.master local[3]\nspark.sql.shuffle.partitions 77\nspark.ui.enabled false\n"
    )
    code = (
        "from starhouse.__main__ import session; s = session(); "
        "print('HAVE', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"} | {"SPARK_CONF_DIR": str(tmp_path)}
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, env=env, capture_output=True, text=True, timeout=120)
    assert "HAVE local[3] 77" in done.stdout, done.stderr[-2000:]


def test_more_rows_than_shown_are_announced(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "SHOWN", 2)
    monkeypatch.setattr(cli, "PublishedWarehouse", lambda *a: None)
    monkeypatch.setitem(cli.PLANS, "q03_top10", lambda wh: spark.range(3))
    main(["run", "q03_top10", "nowhere"])
    assert "there are more" in capsys.readouterr().out


def test_pages_are_bounded_whatever_the_keys(spark, tmp_path):
    hot = spark.range(5000).selectExpr(
        f"'{LE}' indicator_code", "'AAA' country_code", "'COUNTRY' spatial_dim_type", "'2021' year",
        "'S' sex_code", "CAST(id AS STRING) numeric_value", "'' low", "'' high",
    )
    path = str(tmp_path / "pages")
    write_pages(hot, HEALTH_RECORD, path, page_size=100)
    sizes = [r[0] for r in spark.read.json(path).selectExpr("size(value)").collect()]
    assert max(sizes) <= 100 and sum(sizes) == 5000
    assert read_pages(spark, path, HEALTH_RECORD).select("numeric_value").distinct().count() == 5000
