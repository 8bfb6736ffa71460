"""A small staging set on the health model, with one row per defect worth testing."""

from __future__ import annotations

from starhouse.schemas import STG_COMM, STG_COUNTRY, STG_HEALTH, STG_NCD, staging_schema

LE, HALE, MORT, LE60 = "WHOSIS_000001", "WHOSIS_000002", "WHOSIS_000004", "WHOSIS_000015"
BOTH, MALE, FEMALE = "SEX_BTSX", "SEX_MLE", "SEX_FMLE"
CANCER, DIABETES, CARDIO, LUNG = (f"GHECAUSES_GHE{n}" for n in ("061", "080", "110", "117"))
TB, HIV = "TB_e_mort_exc_tbhiv_num", "HIV_0000000006"

COUNTRIES = [
    ("AAA", "Alpha, Republic of", "AFR", "Africa\r"),
    ("BBB", "Bravo", "AFR", "Africa \r"),
    ("CCC", "Curaçao", "EUR", "Europe"),
    ("DDD", " Delta ", "EUR", "Europe\r"),
    ("EEE", "Türkiye", "EUR", "Europe"),
    ("FFF", "Foxtrot (area)", "", ""),
    ("GGG", "Golf", None, "Europe"),
    ("HHH", "Hotel", "EUR", " \r"),
    ("", "Nameless", "EUR", "Europe"),
]


def _health(indicator, country, year, sex, value, low="", high="", level="COUNTRY"):
    return (indicator, country, level, str(year), sex, value, low, high)


HEALTH_ROWS = [
    # 2000 -> 2021; DDD and EEE tie in 2021
    _health(LE, "AAA", 2000, BOTH, "50", "49", "51"),
    _health(LE, "AAA", 2019, BOTH, "58.5"),
    _health(LE, "AAA", 2021, BOTH, "60.25", "59", "61"),
    _health(LE, "BBB", 2000, BOTH, "55"),
    _health(LE, "BBB", 2019, BOTH, "54"),
    _health(LE, "BBB", 2021, BOTH, "53.05"),
    _health(LE, "CCC", 2000, BOTH, "75"),
    _health(LE, "CCC", 2019, BOTH, "79"),
    _health(LE, "CCC", 2021, BOTH, "80"),
    _health(LE, "DDD", " 2021 ", BOTH, " 81.5 "),
    _health(LE, "EEE", 2021, BOTH, "81.5"),
    _health(LE, "AAA", 2021, MALE, "58"),
    _health(LE, "AAA", 2021, FEMALE, "62"),
    _health(LE, "CCC", 2021, MALE, "77.5"),
    _health(LE, "CCC", 2021, FEMALE, "82.25"),
    _health(HALE, "AAA", 2021, BOTH, "52"),
    _health(HALE, "BBB", 2021, BOTH, "54", "9", "3"),  # above LE; inverted bounds
    _health(HALE, "CCC", 2021, BOTH, "70", "5", "5"),  # equal bounds
    _health(HALE, "DDD", 2021, BOTH, "70"),
    _health(HALE, "EEE", 2021, BOTH, "69"),
    _health(MORT, "AAA", 2021, BOTH, "300"),
    _health(MORT, "BBB", 2021, BOTH, "200"),
    _health(MORT, "CCC", 2021, BOTH, "200"),
    _health(MORT, "DDD", 2021, BOTH, "100"),
    _health(LE60, "CCC", 2021, BOTH, "24", "7", "None"),  # one bound only
    _health(LE, "CCC", 2018, BOTH, "101"),  # above the bound
    # not loaded
    _health(LE, "AFR", 2021, BOTH, "63", level="REGION"),
    _health(LE, "AAA", "19x5", BOTH, "50"),
    _health(LE, "AAA", "21", BOTH, "50"),
    _health(LE, "AAA", "", BOTH, "50"),
    _health(LE, "AAA", 2001, BOTH, "None"),
    _health(LE, "AAA", 2002, BOTH, ""),
    _health(LE, "AAA", 2003, BOTH, "1e5"),
    _health(LE, "AAA", 2004, BOTH, "+3"),
    _health(LE, "AAA", 2005, BOTH, ".5"),
    _health(LE, "FFF", 2021, BOTH, "70"),  # country without a region
    _health(LE, "", 2021, BOTH, "70"),
    _health("UNKNOWN", "AAA", 2021, BOTH, "70"),
    _health(LE, "AAA", 2021, "SEX_X", "70"),
    _health(LE, "AAA", 2006, BOTH, "-5.0"),
    _health(LE, "AAA", 1850, BOTH, "40"),
    _health(LE, "AAA", 2150, BOTH, "90"),
    _health(MORT, "AAA", 2007, BOTH, "-1", "x", "2"),  # loads: not a guarded indicator
]
HEALTH_LOADED = 27


def _ncd(cause, country, year, sex, value, low="1", high="2", level="COUNTRY"):
    return ("DEATHS", country, level, str(year), sex, cause, value, low, high)


NCD_ROWS = [
    _ncd(CARDIO, "AAA", 2019, BOTH, "100"),
    _ncd(CANCER, "AAA", 2019, BOTH, "100"),  # tie: first code wins
    _ncd(CARDIO, "BBB", 2019, BOTH, "10.005"),  # rounds to 10.01
    _ncd(LUNG, "CCC", 2019, BOTH, "70"),
    _ncd(CARDIO, "CCC", 2019, BOTH, "30", "5", "4"),  # inverted
    _ncd(CARDIO, "CCC", 2000, BOTH, "60"),
    _ncd(CARDIO, "AAA", 2000, BOTH, "80"),
    _ncd(CARDIO, "AAA", 2019, MALE, "55"),
    _ncd(DIABETES, "AAA", 2019, BOTH, "bad"),
    _ncd("", "AAA", 2019, BOTH, "5"),
    _ncd("OTHER", "AAA", 2019, BOTH, "5"),
    _ncd(CARDIO, "ZZZ", 2019, BOTH, "-5"),
]


def _comm(disease, name, country, year, value, low="1", high="2", level="COUNTRY"):
    return (disease, name, country, level, str(year), value, low, high)


COMM_ROWS = [
    _comm(TB, "Tuberculosis", "AAA", 2019, "50"),
    _comm(TB, "Tuberculosis", "AAA", 2018, "70"),
    _comm(TB, "Tuberculosis", "CCC", 2019, "1"),
    _comm(TB, "Tuberculosis", "AAA", 2000, "160"),
    _comm(HIV, "HIV/AIDS", "AAA", 2015, "20", "8", "6"),  # inverted; its only year
    _comm("OTHER", "", "AAA", 2019, "9"),
    _comm(TB, "Tuberculosis", "ZZZ", 2019, "-9"),
]


def frames(spark):
    rows = {
        STG_COUNTRY: COUNTRIES,
        STG_HEALTH: HEALTH_ROWS,
        STG_NCD: NCD_ROWS,
        STG_COMM: COMM_ROWS,
    }
    return {name: spark.createDataFrame(data, staging_schema(name)) for name, data in rows.items()}
