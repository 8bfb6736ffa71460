"""Staging, core and view tables as DuckDB common table expressions."""

from __future__ import annotations

_COUNTRY_TEXT = """
    CAST(supp AS VARCHAR) AS raw_country_code,
    'COUNTRY' AS raw_spatial_dim_type,
    CASE WHEN (supp * 31 + yr) % 101 = 3 THEN '19x5'
         WHEN supp % 5 = 0 THEN ' ' || CAST(yr AS VARCHAR) || ' '
         ELSE CAST(yr AS VARCHAR) END AS raw_year,
    CASE WHEN (supp * 31 + yr) % 103 = 4 THEN 'None'
         WHEN {negative} THEN '-' || CAST(value AS VARCHAR)
         ELSE CAST(value AS VARCHAR) END AS raw_numeric_value,
    CASE WHEN (supp + yr) % 4 = 0 THEN ''
         WHEN (supp + yr) % 13 = 5 THEN CAST(high AS VARCHAR)
         ELSE CAST(low AS VARCHAR) END AS raw_low,
    CASE WHEN (supp + yr) % 4 = 0 THEN ''
         WHEN (supp + yr) % 13 = 5 THEN CAST(low AS VARCHAR)
         ELSE CAST(high AS VARCHAR) END AS raw_high"""
_REGION_TEXT = """
    'REG-' || CAST(supp AS VARCHAR) AS raw_country_code,
    'REGION' AS raw_spatial_dim_type,
    CAST(yr AS VARCHAR) AS raw_year,
    CAST(value AS VARCHAR) AS raw_numeric_value,
    CAST(low AS VARCHAR) AS raw_low,
    CAST(high AS VARCHAR) AS raw_high"""
_HEALTH_VALUES = """
    CAST((low + high) * CAST(0.0005 AS DECIMAL(5,4)) AS DECIMAL(18,6)) AS value,
    CAST(low * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(18,6)) AS low,
    CAST(high * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(18,6)) AS high"""
_COUNT_VALUES = """
    value,
    CAST(value * CAST(0.90 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS low,
    CAST(value * CAST(1.10 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS high"""
_NEGATIVE_HEALTH = "(supp * 31 + yr) % 107 = 5 AND category = 'ECONOMY'"
_NEGATIVE_COUNT = "supp % 40 = 7 AND yr % 2 = 0"
# Staged twice: the rows of suppliers without a region.
_TWICE = ", unnest(range(CASE WHEN supp % 40 = 7 THEN 2 ELSE 1 END)) AS copies(copy)"
_UP = """JOIN supplier ON s_suppkey = supp JOIN nation ON n_nationkey = s_nationkey"""


def _clean(column: str) -> str:
    return f"trim(regexp_replace(coalesce({column}, ''), '[[:cntrl:]]', '', 'g'), ' ')"


def _number(column: str, kind: str) -> str:
    text = _clean(column)
    return (
        f"CASE WHEN regexp_full_match({text}, '-?[0-9]+(\\.[0-9]+)?') "
        f"THEN TRY_CAST({text} AS {kind}) END"
    )


def _typed(stage: str, category: str, raw_category: str, measure: str, kind: str, sex: bool) -> str:
    low, high = _number("raw_low", kind), _number("raw_high", kind)
    sex_column = f"nullif({_clean('raw_sex_code')}, '') AS sex_code," if sex else ""
    year = _clean("raw_year")
    return f"""
    SELECT nullif({_clean(raw_category)}, '') AS {category},
           nullif({_clean('raw_country_code')}, '') AS country_code,
           CASE WHEN regexp_full_match({year}, '[0-9]{{4}}')
                THEN CAST({year} AS INTEGER) END AS year_val,
           {sex_column}
           {_number('raw_numeric_value', kind)} AS {measure},
           CASE WHEN ({high}) IS NOT NULL THEN {low} END AS low_ci,
           CASE WHEN ({low}) IS NOT NULL THEN {high} END AS high_ci,
           {_clean('raw_spatial_dim_type')} AS level
    FROM {stage}"""


def _fact(typed: str, category: str, dim: str, measure: str, sex: bool, rules: str = "TRUE") -> str:
    sex_column = "sex_code," if sex else ""
    sex_filter = "AND sex_code IN (SELECT sex_code FROM dim_sex)" if sex else ""
    return f"""
    SELECT row_number() OVER (ORDER BY year_val, {category}, country_code
                              {', sex_code' if sex else ''}) AS fact_id,
           {category}, country_code, year_val, {sex_column} {measure}, low_ci, high_ci
    FROM {typed}
    WHERE level = 'COUNTRY' AND year_val IS NOT NULL AND {measure} IS NOT NULL
      AND country_code IN (SELECT country_code FROM dim_country)
      AND {category} IN (SELECT {category} FROM {dim}) {sex_filter}
      AND {rules}"""


RULES = {
    "negative_value": "(indicator_code IN ('ECONOMY', 'LARGE', 'PROMO') AND metric_value < 0)",
    "year_out_of_range": "(year_val < 1900 OR year_val > 2100)",
}
_ACCEPTED = " AND ".join(f"NOT {rule}" for rule in RULES.values())

# name -> (tables it needs, query)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "health_groups": (
        (),
        """
    SELECT p_type AS category, l_suppkey AS supp, year(l_shipdate) AS yr, l_returnflag AS flag,
           min(CAST(l_extendedprice AS DECIMAL(18,2))) AS low,
           max(CAST(l_extendedprice AS DECIMAL(18,2))) AS high
    FROM lineitem JOIN part ON p_partkey = l_partkey
    GROUP BY ALL""",
    ),
    "ncd_groups": (
        (),
        """
    SELECT c_mktsegment AS category, l_suppkey AS supp, year(o_orderdate) AS yr,
           l_returnflag AS flag,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS value
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
    GROUP BY ALL""",
    ),
    "comm_groups": (
        (),
        """
    SELECT o_orderpriority AS category, l_suppkey AS supp,
           CASE WHEN o_orderpriority[1] IN ('4', '5') THEN 2000 ELSE year(o_orderdate) END AS yr,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS value
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    GROUP BY ALL""",
    ),
    "stg_health": (
        ("health_groups",),
        f"""
    SELECT category AS raw_indicator_code, {_COUNTRY_TEXT.format(negative=_NEGATIVE_HEALTH)},
           flag AS raw_sex_code
    FROM (SELECT category, supp, yr, flag, {_HEALTH_VALUES} FROM health_groups) {_TWICE}
    UNION ALL
    SELECT category, {_REGION_TEXT}, flag
    FROM (SELECT category, supp, yr, flag, {_HEALTH_VALUES}
          FROM (SELECT category, n_regionkey AS supp, yr, flag, min(low) AS low, max(high) AS high
                FROM health_groups {_UP} GROUP BY ALL))""",
    ),
    "stg_ncd": (
        ("ncd_groups",),
        f"""
    SELECT 'DEATHS' AS raw_indicator_code, category AS raw_cause_code,
           {_COUNTRY_TEXT.format(negative=_NEGATIVE_COUNT)}, flag AS raw_sex_code
    FROM (SELECT category, supp, yr, flag, {_COUNT_VALUES} FROM ncd_groups) {_TWICE}
    UNION ALL
    SELECT 'DEATHS', category, {_REGION_TEXT}, flag
    FROM (SELECT category, supp, yr, flag, {_COUNT_VALUES}
          FROM (SELECT category, n_regionkey AS supp, yr, flag,
                       CAST(sum(value) AS DECIMAL(18,2)) AS value
                FROM ncd_groups {_UP} GROUP BY ALL))""",
    ),
    "stg_comm": (
        ("comm_groups",),
        f"""
    SELECT category AS raw_indicator_code, substr(category, 3) AS raw_disease_name,
           {_COUNTRY_TEXT.format(negative=_NEGATIVE_COUNT)}
    FROM (SELECT category, supp, yr, {_COUNT_VALUES} FROM comm_groups) {_TWICE}
    UNION ALL
    SELECT category, substr(category, 3), {_REGION_TEXT}
    FROM (SELECT category, supp, yr, {_COUNT_VALUES}
          FROM (SELECT category, n_regionkey AS supp, yr,
                       CAST(sum(value) AS DECIMAL(18,2)) AS value
                FROM comm_groups {_UP} GROUP BY ALL))""",
    ),
    "stg_country": (
        (),
        """
    SELECT CAST(s_suppkey AS VARCHAR) AS raw_country_code, s_name AS raw_country_name,
           CASE WHEN s_suppkey % 40 = 7 THEN '' ELSE CAST(r_regionkey AS VARCHAR) END
               AS raw_region_code,
           CASE WHEN s_suppkey % 40 = 7 THEN '' ELSE r_name || chr(13) END AS raw_region_name
    FROM supplier JOIN nation ON n_nationkey = s_nationkey
                  JOIN region ON r_regionkey = n_regionkey,
         unnest(range(CASE WHEN s_suppkey % 40 = 8 THEN 2 ELSE 1 END)) AS copies(copy)""",
    ),
    "dim_sex": (
        (),
        """
    SELECT * FROM (VALUES ('N', 'Both sexes'), ('A', 'Male'), ('R', 'Female'))
        AS t(sex_code, sex_name)""",
    ),
    "dim_indicator": (
        (),
        """
    SELECT * FROM (VALUES
        ('ECONOMY', 'Life expectancy at birth', 'years'),
        ('LARGE', 'Healthy life expectancy (HALE) at birth', 'years'),
        ('MEDIUM', 'Adult mortality rate (15-60)', 'per 1000 population'),
        ('PROMO', 'Life expectancy at age 60', 'years')) AS t(indicator_code, indicator_name, unit)""",
    ),
    "dim_cause": (
        (),
        """
    SELECT * FROM (VALUES
        ('AUTOMOBILE', 'Malignant neoplasms (cancers)'),
        ('BUILDING', 'Diabetes mellitus'),
        ('FURNITURE', 'Cardiovascular diseases'),
        ('HOUSEHOLD', 'Chronic respiratory diseases')) AS t(cause_code, cause_name)""",
    ),
    "dim_disease": (
        (),
        """
    SELECT * FROM (VALUES
        ('1-URGENT', 'URGENT'), ('2-HIGH', 'HIGH'), ('3-MEDIUM', 'MEDIUM'),
        ('4-NOT SPECIFIED', 'NOT SPECIFIED'), ('5-LOW', 'LOW')) AS t(disease_code, disease_name)""",
    ),
    "dim_country": (
        ("stg_country",),
        f"""
    SELECT DISTINCT {_clean('raw_country_code')} AS country_code,
           {_clean('raw_country_name')} AS country_name,
           {_clean('raw_region_code')} AS region_code,
           {_clean('raw_region_name')} AS region_name
    FROM stg_country
    WHERE {_clean('raw_country_code')} <> '' AND {_clean('raw_region_code')} <> ''
      AND {_clean('raw_region_name')} <> ''""",
    ),
    "typed_health": (
        ("stg_health",),
        _typed("stg_health", "indicator_code", "raw_indicator_code", "metric_value", "DECIMAL(18,6)", True),
    ),
    "typed_ncd": (
        ("stg_ncd",),
        _typed("stg_ncd", "cause_code", "raw_cause_code", "death_count", "DECIMAL(18,2)", True),
    ),
    "typed_comm": (
        ("stg_comm",),
        _typed("stg_comm", "disease_code", "raw_indicator_code", "death_count", "DECIMAL(18,2)", False),
    ),
    "candidates": (
        ("typed_health", "dim_country", "dim_indicator", "dim_sex"),
        _fact("typed_health", "indicator_code", "dim_indicator", "metric_value", True),
    ),
    "health": (
        ("typed_health", "dim_country", "dim_indicator", "dim_sex"),
        _fact("typed_health", "indicator_code", "dim_indicator", "metric_value", True, _ACCEPTED),
    ),
    "ncd": (
        ("typed_ncd", "dim_country", "dim_cause", "dim_sex"),
        _fact("typed_ncd", "cause_code", "dim_cause", "death_count", True),
    ),
    "comm": (
        ("typed_comm", "dim_country", "dim_disease"),
        _fact("typed_comm", "disease_code", "dim_disease", "death_count", False),
    ),
    "vw_health": (
        ("health", "dim_country", "dim_indicator", "dim_sex"),
        """
    SELECT f.*, i.indicator_name, i.unit, c.country_name, c.region_code, c.region_name, s.sex_name
    FROM health f JOIN dim_indicator i USING (indicator_code)
                  JOIN dim_country c USING (country_code) JOIN dim_sex s USING (sex_code)""",
    ),
    "vw_deaths": (
        ("ncd", "dim_country", "dim_cause", "dim_sex"),
        """
    SELECT f.*, k.cause_name, c.country_name, c.region_code, c.region_name, s.sex_name
    FROM ncd f JOIN dim_cause k USING (cause_code)
               JOIN dim_country c USING (country_code) JOIN dim_sex s USING (sex_code)""",
    ),
    "vw_comm": (
        ("comm", "dim_country", "dim_disease"),
        """
    SELECT f.*, d.disease_name, c.country_name, c.region_code, c.region_name
    FROM comm f JOIN dim_disease d USING (disease_code) JOIN dim_country c USING (country_code)""",
    ),
}


def with_tables(needs: str, query: str) -> str:
    """``query`` preceded by the tables it names, each after the ones it depends on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dependency in TABLES[name][0]:
            visit(dependency)
        if name not in ordered:
            ordered.append(name)

    for name in needs.split():
        visit(name)
    if not ordered:
        return query
    parts = ",\n".join(f"{name} AS MATERIALIZED ({TABLES[name][1]}\n)" for name in ordered)
    return f"WITH {parts}\n{query}"
