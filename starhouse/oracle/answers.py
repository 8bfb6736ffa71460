"""The DuckDB query of every key."""

from __future__ import annotations

from starhouse.oracle.tables import RULES, with_tables

STAGING = {
    "stg_health_estimates_raw": (
        "stg_health",
        "raw_indicator_code raw_country_code raw_spatial_dim_type raw_year raw_sex_code "
        "raw_numeric_value raw_low raw_high",
    ),
    "stg_ncd_deaths_raw": (
        "stg_ncd",
        "raw_indicator_code raw_country_code raw_spatial_dim_type raw_year raw_sex_code "
        "raw_cause_code raw_numeric_value raw_low raw_high",
    ),
    "stg_communicable_deaths_raw": (
        "stg_comm",
        "raw_indicator_code raw_disease_name raw_country_code raw_spatial_dim_type raw_year "
        "raw_numeric_value raw_low raw_high",
    ),
    "stg_countries_raw": (
        "stg_country",
        "raw_country_code raw_country_name raw_region_code raw_region_name",
    ),
}
ALL_STAGING = "stg_health stg_ncd stg_comm stg_country"
HEALTH_KEY = "indicator_code, country_code, year_val, sex_code"
NCD_KEY = "cause_code, country_code, year_val, sex_code"
COMM_KEY = "disease_code, country_code, year_val"
LE = "indicator_code = 'ECONOMY' AND sex_name = 'Both sexes'"


def _avg(expression: str, digits: int, filter_: str = "") -> str:
    where = f" FILTER (WHERE {filter_})" if filter_ else ""
    return f"round(CAST(avg({expression}){where} AS DECIMAL(38,10)), {digits})"


def _ratio(num: str, den: str, digits: int, factor: int = 100) -> str:
    return (
        f"round(CAST({factor} * CAST({num} AS DOUBLE) / nullif(CAST({den} AS DOUBLE), 0) "
        f"AS DECIMAL(38,10)), {digits})"
    )


def _double(expression: str, name: str) -> str:
    return f"CAST({expression} AS DOUBLE) AS {name}"


def _records(table: str, control_chars: bool = True) -> str:
    """A staging table as (table_name, record)."""
    source, columns = STAGING[table]
    joined = " || '|' || ".join(columns.split())
    if not control_chars:
        joined = f"replace({joined}, chr(13), '')"
    return f"SELECT '{table}' AS table_name, {joined} AS record FROM {source}"


def _stack(parts) -> str:
    return "\nUNION ALL\n".join(f"({part})" for part in parts)


def _frequency(table: str, column: str) -> str:
    return with_tables(table, f"SELECT {column}, count(*) AS n FROM {table} GROUP BY ALL")


def _bad(pattern: str, column: str) -> str:
    return f"NOT regexp_full_match(trim({column}), '{pattern}')"


_YEAR = "[0-9]{4}"
_NUMBER = "-?[0-9]+(\\.[0-9]+)?"


def _staging() -> dict[str, str]:
    bad_year = f"count(CASE WHEN {_bad(_YEAR, 'raw_year')} THEN 1 END) AS bad_year"
    bad_value = f"count(CASE WHEN {_bad(_NUMBER, 'raw_numeric_value')} THEN 1 END) AS bad_numeric_value"

    def bad_bound(side: str) -> str:
        column = f"raw_{side}"
        return (
            f"count(CASE WHEN {_bad(_NUMBER, column)} AND trim({column}) NOT IN ('', 'None') THEN 1 END) AS bad_{side}"
        )

    def empty(column: str) -> str:
        return f"count(CASE WHEN trim(coalesce(raw_{column}, '')) = '' THEN 1 END) AS empty_{column}"

    def measured(name: str, *columns: str, checks: tuple[str, ...] = (), dated: bool = True) -> list[str]:
        source = STAGING[name][0]
        parts = [f"SELECT 'rows' AS measure, CAST(NULL AS VARCHAR) AS value, count(*) AS n FROM {source}"]
        for check in checks:
            count, measure = check.rsplit(" AS ", 1)
            parts.append(f"SELECT '{measure}', NULL, {count} FROM {source}")
        for side in ("min", "max") if dated else ():
            parts.append(f"SELECT '{side}_year', {side}(raw_year), CAST(NULL AS BIGINT) FROM {source}")
        parts += [f"SELECT '{c}', {c}, count(*) FROM {source} GROUP BY {c}" for c in columns]
        return [f"SELECT '{name}' AS table_name, * FROM ({part})" for part in parts]

    both = (bad_year, bad_value)
    codes = (empty("country_code"), empty("sex_code"))
    health = ("raw_spatial_dim_type", "raw_indicator_code", "raw_sex_code")
    profile = [
        *measured("stg_health_estimates_raw", *health, checks=(*both, bad_bound("low"), bad_bound("high"), *codes)),
        *measured("stg_ncd_deaths_raw", "raw_cause_code", checks=(*both, empty("cause_code"), codes[0])),
        *measured("stg_communicable_deaths_raw", "raw_disease_name", checks=(*both, empty("disease_name"))),
        *measured("stg_countries_raw", dated=False),
    ]
    return {
        "stg_profile": with_tables(ALL_STAGING, _stack(profile)),
        "stg_row_counts": with_tables(
            ALL_STAGING,
            _stack(
                f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {source}"
                for name, (source, _) in STAGING.items()
            ),
        ),
        "stg_sample": with_tables(
            ALL_STAGING, _stack(f"{_records(t)} ORDER BY record LIMIT 10" for t in STAGING)
        ),
        "stg_freq_spatial": _frequency("stg_health", "raw_spatial_dim_type"),
        "stg_freq_indicator": _frequency("stg_health", "raw_indicator_code"),
        "stg_freq_sex": _frequency("stg_health", "raw_sex_code"),
        "stg_freq_cause": _frequency("stg_ncd", "raw_cause_code"),
        "stg_freq_disease": _frequency("stg_comm", "raw_disease_name"),
        "stg_year_range_text": with_tables(
            "stg_health", "SELECT min(raw_year) AS min_year, max(raw_year) AS max_year FROM stg_health"
        ),
        "stg_parse_health": with_tables(
            "stg_health",
            f"""SELECT {bad_year}, {bad_value}, {bad_bound('low')}, {bad_bound('high')},
                       {empty('country_code')}, {empty('sex_code')} FROM stg_health""",
        ),
        "stg_parse_ncd": with_tables(
            "stg_ncd",
            f"""SELECT {bad_year}, {bad_value}, {empty('cause_code')}, {empty('country_code')}
                FROM stg_ncd""",
        ),
        "stg_parse_comm": with_tables(
            "stg_comm", f"SELECT {bad_year}, {bad_value}, {empty('disease_name')} FROM stg_comm"
        ),
        "stg_missing_region": with_tables(
            "stg_country",
            """SELECT raw_country_code, raw_country_name FROM stg_country
               WHERE trim(raw_region_code) = '' OR trim(raw_region_name) = ''""",
        ),
    }


def _sources() -> dict[str, str]:
    def cells(table: str, kind: str, where: str = "TRUE", suffix: str = "") -> str:
        source, columns = STAGING[table]
        joined = " || '|' || ".join(columns.split())
        return f"SELECT '{kind}' AS kind, {joined}{suffix} AS record FROM {source} WHERE {where}"

    # Page records of the communicable kind carry the disease's name last.
    comm = """SELECT 'communicable' AS kind,
                     raw_indicator_code || '|' || raw_country_code || '|' || raw_spatial_dim_type
                     || '|' || raw_year || '|' || raw_numeric_value || '|' || raw_low || '|'
                     || raw_high || '|' || raw_disease_name AS record
              FROM stg_comm"""
    region = """SELECT DISTINCT 'region' AS kind, raw_region_code || '|' || raw_region_name AS record
                FROM stg_country WHERE raw_region_code <> ''"""
    pulled = "raw_indicator_code IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO')"

    def landed(file: str, table: str, where: str = "TRUE") -> str:
        return f"""SELECT '{file}' AS file_name, replace(record, chr(13), '') AS record
                   FROM ({cells(table, '', where)})"""

    dims = {
        "dim_sex": ("sex_code", "sex_name", "stg_health", "raw_sex_code"),
        "dim_indicator": ("indicator_code", "indicator_name", "stg_health", "raw_indicator_code"),
        "dim_cause": ("cause_code", "cause_name", "stg_ncd", "raw_cause_code"),
        "dim_disease": ("disease_code", "disease_name", "stg_comm", "raw_indicator_code"),
    }
    facts = {
        "fct_health_estimate": ("health", "metric_value"),
        "fct_ncd_deaths": ("ncd", "death_count"),
        "fct_communicable_deaths": ("comm", "death_count"),
    }
    return {
        "src_csv_staging": with_tables(
            ALL_STAGING, _stack(_records(t, control_chars=False) for t in STAGING)
        ),
        "src_lineage": with_tables(
            ALL_STAGING,
            _stack(
                f"""SELECT '{name}' AS table_name, 'part' AS file_stem, 'csv' AS file_type,
                           count(*) AS n_rows, count(*) AS n_timed FROM {source}"""
                for name, (source, _) in STAGING.items()
            ),
        ),
        "src_rejects": with_tables(
            "stg_country",
            """SELECT reason, count(*) AS n_rows
               FROM (SELECT CASE CAST(raw_country_code AS INTEGER) % 7
                            WHEN 1 THEN 'field too many' WHEN 2 THEN 'field too few' ELSE 'accepted' END AS reason
                     FROM stg_country) GROUP BY reason""",
        ),
        "src_json_pages": with_tables(
            ALL_STAGING,
            _stack(
                [
                    cells("stg_health_estimates_raw", "health"),
                    cells("stg_ncd_deaths_raw", "ncd"),
                    comm,
                    cells("stg_countries_raw", "country"),
                    region,
                ]
            ),
        ),
        "src_multi_indicator": with_tables(
            "stg_health stg_comm", _stack([cells("stg_health_estimates_raw", "health", pulled), comm])
        ),
        "src_static_dims": with_tables(
            ALL_STAGING + " " + " ".join(dims),
            _stack(
                f"""SELECT '{dim}' AS dim_name, {code} AS code, {label} AS label,
                           (SELECT count(*) FROM {table} WHERE {column} = {code}) AS n_staged
                    FROM {dim}"""
                for dim, (code, label, table, column) in dims.items()
            ),
        ),
        "snk_core_roundtrip": with_tables(
            "health ncd comm dim_country dim_sex dim_indicator dim_cause dim_disease",
            _stack(
                [
                    f"""SELECT '{name}' AS table_name, year_val, count(*) AS n_rows,
                               {_double(f'sum({measure})', 'total')}
                        FROM {source} GROUP BY year_val"""
                    for name, (source, measure) in facts.items()
                ]
                + [
                    f"""SELECT '{dim}' AS table_name, CAST(NULL AS INTEGER) AS year_val,
                               count(*) AS n_rows, CAST(NULL AS DOUBLE) AS total FROM {dim}"""
                    for dim in (*dims, "dim_country")
                ]
            ),
        ),
        "snk_csv_roundtrip": with_tables(
            ALL_STAGING,
            _stack(
                [
                    landed("health_estimates_raw.csv", "stg_health_estimates_raw", pulled),
                    landed("ncd_deaths_raw.csv", "stg_ncd_deaths_raw"),
                    landed("communicable_deaths_raw.csv", "stg_communicable_deaths_raw"),
                    landed("countries.csv", "stg_countries_raw"),
                    f"""SELECT 'regions.csv' AS file_name, replace(record, chr(13), '') AS record
                        FROM ({region})""",
                ]
            ),
        ),
        "snk_views_by_name": _stack(
            f"SELECT '{name}' AS view_name, count(*) AS n_rows FROM ({query})" for name, query in _views().items()
        ),
        "refresh_core": with_tables(
            "dim_country health ncd comm candidates",
            """SELECT (SELECT count(*) FROM dim_country) AS countries_loaded,
                      (SELECT count(*) FROM health) AS facts_loaded,
                      (SELECT count(*) FROM ncd) + (SELECT count(*) FROM comm) AS deaths_loaded,
                      (SELECT count(*) FROM candidates) - (SELECT count(*) FROM health) AS rows_rejected""",
        ),
    }


def _core() -> dict[str, str]:
    def measures(table: str, key: str, measure: str) -> str:
        return with_tables(table, f"SELECT {key}, {_double(measure, measure)} FROM {table}")

    def bounds(table: str, key: str) -> str:
        return with_tables(
            table,
            f"SELECT {key}, {_double('low_ci', 'low_ci')}, {_double('high_ci', 'high_ci')} FROM {table}",
        )

    def by_category(table: str, category: str) -> str:
        return with_tables(table, f"SELECT {category}, count(*) AS n FROM {table} GROUP BY ALL")

    outcomes = (
        "not_country bad_year bad_value unknown_country unknown_category unknown_sex rule_rejected"
    ).split()

    def outcome(name: str, typed: str, category: str, dim: str, measure: str, sex: bool, rules: str) -> str:
        unknown_sex = "WHEN sex_code IS NULL OR sex_code NOT IN (SELECT sex_code FROM dim_sex) THEN 'unknown_sex'"
        counts = ", ".join(f"count(CASE WHEN outcome = '{o}' THEN 1 END) AS {o}" for o in outcomes)
        return f"""
            SELECT '{name}' AS table_name, count(*) AS staged_rows,
                   count(CASE WHEN outcome = 'loaded' THEN 1 END) AS core_rows,
                   count(CASE WHEN outcome <> 'loaded' THEN 1 END) AS filtered_out,
                   {counts}, CAST(0 AS BIGINT) AS missing_region, CAST(0 AS BIGINT) AS repeated
            FROM (SELECT CASE
                    WHEN level <> 'COUNTRY' THEN 'not_country'
                    WHEN year_val IS NULL THEN 'bad_year'
                    WHEN {measure} IS NULL THEN 'bad_value'
                    WHEN country_code IS NULL
                      OR country_code NOT IN (SELECT country_code FROM dim_country)
                        THEN 'unknown_country'
                    WHEN {category} IS NULL OR {category} NOT IN (SELECT {category} FROM {dim})
                        THEN 'unknown_category'
                    {unknown_sex if sex else ''}
                    WHEN {rules} THEN 'rule_rejected'
                    ELSE 'loaded' END AS outcome
                  FROM {typed})"""

    zeros = ", ".join(f"CAST(0 AS BIGINT) AS {o}" for o in outcomes)
    lost = "(trim(raw_region_code) = '' OR trim(raw_region_name) = '')"
    countries = f"""
        SELECT 'dim_country' AS table_name, count(*) AS staged_rows,
               count(DISTINCT CASE WHEN NOT {lost} THEN raw_country_code END) AS core_rows,
               count(*) - count(DISTINCT CASE WHEN NOT {lost} THEN raw_country_code END) AS filtered_out, {zeros},
               count(CASE WHEN {lost} THEN 1 END) AS missing_region,
               count(CASE WHEN NOT {lost} THEN 1 END)
                   - count(DISTINCT CASE WHEN NOT {lost} THEN raw_country_code END) AS repeated
        FROM stg_country"""
    broken = " OR ".join(RULES.values())

    def constraints(source: str, name: str, required: str, key: str) -> list[str]:
        nulls = [
            f"""SELECT '{name}' AS table_name, 'not_null:{column}' AS constraint_name,
                       count(CASE WHEN {expression} IS NULL THEN 1 END) AS n_violations FROM {source}"""
            for column, expression in (
                (part.split("=") if "=" in part else (part, part)) for part in required.split()
            )
        ]
        expressions = [
            dict(p.split("=") for p in required.split() if "=" in p).get(column, column)
            for column in key.split(",")
        ]
        unique = f"""
            SELECT '{name}' AS table_name, 'unique:{key}' AS constraint_name,
                   CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_violations
            FROM (SELECT count(*) AS n FROM {source} GROUP BY {', '.join(expressions)})"""
        return [*nulls, unique]

    country = "country_code country_name region_code region_name"
    staged_country = " ".join(f"{c}=nullif(trim(raw_{c}),'')" for c in country.split())
    checks = (
        constraints("stg_country", "stg_countries_raw", staged_country, "country_code")
        + constraints("dim_country", "dim_country", country, "country_code")
        + constraints(
            "typed_health",
            "stg_health_estimates_raw",
            "indicator_code country_code year_val sex_code metric_value",
            "indicator_code,country_code,year_val,sex_code",
        )
        + constraints(
            "health",
            "fct_health_estimate",
            "indicator_code country_code year_val sex_code metric_value",
            "indicator_code,country_code,year_val,sex_code",
        )
        + constraints(
            "typed_ncd",
            "stg_ncd_deaths_raw",
            "cause_code country_code year_val sex_code death_count",
            "cause_code,country_code,year_val,sex_code",
        )
        + constraints(
            "ncd",
            "fct_ncd_deaths",
            "cause_code country_code year_val sex_code death_count",
            "cause_code,country_code,year_val,sex_code",
        )
        + constraints(
            "typed_comm",
            "stg_communicable_deaths_raw",
            "disease_code country_code year_val death_count",
            "disease_code,country_code,year_val",
        )
        + constraints(
            "comm",
            "fct_communicable_deaths",
            "disease_code country_code year_val death_count",
            "disease_code,country_code,year_val",
        )
    )
    everything = "health ncd comm dim_country typed_health typed_ncd typed_comm"
    return {
        "etl_dim_country": with_tables("dim_country", "SELECT * FROM dim_country"),
        "etl_fct_health": measures("health", HEALTH_KEY, "metric_value"),
        "etl_ci_health": bounds("health", HEALTH_KEY),
        "etl_fct_ncd": measures("ncd", NCD_KEY, "death_count"),
        "etl_ci_ncd": bounds("ncd", NCD_KEY),
        "etl_fct_comm": measures("comm", COMM_KEY, "death_count"),
        "etl_ci_comm": bounds("comm", COMM_KEY),
        "etl_verify_counts": with_tables(
            "health ncd comm",
            """SELECT 'fct_health_estimate' AS tbl, count(*) AS n FROM health
               UNION ALL SELECT 'fct_ncd_deaths', count(*) FROM ncd
               UNION ALL SELECT 'fct_communicable_deaths', count(*) FROM comm""",
        ),
        "etl_verify_indicator": by_category("health", "indicator_code"),
        "etl_verify_cause": by_category("ncd", "cause_code"),
        "etl_verify_disease": by_category("comm", "disease_code"),
        "etl_surrogate_key": with_tables("health", f"SELECT fact_id, {HEALTH_KEY} FROM health"),
        "etl_reconcile": with_tables(
            everything + " dim_indicator dim_cause dim_disease dim_sex",
            _stack(
                [
                    outcome(
                        "fct_health_estimate",
                        "typed_health",
                        "indicator_code",
                        "dim_indicator",
                        "metric_value",
                        True,
                        broken,
                    ),
                    outcome(
                        "fct_ncd_deaths", "typed_ncd", "cause_code", "dim_cause", "death_count", True, "FALSE"
                    ),
                    outcome(
                        "fct_communicable_deaths",
                        "typed_comm",
                        "disease_code",
                        "dim_disease",
                        "death_count",
                        False,
                        "FALSE",
                    ),
                    countries,
                ]
            ),
        ),
        "etl_constraint_check": with_tables(everything, _stack(checks)),
        "etl_ci_key_match": with_tables(
            "stg_health dim_indicator",
            """SELECT d.indicator_code, s.staged_code, s.n_staged
               FROM (SELECT lower(raw_indicator_code) || ' ' AS staged_code, count(*) AS n_staged
                     FROM stg_health GROUP BY ALL) s
               JOIN dim_indicator d ON upper(rtrim(s.staged_code)) = upper(d.indicator_code)""",
        ),
    }


def _views() -> dict[str, str]:
    bounds = f"{_double('low_ci', 'low_ci')}, {_double('high_ci', 'high_ci')}"
    return {
        "vw_health_enriched": with_tables(
            "vw_health",
            f"""SELECT fact_id, indicator_code, indicator_name, unit, country_code, country_name,
                       region_code, region_name, year_val, sex_code, sex_name,
                       {_double('metric_value', 'metric_value')}, {bounds},
                       {_double('round(high_ci - low_ci, 4)', 'ci_width')}
                FROM vw_health""",
        ),
        "vw_yearly_kpi": with_tables(
            "vw_health",
            f"""SELECT indicator_code, indicator_name, unit, year_val, sex_name,
                       count(*) AS n_countries,
                       {_double(_avg('metric_value', 2), 'avg_value')},
                       {_double('round(min(metric_value), 2)', 'min_value')},
                       {_double('round(max(metric_value), 2)', 'max_value')},
                       {_double('round(CAST(stddev_pop(metric_value) AS DECIMAL(38,10)), 2)', 'stddev_value')}
                FROM vw_health GROUP BY ALL""",
        ),
        "vw_region_yearly_kpi": with_tables(
            "vw_health",
            f"""SELECT indicator_code, indicator_name, year_val, region_name, n_countries,
                       {_double('avg_value', 'avg_value')},
                       {_double(_ratio('avg_value',
                                       'sum(avg_value) OVER (PARTITION BY indicator_code, year_val)', 2),
                                'region_share_pct')}
                FROM (SELECT indicator_code, indicator_name, year_val, region_name,
                             count(DISTINCT country_code) AS n_countries,
                             {_avg('metric_value', 2)} AS avg_value
                      FROM vw_health WHERE sex_name = 'Both sexes' GROUP BY ALL)""",
        ),
        "vw_deaths_enriched": with_tables(
            "vw_deaths",
            f"""SELECT fact_id, cause_code, cause_name, country_code, country_name, region_code,
                       region_name, year_val, sex_code, sex_name,
                       {_double('death_count', 'death_count')}, {bounds}
                FROM vw_deaths""",
        ),
        "vw_yearly_deaths_by_cause": with_tables(
            "vw_deaths",
            f"""SELECT cause_code, cause_name, year_val,
                       {_double('sum(death_count)', 'total_deaths')},
                       count(DISTINCT country_code) AS n_countries,
                       {_double(_avg('death_count', 0), 'avg_deaths_per_country')}
                FROM vw_deaths WHERE sex_name = 'Both sexes' GROUP BY ALL""",
        ),
        "vw_communicable_enriched": with_tables(
            "vw_comm",
            f"""SELECT fact_id, disease_code, disease_name, country_code, country_name, region_code,
                       region_name, year_val, {_double('death_count', 'death_count')}, {bounds}
                FROM vw_comm""",
        ),
    }


def _yearly_change(extra: str, where: str) -> str:
    previous = "lag(avg_le) OVER (ORDER BY year_val)"
    return with_tables(
        "vw_health",
        f"""SELECT year_val, {_double('avg_le', 'avg_le')}, {_double('prev', 'prev_year_le')},
                   {_double('pct', 'yoy_change_pct')} {extra}
            FROM (SELECT year_val, avg_le, {previous} AS prev,
                         {_ratio(f'avg_le - {previous}', previous, 3)} AS pct
                  FROM (SELECT year_val, {_avg('metric_value', 4)} AS avg_le
                        FROM vw_health WHERE {LE} GROUP BY year_val))
            WHERE {where}""",
    )


def _pairs(limit: str, three_keys: bool) -> str:
    keys = "country_code, year_val, sex_code" if three_keys else "country_code"
    return with_tables(
        "vw_health",
        f"""SELECT country_name, region_name, {_double('le', 'life_expectancy')},
                   {_double('mort', 'adult_mortality')}
            FROM (SELECT country_code, year_val, sex_code, country_name, region_name,
                         round(metric_value, 1) AS le
                  FROM vw_health WHERE {LE} AND year_val = 2000)
            JOIN (SELECT country_code, year_val, sex_code, round(metric_value, 1) AS mort
                  FROM vw_health WHERE indicator_code = 'MEDIUM' AND sex_name = 'Both sexes'
                    AND year_val = 2000) USING ({keys})
            {limit}""",
    )


def _concentration(columns: str, n: int) -> str:
    running = "sum(metric_value) OVER (ORDER BY metric_value DESC)"
    return with_tables(
        "vw_health",
        f"""SELECT {columns} FROM (
              SELECT country_name, region_name, {_double('round(metric_value, 1)', 'adult_mortality')},
                     CAST(row_number() OVER (ORDER BY metric_value DESC, country_code) AS INTEGER) AS rn,
                     {_double(_ratio('metric_value', 'sum(metric_value) OVER ()', 2), 'pct_of_total')},
                     {_double(_ratio(running, 'sum(metric_value) OVER ()', 2), 'cumulative_pct')}
              FROM vw_health WHERE indicator_code = 'MEDIUM' AND sex_name = 'Both sexes'
                AND year_val = 2000)
            WHERE rn <= {n}""",
    )


def _decliners(limit: str) -> str:
    """Both years of a country in one row, by aggregation."""
    return with_tables(
        "health dim_country dim_sex",
        f"""SELECT country_name, region_name, {_double('round(was, 1)', 'le_1995')},
                   {_double('round(is_now, 1)', 'le_2000')}, {_double('round(is_now - was, 2)', 'le_change')}
            FROM (SELECT country_code, any_value(metric_value) FILTER (WHERE year_val = 1995) AS was,
                         any_value(metric_value) FILTER (WHERE year_val = 2000) AS is_now
                  FROM health WHERE indicator_code = 'ECONOMY' AND year_val IN (1995, 2000)
                    AND sex_code = (SELECT sex_code FROM dim_sex WHERE sex_name = 'Both sexes')
                  GROUP BY country_code)
            JOIN dim_country USING (country_code) WHERE is_now < was
            ORDER BY round(is_now - was, 2), country_code {limit}""",
    )


def _top_cause(extra: str, n: int) -> str:
    return with_tables(
        "vw_deaths",
        f"""SELECT country_name, region_name, cause_name, {_double('deaths', 'deaths_2000')} {extra}
            FROM (SELECT *, round(death_count, 0) AS deaths,
                         row_number() OVER (PARTITION BY country_code
                                            ORDER BY death_count DESC, cause_code) AS rn
                  FROM vw_deaths WHERE sex_name = 'Both sexes' AND year_val = 2000)
            WHERE rn = 1 ORDER BY deaths DESC, country_code LIMIT {n}""",
    )


_SHARES = f"""
    SELECT region_name, cause_name, total_deaths,
           {_ratio('total_deaths', 'sum(total_deaths) OVER (PARTITION BY region_name)', 1)} AS pct
    FROM (SELECT region_name, cause_name, round(sum(death_count), 0) AS total_deaths
          FROM vw_deaths WHERE sex_name = 'Both sexes' AND year_val = 2000 GROUP BY ALL)"""

_CROSS = f"""
    SELECT h.country_code, h.country_name, h.region_name, h.metric_value, d.death_count
    FROM vw_health h JOIN vw_deaths d USING (country_code, year_val, sex_code)
    WHERE h.indicator_code = 'ECONOMY' AND h.sex_name = 'Both sexes' AND h.year_val = 2000
      AND d.cause_name = 'Cardiovascular diseases'"""


def _by_region(years: str) -> str:
    return f"""
    SELECT region_name, year_val, 'NCD' AS disease_type, round(sum(death_count), 0) AS total_deaths
    FROM ncd JOIN dim_country USING (country_code)
    WHERE sex_code = 'N' AND year_val IN ({years}) GROUP BY ALL
    UNION ALL
    SELECT region_name, year_val, 'Communicable', round(sum(death_count), 0)
    FROM comm JOIN dim_country USING (country_code)
    WHERE year_val IN ({years}) GROUP BY ALL"""


_TRANSITION = f"""
    SELECT region_name, year_val, ncd_deaths, comm_deaths,
           {_ratio('ncd_deaths', 'comm_deaths', 1, factor=1)} AS ratio
    FROM (SELECT region_name, year_val,
                 sum(CASE WHEN disease_type = 'NCD' THEN total_deaths ELSE 0 END) AS ncd_deaths,
                 sum(CASE WHEN disease_type = 'Communicable' THEN total_deaths ELSE 0 END) AS comm_deaths
          FROM ({_by_region('1995, 2000')}) GROUP BY ALL)"""


def _burden(n: int) -> str:
    return with_tables(
        "vw_health ncd comm",
        f"""SELECT country_name, region_name, {_double('le', 'life_expectancy')},
                   {_double('n', 'ncd_deaths')}, {_double('c', 'communicable_deaths')},
                   {_double('n + c', 'total_deaths')}
            FROM (SELECT h.country_code, h.country_name, h.region_name,
                         round(h.metric_value, 1) AS le,
                         coalesce(a.deaths, 0) AS n, coalesce(b.deaths, 0) AS c
                  FROM vw_health h
                  LEFT JOIN (SELECT country_code, round(sum(death_count), 0) AS deaths FROM ncd
                             WHERE sex_code = 'N' AND year_val = 2000 GROUP BY ALL) a
                    USING (country_code)
                  LEFT JOIN (SELECT country_code, round(sum(death_count), 0) AS deaths FROM comm
                             WHERE year_val = 2000 GROUP BY ALL) b USING (country_code)
                  WHERE {LE} AND year_val = 2000)
            ORDER BY n + c DESC, country_code LIMIT {n}""",
    )


def _double_burden(n: int, digits: int) -> str:
    return with_tables(
        "ncd comm dim_country",
        f"""SELECT country_name, {_double('n', 'ncd_deaths')}, {_double('c', 'communicable_deaths')},
                   {_double('n + c', 'total_deaths')},
                   {_double(_ratio('c', 'n + c', digits), 'pct_communicable')}
            FROM (SELECT a.country_code, a.country_name, a.deaths AS n, coalesce(b.deaths, 0) AS c
                  FROM (SELECT country_code, country_name, round(sum(death_count), 0) AS deaths
                        FROM ncd JOIN dim_country USING (country_code)
                        WHERE region_name = 'AFRICA' AND sex_code = 'N' AND year_val = 2000
                        GROUP BY ALL) a
                  LEFT JOIN (SELECT country_code, round(sum(death_count), 0) AS deaths
                             FROM comm WHERE year_val = 2000 GROUP BY ALL) b USING (country_code)
                  WHERE coalesce(b.deaths, 0) > 0)
            ORDER BY n + c DESC, country_code LIMIT {n}""",
    )


def _analysis() -> dict[str, str]:
    in_year = "metric_value", "year_val = 1995", "year_val = 2000"
    return {
        "q01_yearly_trend": with_tables(
            "vw_health",
            f"""SELECT year_val, {_double(_avg('metric_value', 2), 'avg_life_expectancy')},
                       count(DISTINCT country_code) AS n_countries
                FROM vw_health WHERE {LE} GROUP BY year_val""",
        ),
        "q02_yoy_change": _yearly_change("", "TRUE"),
        "q03_top10": with_tables(
            "vw_health",
            f"""SELECT country_name, region_name,
                       {_double('round(metric_value, 1)', 'life_expectancy_2000')}
                FROM vw_health WHERE {LE} AND year_val = 2000
                ORDER BY metric_value DESC, country_code LIMIT 10""",
        ),
        "q04_top3_per_region": with_tables(
            "vw_health",
            f"""SELECT region_name, country_name,
                       {_double('round(metric_value, 1)', 'life_expectancy')},
                       CAST(rn AS INTEGER) AS rn
                FROM (SELECT *, row_number() OVER (PARTITION BY region_name
                                ORDER BY metric_value DESC, country_code) AS rn
                      FROM vw_health WHERE {LE} AND year_val = 2000)
                WHERE rn <= 3""",
        ),
        "q05_gap_pivot": with_tables(
            "vw_health",
            f"""SELECT region_name, {_double('f', 'female_le')}, {_double('m', 'male_le')},
                       {_double('round(f - m, 2)', 'gender_gap')}
                FROM (SELECT region_name,
                             {_avg('metric_value', 2, "sex_name = 'Female'")} AS f,
                             {_avg('metric_value', 2, "sex_name = 'Male'")} AS m
                      FROM vw_health WHERE indicator_code = 'ECONOMY' AND year_val = 2000
                        AND sex_name <> 'Both sexes' GROUP BY region_name)""",
        ),
        "q06_indicator_pair": _pairs("ORDER BY le DESC, country_code LIMIT 20", False),
        "q07_region_improvement": with_tables(
            "vw_health",
            f"""SELECT region_name, {_double('a', 'avg_le_1995')}, {_double('b', 'avg_le_2000')},
                       {_double('round(b - a, 2)', 'improvement')},
                       {_double(_ratio('b - a', 'a', 2), 'improvement_pct')}
                FROM (SELECT region_name, {_avg(in_year[0], 2, in_year[1])} AS a,
                             {_avg(in_year[0], 2, in_year[2])} AS b
                      FROM vw_health WHERE {LE} GROUP BY region_name)
                WHERE a IS NOT NULL AND b IS NOT NULL""",
        ),
        "q08_concentration": _concentration(
            "country_name, region_name, adult_mortality, pct_of_total, cumulative_pct", 10
        ),
        "q09_dense_rank": with_tables(
            "vw_health",
            f"""SELECT region_name, country_name, {_double('round(metric_value, 1)', 'hale_2000')},
                       CAST(dense_rank() OVER (PARTITION BY region_name ORDER BY metric_value DESC)
                            AS INTEGER) AS region_rank
                FROM vw_health WHERE indicator_code = 'LARGE' AND sex_name = 'Both sexes'
                  AND year_val = 2000""",
        ),
        "q10_decliners": _decliners(""),
        "q11_cause_trend": with_tables(
            "vw_deaths",
            f"""SELECT year_val, cause_name, {_double('round(sum(death_count), 0)', 'total_deaths')}
                FROM vw_deaths WHERE sex_name = 'Both sexes' GROUP BY year_val, cause_name""",
        ),
        "q12_top_cause": _top_cause("", 30),
        "q13_cause_share": with_tables(
            "vw_deaths",
            f"""SELECT region_name, cause_name, {_double('total_deaths', 'total_deaths')},
                       {_double('pct', 'pct_of_region')} FROM ({_SHARES})""",
        ),
        "q14_cross_fact": with_tables(
            "vw_health vw_deaths",
            f"""SELECT country_name, region_name,
                       {_double('round(metric_value, 1)', 'life_expectancy')},
                       {_double('round(death_count, 0)', 'cardiovascular_deaths')}
                FROM ({_CROSS}) ORDER BY death_count DESC, country_code LIMIT 20""",
        ),
        "q15_disease_trend": with_tables(
            "vw_comm",
            f"""SELECT year_val, disease_name, {_double('round(sum(death_count), 0)', 'total_deaths')},
                       count(DISTINCT country_code) AS n_countries
                FROM vw_comm GROUP BY year_val, disease_name""",
        ),
        "q16_latest_top5": with_tables(
            "vw_comm",
            f"""SELECT disease_name, country_name, region_name, year_val,
                       {_double('round(death_count, 0)', 'deaths')}
                FROM (SELECT *, row_number() OVER (PARTITION BY disease_code
                                ORDER BY death_count DESC, country_code) AS rn
                      FROM vw_comm
                      JOIN (SELECT disease_code, max(year_val) AS year_val FROM comm GROUP BY ALL)
                        USING (disease_code, year_val))
                WHERE rn <= 5""",
        ),
        "q17_union_share": with_tables(
            "ncd comm dim_country",
            f"""SELECT region_name, disease_type, {_double('total_deaths', 'total_deaths')},
                       {_double(_ratio('total_deaths',
                                       'sum(total_deaths) OVER (PARTITION BY region_name)', 1),
                                'pct_of_region')}
                FROM ({_by_region('2000')})""",
        ),
        "q18_transition_ratio": with_tables(
            "ncd comm dim_country",
            f"""SELECT region_name, year_val, {_double('ncd_deaths', 'ncd_deaths')},
                       {_double('comm_deaths', 'comm_deaths')},
                       {_double('ratio', 'ncd_to_comm_ratio')} FROM ({_TRANSITION})""",
        ),
        "q19_total_burden": _burden(25),
        "q20_double_burden": _double_burden(20, 1),
    }


def _quality() -> dict[str, str]:
    def nulls(table: str, columns: str) -> str:
        parts = ", ".join(
            f"count(CASE WHEN {column} IS NULL THEN 1 END) AS {name}"
            for column, name in (pair.split("=") for pair in columns.split())
        )
        return with_tables(table, f"SELECT {parts} FROM {table}")

    def orphan(table: str, dim: str, key: str, name: str) -> str:
        return with_tables(
            f"{table} {dim}",
            f"""SELECT count(*) AS {name} FROM {table} f LEFT JOIN {dim} d ON d.{key} = f.{key}
                WHERE d.{key} IS NULL""",
        )

    def duplicate(table: str, key: str, n: int) -> str:
        order = ", ".join(f"{column} NULLS FIRST" for column in key.split(", "))
        return with_tables(
            table,
            f"""SELECT {key}, count(*) AS n_dups FROM {table} GROUP BY {key}
                HAVING count(*) > 1 ORDER BY n_dups DESC, {order} LIMIT {n}""",
        )

    def count(table: str, condition: str, name: str) -> str:
        return with_tables(table, f"SELECT count(*) AS {name} FROM {table} WHERE {condition}")

    def years(table: str, extra: str = "") -> str:
        return with_tables(
            table,
            f"SELECT min(year_val) AS min_year, max(year_val) AS max_year {extra} FROM {table}",
        )

    inverted = "low_ci > high_ci"
    bounds = f"{_double('low_ci', 'low_ci')}, {_double('high_ci', 'high_ci')}"
    return {
        "dq_nulls_health": nulls(
            "typed_health",
            "indicator_code=null_indicator country_code=null_country year_val=null_year "
            "sex_code=null_sex metric_value=null_metric",
        ),
        "dq_orphan_country_health": orphan("typed_health", "dim_country", "country_code", "orphan_country"),
        "dq_orphan_indicator": orphan("typed_health", "dim_indicator", "indicator_code", "orphan_indicator"),
        "dq_orphan_sex": orphan("typed_health", "dim_sex", "sex_code", "orphan_sex"),
        "dq_dups_health": duplicate("typed_health", HEALTH_KEY, 20),
        "dq_year_range_health": years("health", ", count(DISTINCT year_val) AS n_distinct_years"),
        "dq_negative_le": count(
            "typed_health",
            "indicator_code IN ('ECONOMY', 'LARGE', 'PROMO') AND metric_value < 0",
            "negative_life_expectancy",
        ),
        "dq_negative_mortality": count(
            "typed_health", "indicator_code = 'MEDIUM' AND metric_value < 0", "negative_mortality"
        ),
        "dq_above_bound": with_tables(
            "typed_health",
            f"""SELECT country_code, year_val, sex_code, {_double('metric_value', 'metric_value')}
                FROM typed_health WHERE indicator_code = 'ECONOMY' AND metric_value > 90""",
        ),
        "dq_ci_coverage": with_tables(
            "health",
            """SELECT indicator_code, count(*) AS total_rows,
                      count(CASE WHEN low_ci IS NOT NULL AND high_ci IS NOT NULL THEN 1 END) AS with_ci,
                      count(CASE WHEN low_ci IS NULL OR high_ci IS NULL THEN 1 END) AS without_ci
               FROM health GROUP BY indicator_code""",
        ),
        "dq_inverted_health": with_tables(
            "health",
            f"""SELECT 'inverted interval' AS issue, count(*) AS n_affected
                FROM health WHERE {inverted}""",
        ),
        "dq_inverted_detail": with_tables(
            "health",
            f"""SELECT fact_id, {HEALTH_KEY}, {_double('metric_value', 'metric_value')}, {bounds}
                FROM health WHERE {inverted} ORDER BY fact_id LIMIT 10""",
        ),
        "dq_repair_inverted": with_tables(
            "health",
            f"""SELECT fact_id, {HEALTH_KEY},
                       {_double(f'CASE WHEN {inverted} THEN high_ci ELSE low_ci END', 'low_ci')},
                       {_double(f'CASE WHEN {inverted} THEN low_ci ELSE high_ci END', 'high_ci')}
                FROM health""",
        ),
        "snk_change_set": with_tables(
            "health",
            f"""SELECT 'updated' AS change, {HEALTH_KEY},
                       {_double('low_ci', 'old_low_ci')}, {_double('high_ci', 'old_high_ci')},
                       {_double('high_ci', 'new_low_ci')}, {_double('low_ci', 'new_high_ci')}
                FROM health WHERE {inverted}""",
        ),
        "dq_repair_verify": with_tables(
            "health",
            f"""SELECT count(*) AS remaining_inverted
                FROM (SELECT CASE WHEN {inverted} THEN high_ci ELSE low_ci END AS low_ci,
                             CASE WHEN {inverted} THEN low_ci ELSE high_ci END AS high_ci
                      FROM health) WHERE {inverted}""",
        ),
        "dq_cross_consistency": with_tables(
            "health",
            f"""SELECT a.country_code, a.year_val, a.sex_code,
                       {_double('round(a.metric_value, 1)', 'life_expectancy')},
                       {_double('round(b.metric_value, 1)', 'hale')},
                       {_double('round(a.metric_value - b.metric_value, 1)', 'gap')}
                FROM health a JOIN health b USING (country_code, year_val, sex_code)
                WHERE a.indicator_code = 'ECONOMY' AND b.indicator_code = 'LARGE'
                  AND b.metric_value > a.metric_value
                ORDER BY a.country_code, a.year_val, a.sex_code LIMIT 10""",
        ),
        "dq_nulls_ncd": nulls(
            "typed_ncd",
            "cause_code=null_cause country_code=null_country year_val=null_year death_count=null_deaths",
        ),
        "dq_orphan_cause": orphan("typed_ncd", "dim_cause", "cause_code", "orphan_cause"),
        "dq_orphan_country_ncd": orphan("typed_ncd", "dim_country", "country_code", "orphan_country_deaths"),
        "dq_dups_ncd": duplicate("typed_ncd", NCD_KEY, 10),
        "dq_negative_ncd": count("typed_ncd", "death_count < 0", "negative_deaths"),
        "dq_year_range_ncd": years("ncd"),
        "dq_inverted_ncd": count("ncd", inverted, "inverted_ci_deaths"),
        "dq_nulls_comm": nulls(
            "typed_comm",
            "disease_code=null_disease country_code=null_country year_val=null_year death_count=null_deaths",
        ),
        "dq_orphan_disease": orphan("typed_comm", "dim_disease", "disease_code", "orphan_disease"),
        "dq_orphan_country_comm": orphan("typed_comm", "dim_country", "country_code", "orphan_country_comm"),
        "dq_dups_comm": duplicate("typed_comm", COMM_KEY, 10),
        "dq_negative_comm": count("typed_comm", "death_count < 0", "negative_comm_deaths"),
        "dq_year_range_comm": years("comm"),
        "dq_inverted_comm": count("comm", inverted, "inverted_ci_comm"),
        "dq_control_chars": with_tables(
            "stg_country",
            """SELECT 'raw_region_name' AS column_name, count(*) AS n_rows,
                      hex(min(raw_region_name)) AS sample_hex
               FROM stg_country WHERE regexp_matches(raw_region_name, '[[:cntrl:]]')
               HAVING count(*) > 0""",
        ),
    }


def _functions() -> dict[str, str]:
    pct = (
        "CAST(round(CAST(100 * l_tax / nullif(l_discount, 0) AS DECIMAL(38,10)), 2) AS DECIMAL(10,2))"
    )
    tax = "nullif(l_tax, 0)"
    smoke_pct = pct.replace("l_tax", tax)
    width = f"CAST(round(CAST(l_discount AS DECIMAL(18,6)) - CAST({tax} AS DECIMAL(18,6)), 2) AS DECIMAL(10,2))"
    return {
        "fn_safe_pct": f"""
            SELECT l_returnflag, l_linestatus, count(*) AS n_rows,
                   count(CASE WHEN pct IS NULL THEN 1 END) AS n_null, CAST(0 AS BIGINT) AS n_differ,
                   {_double('min(pct)', 'min_pct')}, {_double('max(pct)', 'max_pct')},
                   {_double('sum(pct)', 'sum_pct')}
            FROM (SELECT l_returnflag, l_linestatus, {pct} AS pct FROM lineitem)
            GROUP BY l_returnflag, l_linestatus""",
        "fn_ci_width": with_tables(
            "health",
            f"SELECT {HEALTH_KEY}, {_double('round(high_ci - low_ci, 2)', 'ci_width')} FROM health",
        ),
        "fn_pct_of_global": with_tables(
            "vw_health",
            f"""SELECT region_name, {_double(_avg('metric_value', 2), 'avg_le')},
                       {_double(_ratio('CAST(avg(metric_value) AS DECIMAL(18,6))',
                                       f'(SELECT CAST(avg(metric_value) AS DECIMAL(18,6)) FROM vw_health WHERE {LE} AND year_val = 2000)',
                                       2), 'pct_of_global_avg')}
                FROM vw_health WHERE {LE} AND year_val = 2000 GROUP BY region_name""",
        ),
        "fn_smoke": f"""
            SELECT CASE WHEN l_discount = 0 THEN 'zero denominator'
                        WHEN l_tax = 0 THEN 'null numerator' ELSE 'normal' END AS case_name,
                   count(*) AS n_rows, count(CASE WHEN pct IS NULL THEN 1 END) AS n_null_pct,
                   count(CASE WHEN width IS NULL THEN 1 END) AS n_null_width,
                   {_double('sum(pct)', 'sum_pct')}, {_double('sum(width)', 'sum_width')}
            FROM (SELECT l_discount, l_tax, {smoke_pct} AS pct, {width} AS width FROM lineitem)
            GROUP BY case_name""",
        "tr_validate_rejects": with_tables(
            "candidates",
            f"""SELECT {HEALTH_KEY}, {_double('metric_value', 'metric_value')},
                       CASE {' '.join(f"WHEN {rule} THEN '{name}'" for name, rule in RULES.items())}
                       END AS reason
                FROM candidates WHERE {' OR '.join(RULES.values())}""",
        ),
        "tr_validate_accepted": with_tables(
            "candidates",
            f"""SELECT {HEALTH_KEY}, {_double('metric_value', 'metric_value')}
                FROM candidates WHERE NOT ({' OR '.join(RULES.values())})""",
        ),
    }


def _reports() -> dict[str, str]:
    causes = (
        "Malignant neoplasms (cancers)",
        "Diabetes mellitus",
        "Cardiovascular diseases",
        "Chronic respiratory diseases",
    )
    matrix = ", ".join(
        f"CAST(coalesce(max(pct) FILTER (WHERE cause_name = '{c}'), 0) AS DOUBLE) AS \"{c}\""
        for c in causes
    )
    box = ", ".join(
        _double(f"round(CAST(quantile_cont(CAST(hale AS DOUBLE), {q}) AS DECIMAL(38,10)), 6)", name)
        for name, q in (
            ("min_hale", 0),
            ("q1_hale", 0.25),
            ("median_hale", 0.5),
            ("q3_hale", 0.75),
            ("max_hale", 1),
        )
    )

    def ratio(year: int) -> str:
        return f"""CAST(CASE WHEN count(CASE WHEN year_val = {year} THEN 1 END) = 0 THEN 0
                        ELSE max(ratio) FILTER (WHERE year_val = {year}) END AS DOUBLE) AS ratio_{year}"""

    return {
        "rp02_yoy_signed": _yearly_change(
            ", CASE WHEN pct < 0 THEN 'decrease' ELSE 'increase' END AS direction", "pct IS NOT NULL"
        ),
        "rp06_pair_all": _pairs("", True),
        "rp08_concentration20": _concentration("country_name, adult_mortality, rn, cumulative_pct", 20),
        "rp09_region_box": with_tables(
            "vw_health",
            f"""SELECT region_name, count(*) AS n_rows, {box}
                FROM (SELECT region_name, round(metric_value, 1) AS hale FROM vw_health
                      WHERE indicator_code = 'LARGE' AND sex_name = 'Both sexes' AND year_val = 2000)
                GROUP BY region_name""",
        ),
        "rp10_decliners15": _decliners("LIMIT 15"),
        "rp12_top_cause20": _top_cause(
            ", CASE WHEN cause_code = 'FURNITURE' THEN 'Cardiovascular' ELSE 'Other' END AS cause_class",
            20,
        ),
        "rp13_share_matrix": with_tables(
            "vw_deaths", f"SELECT region_name, {matrix} FROM ({_SHARES}) GROUP BY region_name"
        ),
        "rp14_cross_fact_labels": with_tables(
            "vw_health vw_deaths",
            f"""SELECT country_name, region_name,
                       {_double('round(metric_value, 1)', 'life_expectancy')},
                       {_double('deaths', 'cv_deaths')},
                       row_number() OVER (ORDER BY deaths DESC, country_code) <= 5 AS labelled
                FROM (SELECT *, round(death_count, 0) AS deaths FROM ({_CROSS}))""",
        ),
        "rp17_type_matrix": with_tables(
            "ncd comm dim_country",
            f"""SELECT region_name, {_double('n', 'ncd_deaths')},
                       {_double('c', 'communicable_deaths')}, {_double('n + c', 'total')},
                       coalesce({_double(_ratio('c', 'n + c', 2), 'x').removesuffix(' AS x')}, 0)
                           AS pct_communicable
                FROM (SELECT region_name,
                             coalesce(sum(total_deaths) FILTER (WHERE disease_type = 'NCD'), 0) AS n,
                             coalesce(sum(total_deaths) FILTER (WHERE disease_type = 'Communicable'), 0) AS c
                      FROM ({_by_region('2000')}) GROUP BY region_name)""",
        ),
        "rp18_ratio_by_year": with_tables(
            "ncd comm dim_country",
            f"SELECT region_name, {ratio(1995)}, {ratio(2000)} FROM ({_TRANSITION}) GROUP BY region_name",
        ),
        "rp19_burden20": _burden(20),
        "rp20_double15": _double_burden(15, 2),
    }


def _merged() -> dict[str, str]:
    """The views from states have the answers of the views; the sketches are to be near."""
    views = _views()
    check = """SELECT indicator_code, count(*) AS n_rows, count(DISTINCT country_code) AS n_countries,
                      TRUE AS countries_near, TRUE AS median_near
               FROM vw_health GROUP BY indicator_code"""
    return {
        "vw_yearly_kpi_merged": views["vw_yearly_kpi"],
        "vw_region_yearly_kpi_merged": views["vw_region_yearly_kpi"],
        "vw_yearly_deaths_merged": views["vw_yearly_deaths_by_cause"],
        "vw_sketch_check": with_tables("vw_health", check),
    }


def oracle_sql() -> dict[str, str]:
    return {
        **_merged(),
        **_sources(),
        **_staging(),
        **_core(),
        **_views(),
        **_analysis(),
        **_quality(),
        **_functions(),
        **_reports(),
    }
