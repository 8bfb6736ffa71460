"""Domain settings: static dimension members and the roles some of them play.

Every job takes a ``Profile`` so the same plans run on the health data model and
on any other source that can be staged into the same four raw tables.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Profile:
    # static dimension members
    sexes: tuple[tuple[str, str], ...]
    indicators: tuple[tuple[str, str, str], ...]
    causes: tuple[tuple[str, str], ...]
    diseases: tuple[tuple[str, str, str], ...]
    # roles
    life_expectancy: str
    healthy_life: str
    adult_mortality: str
    life_at_60: str
    both_sexes: str
    male: str
    female: str
    cardiovascular: str
    focus_region: str
    # comparison points
    base_year: int
    late_year: int
    deaths_base_year: int
    deaths_year: int
    value_bound: int
    # validation and level of detail
    country_level: str = "COUNTRY"
    first_year: int = 1900
    last_year: int = 2100

    @property
    def non_negative(self) -> tuple[str, str, str]:
        """Indicators whose value may not be below zero."""
        return (self.life_expectancy, self.healthy_life, self.life_at_60)


# Codes and labels of the health data model.
HEALTH = Profile(
    sexes=(
        ("SEX_BTSX", "Both sexes"),
        ("SEX_MLE", "Male"),
        ("SEX_FMLE", "Female"),
    ),
    indicators=(
        ("WHOSIS_000001", "Life expectancy at birth", "years"),
        ("WHOSIS_000002", "Healthy life expectancy (HALE) at birth", "years"),
        ("WHOSIS_000004", "Adult mortality rate (15-60)", "per 1000 population"),
        ("WHOSIS_000015", "Life expectancy at age 60", "years"),
    ),
    causes=(
        ("GHECAUSES_GHE061", "Malignant neoplasms (cancers)"),
        ("GHECAUSES_GHE080", "Diabetes mellitus"),
        ("GHECAUSES_GHE110", "Cardiovascular diseases"),
        ("GHECAUSES_GHE117", "Chronic respiratory diseases"),
    ),
    diseases=(
        ("TB_e_mort_exc_tbhiv_num", "Tuberculosis", "communicable"),
        ("MALARIA_EST_DEATHS", "Malaria", "communicable"),
        ("HIV_0000000006", "HIV/AIDS", "communicable"),
        ("HEPATITIS_HBV_DEATHS_NUM", "Hepatitis B", "communicable"),
        ("HEPATITIS_HCV_DEATHS_NUM", "Hepatitis C", "communicable"),
    ),
    life_expectancy="WHOSIS_000001",
    healthy_life="WHOSIS_000002",
    adult_mortality="WHOSIS_000004",
    life_at_60="WHOSIS_000015",
    both_sexes="SEX_BTSX",
    male="SEX_MLE",
    female="SEX_FMLE",
    cardiovascular="GHECAUSES_GHE110",
    focus_region="Africa",
    base_year=2000,
    late_year=2021,
    deaths_base_year=2000,
    deaths_year=2019,
    value_bound=100,
)

# The order tables staged into the same model (see sources/order_tables.py).
RETAIL = Profile(
    sexes=(("N", "Both sexes"), ("A", "Male"), ("R", "Female")),
    indicators=(
        ("ECONOMY", "Life expectancy at birth", "years"),
        ("LARGE", "Healthy life expectancy (HALE) at birth", "years"),
        ("MEDIUM", "Adult mortality rate (15-60)", "per 1000 population"),
        ("PROMO", "Life expectancy at age 60", "years"),
    ),
    causes=(
        ("AUTOMOBILE", "Malignant neoplasms (cancers)"),
        ("BUILDING", "Diabetes mellitus"),
        ("FURNITURE", "Cardiovascular diseases"),
        ("HOUSEHOLD", "Chronic respiratory diseases"),
    ),
    diseases=(
        ("1-URGENT", "URGENT", "communicable"),
        ("2-HIGH", "HIGH", "communicable"),
        ("3-MEDIUM", "MEDIUM", "communicable"),
        ("4-NOT SPECIFIED", "NOT SPECIFIED", "communicable"),
        ("5-LOW", "LOW", "communicable"),
    ),
    life_expectancy="ECONOMY",
    healthy_life="LARGE",
    adult_mortality="MEDIUM",
    life_at_60="PROMO",
    both_sexes="N",
    male="A",
    female="R",
    cardiovascular="FURNITURE",
    focus_region="AFRICA",
    base_year=1995,
    late_year=2000,
    deaths_base_year=1995,
    deaths_year=2000,
    value_bound=90,
)
