"""Column expressions for raw text: cleaning and parse tests.

All of them stay inside generated JVM code; none is a Python function per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ASCII control characters, the ones that hide in exported text files.
_CONTROL = "".join(map(chr, [*range(32), 127]))

# ``\z`` and not ``$``: the latter also matches before a trailing line break.
YEAR_PATTERN = r"^[0-9]{4}\z"
NUMBER_PATTERN = r"^-?[0-9]+(\.[0-9]+)?\z"


def clean_text(col: Column) -> Column:
    """Drop control characters, then outer spaces; null becomes ''.

    The order matters: in ``'Africa \\r'`` the space is only an outer one once
    the carriage return is gone. The test in front of the replacement makes the
    usual case, nothing to drop, several times cheaper.
    """
    text = F.coalesce(col, F.lit(""))
    visible = F.when(has_control_chars(text), F.translate(text, _CONTROL, "")).otherwise(text)
    return F.trim(visible)


def has_control_chars(text: Column) -> Column:
    return text.rlike(r"\p{Cntrl}")


def is_blank(col: Column) -> Column:
    return clean_text(col) == ""


def null_if_blank(col: Column) -> Column:
    return F.nullif(clean_text(col), F.lit(""))


# The functions below expect text that has been cleaned already.


def is_year(text: Column) -> Column:
    return text.rlike(YEAR_PATTERN)


def is_number(text: Column) -> Column:
    return text.rlike(NUMBER_PATTERN)


def to_year(text: Column) -> Column:
    """Four digits as SMALLINT, anything else null."""
    return F.when(is_year(text), text.try_cast("smallint"))


def to_number(text: Column, number_type: str) -> Column:
    """Plain decimal notation rounded to the type's scale, anything else null."""
    return F.when(is_number(text), text.try_cast(number_type))
