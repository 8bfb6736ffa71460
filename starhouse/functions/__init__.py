from starhouse.functions.measures import ci_width, percent, quotient, register_sql_functions, safe_pct
from starhouse.functions.text import clean_text, is_blank, is_number, is_year, null_if_blank

__all__ = [
    "ci_width",
    "clean_text",
    "is_blank",
    "is_number",
    "is_year",
    "null_if_blank",
    "percent",
    "quotient",
    "register_sql_functions",
    "safe_pct",
]
