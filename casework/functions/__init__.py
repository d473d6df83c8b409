"""Column-level helpers with explicit null rules."""

from casework.functions.dates import days_between, month_day_year, not_ended, valid_on, year_month_day
from casework.functions.text import (
    joined_text,
    number_of,
    text_after_last_hyphen,
    text_before_last_hyphen,
)
from casework.functions.values import least_strict, null_ranked, ratio

__all__ = [
    "days_between",
    "joined_text",
    "least_strict",
    "month_day_year",
    "not_ended",
    "null_ranked",
    "number_of",
    "ratio",
    "text_after_last_hyphen",
    "text_before_last_hyphen",
    "valid_on",
    "year_month_day",
]
