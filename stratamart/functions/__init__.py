"""Column expressions; all built in, so they stay inside generated code."""

from stratamart.functions.calendar import calendar_columns, date_key
from stratamart.functions.cleaning import (
    NULL_WORDS,
    clean_value,
    parse_number,
    scrub,
    scrub_phone,
    title_case,
    upper_case,
)
from stratamart.functions.hashing import record_hash
from stratamart.functions.measures import sales_measures

__all__ = [
    "NULL_WORDS",
    "calendar_columns",
    "clean_value",
    "date_key",
    "parse_number",
    "record_hash",
    "sales_measures",
    "scrub",
    "scrub_phone",
    "title_case",
    "upper_case",
]
