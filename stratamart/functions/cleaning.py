"""Scrubbing and lenient casting of raw text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that mean "no value", compared in lower case after trimming.
NULL_WORDS = ("n/a", "null", "none", "nan", "", "<na>", "na", "undefined", "unknown")

# Digit counts a phone number may have.
PHONE_DIGITS = (10, 15)

NUMERIC_TARGETS = ("int", "bigint", "double", "float")


def scrub(text: Column) -> Column:
    """Trimmed text, or NULL for any of :data:`NULL_WORDS`."""
    trimmed = F.trim(text)
    return F.when(~F.lower(trimmed).isin(*NULL_WORDS), trimmed)


def parse_number(text: Column, target: str) -> Column:
    """Keep digits, dots and minus signs, then cast; anything malformed is NULL."""
    digits = F.regexp_replace(text, r"[^0-9.\-]", "")
    return F.nullif(digits, F.lit("")).try_cast(target)


def scrub_phone(text: Column) -> Column:
    """Digits of a phone number, or NULL when there are too few or too many."""
    digits = F.regexp_replace(text, r"[^\d]", "")
    return F.when(F.length(digits).between(*PHONE_DIGITS), digits)


def upper_case(text: Column) -> Column:
    return F.upper(F.trim(text))


def title_case(text: Column) -> Column:
    return F.initcap(F.trim(text))


def is_numeric_target(target: str) -> bool:
    return target in NUMERIC_TARGETS or target.startswith("decimal")


def clean_value(value: Column, source: T.DataType, target: str, date_format: str | None = None) -> Column:
    """``value`` of type ``source`` as ``target``; values that do not convert are NULL.

    Numbers are cast as they are: sending them through text would drop the
    exponent of large or small doubles.
    """
    if isinstance(source, T.NumericType) and is_numeric_target(target):
        return value.try_cast(target)
    text = scrub(value.cast("string"))
    if date_format:
        return F.try_to_date(text, date_format)
    if target == "timestamp":
        return F.try_to_timestamp(text)
    if is_numeric_target(target):
        return parse_number(text, target)
    return text if target == "string" else text.try_cast(target)
