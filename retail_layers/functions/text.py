"""String expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted e-mail shape and the least number of phone digits.
# ``\z`` is the end of the text; Java's ``$`` would also accept a final newline.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"
MIN_PHONE_DIGITS = 6


def blank_to_null(text: Column, tokens: Sequence[str] = ()) -> Column:
    """NULL for ``''`` and for any of the given spellings of a missing value."""
    if not tokens:
        return F.nullif(text, F.lit(""))
    return F.when(~text.isin("", *tokens), text)


def trimmed(text: Column) -> Column:
    """Strip spaces, and only spaces, from both ends."""
    return F.trim(text)


def title_case(text: Column) -> Column:
    return F.initcap(text)


def lower_trimmed(text: Column) -> Column:
    return F.lower(F.trim(text))


def upper_trimmed(text: Column) -> Column:
    return F.upper(F.trim(text))


def is_email(text: Column) -> Column:
    return text.rlike(EMAIL_PATTERN)


def without_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", "")


def has_digits(text: Column, at_least: int = MIN_PHONE_DIGITS) -> Column:
    return F.length(F.regexp_replace(text, r"\D+", "")) >= at_least


def is_longer_than(text: Column, limit: int) -> Column:
    return F.length(text) > limit


def cut(text: Column, limit: int) -> Column:
    return F.substring(text, 1, limit)
