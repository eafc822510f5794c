"""Formatting for people. Numbers stay numeric until the last projection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotwise.functions.clean import plain_number


def car_age(year: Column, age_year: int) -> Column:
    return F.lit(age_year) - year


def format_thousands(c: Column, digits: int = 0) -> Column:
    return F.format_number(c, digits)


def round_format(c: Column) -> Column:
    """Round half to even, then format: from the number itself, no text round trip."""
    return F.format_number(F.bround(c, 0), 0)


def reparse_round_format(text: Column) -> Column:
    """The same for a column that only exists as formatted text."""
    return round_format(plain_number(text))


def reparse_number(text: Column) -> Column:
    """Formatted text back to a number."""
    return plain_number(F.trim(text))
