"""Cleaning of raw listing text. Junk becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: formats of the scraped text
MILEAGE_SUFFIX = " Km"
HOURS_SUFFIX = " hours ago"
MINUTES_SUFFIX = " minutes ago"
DATE_SHAPE = r"^\s*(\d{1,2}/\d{1,2}/\d{4})"
DATE_IN = "d/M/yyyy"
DATE_OUT = "dd-MMM-yyyy"


# a plain decimal number; a cast alone would also take NaN, Infinity and the suffixes f and d
NUMBER_SHAPE = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*\z"


def number(c: Column) -> Column:
    """``c`` stands in the expression once: what it is made of is not worked out twice."""
    return F.regexp_extract(c, NUMBER_SHAPE, 0).try_cast("double")


def _without(c: Column, text: str) -> Column:
    return F.replace(c, F.lit(text), F.lit(""))


def plain_number(c: Column) -> Column:
    """Text with thousands commas to double."""
    return number(_without(c, ","))


def clean_mileage(c: Column) -> Column:
    return plain_number(_without(c, MILEAGE_SUFFIX))


def clean_price(c: Column) -> Column:
    return plain_number(c)


def cast_cylinder(c: Column) -> Column:
    """To integer through double, so ``6.0`` is read as 6."""
    return number(c.cast("string")).try_cast("int")


def sold_date(time: Column) -> Column:
    """The sale date where ``time`` carries one, as a real date."""
    shape = F.regexp_extract(time, DATE_SHAPE, 1)
    return F.when(time.contains("/"), F.try_to_date(shape, DATE_IN))


def parse_date_sold(time: Column) -> Column:
    """Sale date as text; ``""`` = not sold, null = looks like a date but is none."""
    return F.when(time.contains("/"), F.date_format(sold_date(time), DATE_OUT)).otherwise("")


def parse_posted_hours(time: Column, singular: bool = False) -> Column:
    """Age of the posting in hours; null for any other text.

    ``"1 hour ago"`` is null, as in the published results; ``singular=True`` reads it.
    """
    hours, minutes = _without(time, HOURS_SUFFIX), _without(time, MINUTES_SUFFIX)
    if singular:
        hours, minutes = _without(hours, " hour ago"), _without(minutes, " minute ago")
    return F.when(time.contains("minute"), number(minutes) / 60).when(
        time.contains("hour"), number(hours)
    )


def mileage_tier(mileage: Column, width: float = 10_000.0) -> Column:
    """Mileage rounded up to the next multiple of ``width``; null when missing or negative."""
    return F.when(mileage == 0, F.lit(0.0)).when(
        mileage > 0, F.ceil(mileage / width).cast("double") * width
    )
