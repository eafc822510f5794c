"""Aggregates and text joins in which a missing value is never silently skipped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _complete(c: Column) -> Column:
    return F.count(c) == F.count(F.lit(1))


def strict_avg(c: Column | str) -> Column:
    """Mean that is null as soon as one input is null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(_complete(c), F.avg(c))


def strict_sum(c: Column | str) -> Column:
    """Sum that is null as soon as one input is null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(_complete(c), F.sum(c))


def paste(*cols: Column) -> Column:
    """Join values with ``-``; a missing value becomes the text ``NA``."""
    return F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit("NA")) for c in cols])


def same(left: Column, right: Column) -> Column:
    """Equality that matches null with null."""
    return left.eqNullSafe(right)


def all_of(conditions) -> Column:
    """True for no conditions."""
    return reduce(lambda x, y: x & y, conditions, F.lit(True))


def any_of(conditions) -> Column:
    """False for no conditions."""
    return reduce(lambda x, y: x | y, conditions, F.lit(False))
