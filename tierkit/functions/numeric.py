"""Null-safe arithmetic and equi-width bucketing."""

from __future__ import annotations

from functools import reduce
from operator import add, sub

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierkit.functions._columns import as_column


def _zero_filled(fields) -> list[Column]:
    if isinstance(fields, (str, Column)) or not fields:
        raise TypeError("pass a non-empty list of columns")
    return [F.coalesce(as_column(f), F.lit(0)) for f in fields]


def safe_add(fields) -> Column:
    """Sum of the fields with NULL counted as 0."""
    return reduce(add, _zero_filled(fields))


def safe_subtract(fields) -> Column:
    """First field minus the others, left to right, with NULL counted as 0."""
    return reduce(sub, _zero_filled(fields))


def safe_divide(numerator, denominator) -> Column:
    """Real division; NULL when either side is NULL or the denominator is 0."""
    return F.try_divide(as_column(numerator), as_column(denominator))


def width_bucket(value, low, high, buckets) -> Column:
    """Bucket 1..n of equal widths over [low, high); 0 below, n+1 from ``high`` up."""
    return F.width_bucket(
        as_column(value).cast("double"),
        as_column(low).cast("double"),
        as_column(high).cast("double"),
        as_column(buckets).cast("bigint"),
    )
