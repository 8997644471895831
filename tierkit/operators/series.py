"""Integer series and calendars, generated on the executors by ``spark.range``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATE_PARTS = {"day", "week", "month", "quarter", "year"}
TIME_PARTS = {"microsecond", "millisecond", "second", "minute", "hour"}


def generate_series(spark: SparkSession, upper_bound: int | None) -> DataFrame:
    """generated_number = 1..upper_bound; no rows for None, the maximum of an empty table."""
    if upper_bound is None:
        return spark.range(0).withColumnRenamed("id", "generated_number")
    if upper_bound < 1:
        raise ValueError(f"upper bound must be positive, got {upper_bound}")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def intervals_between(start: Column, end: Column, datepart: str) -> Column:
    """How many steps of ``datepart`` from ``start`` stay before ``end`` (a started one counts)."""
    whole = F.timestamp_diff(datepart.upper(), start, end)
    reached = F.timestamp_add(datepart.upper(), whole, start)
    return whole + F.when(reached < end, 1).otherwise(0)


def date_spine(spark: SparkSession, datepart: str, start, end) -> DataFrame:
    """One row ``date_<part>`` per step, from ``start`` up to but not including ``end``.

    Each date is start + k * part, so month steps from the 31st do not drift.
    """
    part = datepart.lower()
    if part not in DATE_PARTS | TIME_PARTS:
        raise ValueError(f"unknown date part {datepart!r}")
    first, last = (F.lit(v).cast("timestamp_ntz") for v in (start, end))
    steps = spark.range(1).select(intervals_between(first, last, part)).first()[0]
    if steps is None or steps < 1:
        raise ValueError(f"no {part} between {start} and {end}")
    moment = F.timestamp_add(part.upper(), F.col("id"), first)
    out_type = "date" if part in DATE_PARTS else "timestamp_ntz"
    return spark.range(steps).select(moment.cast(out_type).alias(f"date_{part}"))


def date_bounds(df: DataFrame, column: str):
    """First day and the day after the last, to span a calendar over a table.

    One row is fetched while the query is built, by a scan of this one column.
    """
    day = F.col(column).cast("date")
    return tuple(df.agg(F.min(day), F.date_add(F.max(day), 1)).first())
