"""Checks that aggregate: per key, per group, or against a parent table's keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierkit.checks.core import Check, Keyed


def unique(column: str) -> Check:
    """Non-null values that occur more than once."""

    def find(df: DataFrame) -> DataFrame:
        counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
        return counts.agg(F.count("*").alias("n_records")).filter("n_records > 1")

    return Check(f"unique_{column}", find, keyed=Keyed([column]))


def unique_combination(columns: Sequence[str]) -> Check:
    """Column tuples that occur more than once; NULLs in them count as equal."""

    def find(df: DataFrame) -> DataFrame:
        return df.groupBy(*columns).agg(F.count("*").alias("n_records")).filter("n_records > 1")

    return Check(f"unique_combination_{'_'.join(columns)}", find, keyed=Keyed(columns, skip_null=False))


def relationships(
    column: str,
    to: DataFrame,
    field: str,
    from_condition: str | None = None,
    to_condition: str | None = None,
) -> Check:
    """Non-null child keys missing from the parent, with their number of child rows.

    Both sides are reduced to distinct keys before the shuffle, so no hot key is joined.
    """

    def find(df: DataFrame) -> DataFrame:
        child = df if from_condition is None else df.filter(from_condition)
        parent = to if to_condition is None else to.filter(to_condition)
        keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("from_field"))
        known = parent.select(F.col(field).alias("from_field")).distinct()
        return keys.agg(F.count("*").alias("n_rows")).join(known, "from_field", "left_anti")

    keyed = Keyed([column], condition=from_condition, parent=to, parent_columns=[field], parent_condition=to_condition)
    return Check(f"relationships_{column}_{field}", find, fail_calc="sum(n_rows)", keyed=keyed)


def _group_check(
    name: str,
    group_by: Sequence[str],
    facts: dict[str, Column],
    bad: Column,
    tally: Column,
) -> Check:
    """Violating groups; without groups the table is one group and shares the fused scan."""

    def find(df: DataFrame) -> DataFrame:
        return df.groupBy(*group_by).agg(*[c.alias(n) for n, c in facts.items()]).filter(bad)

    return Check(name, find, tally=None if group_by else F.when(tally, 1).otherwise(0))


def at_least_one(column: str, group_by: Sequence[str] = ()) -> Check:
    """Groups with no non-null value."""
    filled = F.count(column)
    return _group_check(f"at_least_one_{column}", group_by, {"n_filled": filled}, F.col("n_filled") == 0, filled == 0)


def not_constant(column: str, group_by: Sequence[str] = ()) -> Check:
    """Groups whose non-null values are all the same; a group without values passes."""
    low, high = F.min(column), F.max(column)
    return _group_check(
        f"not_constant_{column}",
        group_by,
        {"min_value": low, "max_value": high},
        F.col("min_value") == F.col("max_value"),
        low == high,
    )


def not_null_proportion(column: str, at_least: float, at_most: float = 1.0, group_by: Sequence[str] = ()) -> Check:
    """Groups whose share of non-null values is outside [at_least, at_most]."""
    share = F.try_divide(F.count(column), F.count("*"))

    def outside(value: Column) -> Column:
        return (value < at_least) | (value > at_most)

    return _group_check(
        f"not_null_proportion_{column}",
        group_by,
        {"not_null_proportion": share},
        outside(F.col("not_null_proportion")),
        outside(share),
    )


def recency(
    field: str,
    datepart: str,
    interval: int,
    as_of=None,
    ignore_time_component: bool = False,
    group_by: Sequence[str] = (),
    empty_fails: bool = False,
) -> Check:
    """Groups whose latest ``field`` is older than ``interval`` dateparts before ``as_of`` (now)."""

    def facts(df: DataFrame) -> tuple[Column, Column]:
        ntz = isinstance(df.schema[field].dataType, T.TimestampNTZType)
        moment_type = "timestamp_ntz" if ntz else "timestamp"
        now = F.localtimestamp() if as_of is None else F.lit(as_of)
        limit = F.timestamp_add(datepart.upper(), F.lit(-interval), now.cast(moment_type))
        compared = "date" if ignore_time_component else moment_type
        return F.max(field).cast(compared), limit.cast(compared)

    def outdated(latest: Column, threshold: Column) -> Column:
        bad = latest < threshold
        return bad | latest.isNull() if empty_fails else bad

    def find(df: DataFrame) -> DataFrame:
        latest, threshold = facts(df)
        aged = df.groupBy(*group_by).agg(latest.alias("most_recent")).withColumn("threshold", threshold)
        return aged.filter(outdated(F.col("most_recent"), F.col("threshold")))

    def tally(df: DataFrame) -> Column:
        return F.when(outdated(*facts(df)), 1).otherwise(0)

    return Check(f"recency_{field}", find, tally=None if group_by else tally)
