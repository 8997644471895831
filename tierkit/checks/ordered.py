"""Checks over an order of rows, with or without groups.

Equal rows are counted first (partial aggregation folds copies before the shuffle), so a
value shared by a third of the table is one row with a count; then neighbours are compared
by :func:`compare_with_previous`, which spreads a big group over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkit.checks.core import Check
from tierkit.operators.neighbours import compare_with_previous

GAP_RULES = {
    "not_allowed": lambda upper, following: upper == following,
    "allowed": lambda upper, following: upper <= following,
    "required": lambda upper, following: upper < following,
}


def _entries(neighbour: str, *cases: tuple[Column, Column, Column]) -> Column:
    """One output row (neighbour, n_rows) per case that holds."""
    rows = [
        F.when(holds, F.struct(value.alias(neighbour), n.cast("bigint").alias("n_rows"))) for holds, value, n in cases
    ]
    return F.inline(F.array_compact(F.array(*rows)))


def mutually_exclusive_ranges(
    lower: str,
    upper: str,
    partition_by: Sequence[str] = (),
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
) -> Check:
    """Ranges with lower >= upper, a NULL bound, or a clash with the next range of the group.

    The bounds are column names or SQL expressions, such as a stand-in for an open end.
    Violations: group columns, lower_bound, upper_bound, next_lower_bound, n_rows.
    """
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {list(GAP_RULES)}, got {gaps!r}")

    def bad_before(following: Column) -> Column:
        low, up = F.col("lower_bound"), F.col("upper_bound")
        sound = low <= up if zero_length_range_allowed else low < up
        return ~(F.coalesce(sound, F.lit(False)) & F.coalesce(GAP_RULES[gaps](up, following), F.lit(True)))

    def find(df: DataFrame) -> DataFrame:
        bounds = [F.expr(lower).alias("lower_bound"), F.expr(upper).alias("upper_bound")]
        ranges = df.groupBy(*partition_by, *bounds).agg(F.count("*").alias("copies"))
        # the sort runs backwards, so the "previous" row is the next range
        following = F.col("_prev_lower_bound")
        bad_last, bad_copy = bad_before(following), bad_before(F.col("lower_bound"))
        found = compare_with_previous(
            ranges,
            partition_by,
            [F.desc_nulls_first("lower_bound"), F.desc_nulls_first("upper_bound")],
            ["lower_bound"],
            bad_last | (bad_copy & (F.col("copies") > 1)),
        )
        # Of n equal ranges n - 1 are followed by their own copy and the last by the next
        # range; where that one starts alike, the n rows look the same.
        alike = following.eqNullSafe(F.col("lower_bound"))
        own = F.col("copies") - F.when(alike, 0).otherwise(1)
        return found.select(
            *partition_by,
            "lower_bound",
            "upper_bound",
            _entries(
                "next_lower_bound",
                (bad_copy & (own > 0), F.col("lower_bound"), own),
                (bad_last & ~alike, following, F.lit(1)),
            ),
        )

    return Check(f"mutually_exclusive_ranges_{lower}_{upper}", find, fail_calc="sum(n_rows)")


def sequential_values(
    column: str,
    interval: int = 1,
    datepart: str | None = None,
    group_by: Sequence[str] = (),
) -> Check:
    """Values that are not the previous one plus ``interval`` (dateparts, if given).

    Violations: group columns, value, previous_value, n_rows. The first value of a group and
    NULLs pass; a repeated value is a violation.
    """

    def after(value: Column) -> Column:
        if datepart is None:
            return value + interval
        return F.timestamp_add(datepart.upper(), F.lit(interval), value)

    def comparable(value: Column) -> Column:
        return value if datepart is None else value.cast("timestamp_ntz")

    def find(df: DataFrame) -> DataFrame:
        filled = df.filter(F.col(column).isNotNull()).groupBy(*group_by, comparable(F.col(column)).alias("value"))
        values = filled.agg(F.count("*").alias("copies"))
        breaks = F.col("_has_prev") & (F.col("value") != after(F.col("_prev_value")))
        repeats = (F.col("copies") > 1) & F.lit(interval != 0)
        found = compare_with_previous(values, group_by, [F.asc_nulls_last("value")], ["value"], breaks | repeats)

        again = F.col("copies") - 1
        return found.select(
            *group_by,
            "value",
            _entries("previous_value", (breaks, F.col("_prev_value"), F.lit(1)), (repeats, F.col("value"), again)),
        )

    return Check(f"sequential_values_{column}", find, fail_calc="sum(n_rows)")
