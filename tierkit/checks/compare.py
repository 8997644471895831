"""Checks that compare two tables: one union with side marks and one aggregate, no join.

Every comparison aggregates before it shuffles and treats NULL keys as equal, and a group
that exists on one side only counts as 0 rows on the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkit.checks.core import Check


def _side_counts(a: DataFrame, b: DataFrame, columns: Sequence[Column], b_columns: Sequence[Column] = ()) -> DataFrame:
    """Rows of each side per column tuple, as count_a and count_b."""

    def marked(df: DataFrame, cols: Sequence[Column], in_a: int) -> DataFrame:
        return df.select(*cols, F.lit(in_a).alias("_a"), F.lit(1 - in_a).alias("_b"))

    rows = marked(a, columns, 1).union(marked(b, b_columns or columns, 0))
    keys = [F.col(f"`{c}`") for c in rows.columns[:-2]]
    sums = (F.coalesce(F.sum(s), F.lit(0)).alias(f"count{s}") for s in ("_a", "_b"))
    return rows.groupBy(*keys).agg(*sums)


def equal_rowcount(other: DataFrame, group_by: Sequence[str] = ()) -> Check:
    """Row counts side by side per group; the failures are the summed differences."""

    def find(df: DataFrame) -> DataFrame:
        counts = _side_counts(df, other, [F.col(c) for c in group_by])
        return counts.withColumn("diff_count", F.abs(F.col("count_a") - F.col("count_b")))

    return Check("equal_rowcount", find, fail_calc="sum(diff_count)")


def fewer_rows_than(other: DataFrame, group_by: Sequence[str] = ()) -> Check:
    """The surplus where a group has more rows than in ``other``, 1 where as many."""

    def find(df: DataFrame) -> DataFrame:
        counts = _side_counts(df, other, [F.col(c) for c in group_by])
        surplus = F.col("count_a") - F.col("count_b")
        delta = F.when(surplus > 0, surplus).when(surplus == 0, 1).otherwise(0)
        return counts.withColumn("row_count_delta", delta)

    return Check("fewer_rows_than", find, fail_calc="sum(row_count_delta)")


def equality(other: DataFrame, columns: Sequence[str] | None = None, multiset: bool = False) -> Check:
    """Rows on one side only. ``multiset`` also reports rows that differ in their number of copies."""

    def find(df: DataFrame) -> DataFrame:
        compared = [F.col(f"`{c}`") for c in (columns or df.columns)]
        counts = _side_counts(df, other, compared)
        a, b = F.col("count_a"), F.col("count_b")
        side = F.when(a > b, "a_minus_b").otherwise("b_minus_a").alias("which_diff")
        if multiset:
            return counts.filter(a != b).select(side, *counts.columns)
        return counts.filter((a == 0) | (b == 0)).select(side, *counts.columns[:-2])

    surplus = "sum(case when which_diff = 'a_minus_b' then 1 else -1 end)"
    return Check("equality", find, fail_calc=f"count(*) + coalesce(abs({surplus}), 0)")


def cardinality_equality(column: str, to: DataFrame, field: str) -> Check:
    """Values whose number of rows differs; ``n_rows`` counts the (value, count) pairs in excess."""

    def find(df: DataFrame) -> DataFrame:
        value = F.col(column).alias("value_field")
        counts = _side_counts(df, to, [value], [F.col(field).alias("value_field")])
        a, b = F.col("count_a"), F.col("count_b")
        pairs = (a > 0).cast("int") + (b > 0).cast("int")
        return counts.filter(a != b).withColumn("n_rows", pairs)

    return Check(f"cardinality_equality_{column}", find, fail_calc="sum(n_rows)")
