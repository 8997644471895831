"""Checks that look at one row at a time: all of them fuse into one scan per table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkit.checks.core import Check, Keyed, row_check


def not_null(column: str) -> Check:
    return row_check(f"not_null_{column}", F.col(column).isNull())


def expression_is_true(expression: Column | str, name: str = "expression_is_true") -> Check:
    """A whole predicate, as SQL text or Column; an unknown (NULL) result passes."""
    predicate = F.expr(expression) if isinstance(expression, str) else expression
    return row_check(name, ~predicate)


def not_empty_string(column: str, trim_whitespace: bool = True) -> Check:
    """Only spaces are trimmed, so a lone tab is not empty."""
    text = F.trim(F.col(column)) if trim_whitespace else F.col(column)
    return row_check(f"not_empty_string_{column}", text == "")


def accepted_range(column: str, min_value=None, max_value=None, inclusive: bool = True) -> Check:
    if min_value is None and max_value is None:
        raise ValueError("give min_value, max_value or both")
    col, bad = F.col(column), F.lit(False)
    if min_value is not None:
        bad = bad | (col < min_value if inclusive else col <= min_value)
    if max_value is not None:
        bad = bad | (col > max_value if inclusive else col >= max_value)
    return row_check(f"accepted_range_{column}", bad)


def assert_equal(actual: str, expected: str) -> Check:
    """Null-safe: NULL against a value is a difference, NULL against NULL is not."""
    return row_check(f"assert_equal_{actual}", ~F.col(actual).eqNullSafe(F.col(expected)))


def _value_check(name: str, column: str, bad: Column, tally: Column | None) -> Check:
    def find(df: DataFrame) -> DataFrame:
        return df.filter(bad).groupBy(F.col(column).alias("value_field")).agg(F.count("*").alias("n_records"))

    keyed = Keyed([column], condition=bad, distinct=True) if tally is None else None
    return Check(name, find, tally=tally, keyed=keyed)


def accepted_values(column: str, values: Sequence) -> Check:
    """Distinct values outside the list; NULL passes."""
    return _value_check(f"accepted_values_{column}", column, ~F.col(column).isin(list(values)), None)


def not_accepted_values(column: str, values: Sequence) -> Check:
    """Distinct values on the forbidden list (so never more than the list is long)."""
    bad = F.col(column).isin(list(values))
    tally = F.size(F.collect_set(F.when(bad, F.col(column))))
    return _value_check(f"not_accepted_values_{column}", column, bad, tally)
