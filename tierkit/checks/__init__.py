"""Data-quality checks: each finds violating rows, many run together as one Spark job."""

from tierkit.checks.compare import cardinality_equality, equal_rowcount, equality, fewer_rows_than
from tierkit.checks.core import Check, ChecksFailed, gate, row_check, run_checks, store_failures
from tierkit.checks.groups import (
    at_least_one,
    not_constant,
    not_null_proportion,
    recency,
    relationships,
    unique,
    unique_combination,
)
from tierkit.checks.ordered import mutually_exclusive_ranges, sequential_values
from tierkit.checks.rows import (
    accepted_range,
    accepted_values,
    assert_equal,
    expression_is_true,
    not_accepted_values,
    not_empty_string,
    not_null,
)
from tierkit.checks.schema import columns_match_set

__all__ = [
    "Check",
    "ChecksFailed",
    "accepted_range",
    "accepted_values",
    "assert_equal",
    "at_least_one",
    "cardinality_equality",
    "columns_match_set",
    "equal_rowcount",
    "equality",
    "expression_is_true",
    "fewer_rows_than",
    "gate",
    "mutually_exclusive_ranges",
    "not_accepted_values",
    "not_constant",
    "not_empty_string",
    "not_null",
    "not_null_proportion",
    "recency",
    "relationships",
    "row_check",
    "run_checks",
    "sequential_values",
    "store_failures",
    "unique",
    "unique_combination",
]
