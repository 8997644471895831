"""DataFrame operators: reshaping, series, profiling and neighbour comparison."""

from tierkit.operators.neighbours import compare_with_previous
from tierkit.operators.profile import (
    collect_values,
    column_values,
    filtered_columns,
    normalize_columns,
    result_arrays,
    single_value,
)
from tierkit.operators.proximity import nearest, within_distance
from tierkit.operators.reshape import (
    deduplicate,
    group_by_first,
    null_blanks,
    pivot,
    pivot_columns,
    star,
    union_tables,
    unpivot,
)
from tierkit.operators.series import date_bounds, date_spine, generate_series, intervals_between

__all__ = [
    "collect_values",
    "column_values",
    "compare_with_previous",
    "date_bounds",
    "date_spine",
    "deduplicate",
    "filtered_columns",
    "generate_series",
    "group_by_first",
    "intervals_between",
    "nearest",
    "normalize_columns",
    "null_blanks",
    "pivot",
    "pivot_columns",
    "result_arrays",
    "single_value",
    "star",
    "union_tables",
    "unpivot",
    "within_distance",
]
