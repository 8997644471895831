"""Checks on the schema alone; no data is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tierkit.checks.core import Check


def columns_match_set(expected: Sequence[str], transform=str.upper) -> Check:
    """Column names missing from, or not on, the list, compared in one letter case."""
    wanted = {transform(c) for c in expected}

    def find(df: DataFrame) -> DataFrame:
        present = {transform(c) for c in df.columns}
        rows = [(c, "missing") for c in sorted(wanted - present)] + [(c, "extra") for c in sorted(present - wanted)]
        return df.sparkSession.createDataFrame(rows, "column_name string, problem string")

    return Check("columns_match_set", find)
