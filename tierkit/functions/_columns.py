from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column's name as an expression that takes it whole, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def as_column(value) -> Column:
    """A string names a column, a Column stays, anything else becomes a literal."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)
