"""Types that raw Parquet should not carry become text; NULL stays NULL.

The decision looks at types only, so every partition of a table agrees on the outcome.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DECIMAL_TARGETS = {"string": "string", "double": "double", "keep": None}


def coerce_bronze(df: DataFrame, decimals: str = "string") -> DataFrame:
    """Binary to base64, decimals per ``decimals`` (text keeps the scale), nested to JSON."""
    if decimals not in DECIMAL_TARGETS:
        raise ValueError(f"decimals must be one of {list(DECIMAL_TARGETS)}, got {decimals!r}")
    decimal_target = DECIMAL_TARGETS[decimals]

    def cell(field: T.StructField) -> Column:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.BinaryType):
            col = F.base64(col)
        elif isinstance(kind, T.DecimalType) and decimal_target:
            col = col.cast(decimal_target)
        elif isinstance(kind, T.NullType):
            col = col.cast("string")
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            col = F.to_json(col)
        return col.alias(field.name)

    return df.select(*map(cell, df.schema))
