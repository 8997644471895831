"""Small reference tables kept as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and declared types; an empty cell is NULL, a malformed one an error."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )
