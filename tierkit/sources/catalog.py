"""Finding tables by name, and uniting those that match."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tierkit.operators.reshape import union_tables

# Spark's table kinds -> the names reports use.
TABLE_KINDS = {"MANAGED": "table", "EXTERNAL": "external", "VIEW": "view", "TEMPORARY": "view"}


def _ilike(pattern: str) -> re.Pattern:
    parts = {"%": ".*", "_": "."}
    return re.compile("".join(parts.get(c, re.escape(c)) for c in pattern), re.IGNORECASE | re.DOTALL)


def relations_by_pattern(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = ""
) -> dict[str, str]:
    """Table name -> kind for every table whose schema and name match (ILIKE), in name order.

    Temporary views have no schema: they are named alone and match the schema pattern ``%``.
    """
    schema_like, table_like, hidden = _ilike(schema_pattern), _ilike(table_pattern), _ilike(exclude)
    kinds = {}
    for database in spark.catalog.listDatabases():
        if schema_like.fullmatch(database.name):
            # every database lists the temporary views as well; they are one set
            for t in spark.sql(f"SHOW TABLES IN `{database.name}`").collect():
                if table_like.fullmatch(t.tableName) and not hidden.fullmatch(t.tableName):
                    if not t.isTemporary:
                        name = f"{database.name}.{t.tableName}"
                        kinds[name] = spark.catalog.getTable(name).tableType
                    elif schema_pattern == "%":
                        kinds[t.tableName] = "TEMPORARY"
    kinds = dict(sorted(kinds.items()))
    return {name: TABLE_KINDS.get(kind, kind.lower()) for name, kind in kinds.items()}


def relations_by_prefix(spark: SparkSession, schema: str, prefix: str, exclude: str = "") -> dict[str, str]:
    return relations_by_pattern(spark, schema, f"{prefix}%", exclude)


def union_tables_matching(
    spark: SparkSession, schema_pattern: str, table_pattern: str, exclude: str = "", **options
) -> DataFrame:
    names = relations_by_pattern(spark, schema_pattern, table_pattern, exclude)
    return union_tables({n: spark.table(n) for n in names}, **options)
