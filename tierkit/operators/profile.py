"""Looking at values and columns without pulling a table to the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierkit.functions._columns import quoted
from tierkit.functions.text import slugify


def column_values(
    df: DataFrame,
    column: str,
    order_by: Sequence[Column] | None = None,
    max_records: int | None = None,
    where: Column | str | None = None,
) -> DataFrame:
    """Distinct values with their count ``n_rows``, most frequent first, ties by value."""
    value = F.col(quoted(column)).alias(column)
    counts = (df if where is None else df.filter(where)).groupBy(value).agg(F.count("*").alias("n_rows"))
    ordered = counts.orderBy(*(order_by or [F.desc("n_rows"), F.asc_nulls_last(quoted(column))]))
    return ordered if max_records is None else ordered.limit(max_records)


def collect_values(
    spark: SparkSession,
    source: DataFrame | str,
    column: str,
    max_records: int | None = None,
    default: list | None = None,
    bound: int = 10_000,
    **options,
) -> list:
    """All values as a list, for a pivot header, or the top ``max_records``; ``source`` may name a table.

    More than ``bound`` values raise: nothing is cut, and one value more than the bound is read
    to find out.
    """
    if isinstance(source, str):
        if not spark.catalog.tableExists(source):
            if default is None:
                raise ValueError(f"table {source} does not exist and no default is given")
            return default
        source = spark.table(source)
    values = column_values(source, column, max_records=max_records, **options).select(F.col(quoted(column)))
    rows = values.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{column} has more than {bound} values")
    return [r[0] for r in rows] or (default or [])


def filtered_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    dropped = {c.lower() for c in exclude}
    return [c for c in df.columns if c.lower() not in dropped]


def single_value(df: DataFrame, default=None) -> Column:
    """First row's first column of a query as a scalar subquery, usable in any expression.

    Order the query if it has more rows than one; without a row the default stands in.
    """
    first = df.select(F.col(f"`{df.columns[0]}`").alias("value")).limit(1)
    if default is None:
        return first.scalar()
    found = F.when(F.count("*") == 0, F.lit(default)).otherwise(F.first("value"))
    return first.agg(found.alias("value")).scalar()


def result_arrays(df: DataFrame, order_by: Sequence[str], max_rows: int = 10_000) -> DataFrame:
    """A small result as one row holding one array per column, all in the same order.

    A result beyond ``max_rows`` raises, it is never cut: one row more than the bound is
    read to find out.
    """
    rest = [c for c in df.columns if c not in set(order_by)]
    rows = F.sort_array(F.collect_list(F.struct(*order_by, *rest)))
    one = df.limit(max_rows + 1).agg(rows.alias("_rows"))
    error = F.raise_error(F.lit(f"result has more than {max_rows} rows"))
    checked = one.select(F.when(F.size("_rows") > max_rows, error).otherwise(F.col("_rows")).alias("_rows"))
    return checked.select(*[F.col(f"_rows.{c}").alias(c) for c in df.columns])


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its slug; two columns with one slug are an error."""
    slugs = [slugify(c) for c in df.columns]
    if len(set(slugs)) < len(slugs):
        raise ValueError(f"column names collide after clean-up: {slugs}")
    return df.toDF(*slugs)
