"""Reshaping: union of unlike tables, melt, pivot, dedup, column lists."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierkit.functions._columns import quoted
from tierkit.functions.text import blank_to_null, slugify


def _lowered(names: Iterable[str]) -> set[str]:
    return {n.lower() for n in names}


def union_tables(
    tables: Mapping[str, DataFrame],
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    type_overrides: Mapping[str, str] | None = None,
    source_column: str | None = "_source_relation",
    where: Column | str | None = None,
) -> DataFrame:
    """UNION ALL over the superset of the tables' columns, in first-seen order.

    A missing column is a typed NULL, a column's type is that of the first table having
    it, and ``where`` runs inside every branch, before the projection.
    """
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    if not tables:
        raise ValueError("no tables to union")
    included, excluded = _lowered(include), _lowered(exclude)
    overrides = {k.lower(): v for k, v in (type_overrides or {}).items()}

    wanted: dict[str, T.StructField] = {}
    for df in tables.values():
        for field in df.schema:
            key = field.name.lower()
            if key not in excluded and (not included or key in included):
                wanted.setdefault(key, field)
    if not wanted:
        raise ValueError(f"no columns left to union for {list(tables)}")

    branches = []
    for name, df in tables.items():
        present = _lowered(df.columns)
        source = [F.lit(name).alias(source_column)] if source_column else []
        cells = [
            (F.col(f.name) if key in present else F.lit(None))
            .cast(overrides.get(key, f.dataType))
            .alias(f.name)
            for key, f in wanted.items()
        ]
        branches.append((df if where is None else df.filter(where)).select(*source, *cells))
    return reduce(DataFrame.union, branches)


def unpivot(
    df: DataFrame,
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    cast_to: str = "string",
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Columns to (field, value) rows in one scan; ``exclude`` is kept as is, ``remove`` dropped."""
    kept, dropped = _lowered(exclude), _lowered(remove)
    ids = [c for c in df.columns if c.lower() in kept]
    melted = [f for f in df.schema if f.name.lower() not in kept | dropped]
    if not melted:
        raise ValueError("no column left to unpivot")

    def cell(field: T.StructField) -> Column:
        col = F.col(quoted(field.name))
        if isinstance(field.dataType, T.BooleanType):
            col = col.cast("string")
        return col.cast(cast_to).alias(field.name)

    ids = [quoted(c) for c in ids]
    cells = [quoted(f.name) for f in melted]
    return df.select(*ids, *map(cell, melted)).unpivot(ids, cells, field_name, value_name)


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column | str]) -> DataFrame:
    """The first row per key. Spell out a total order, or equal rows are picked at random.

    The ``== 1`` filter turns into a per-task group limit before the shuffle, so even a key
    with a third of all rows sends at most one row per task.
    """
    order = [F.asc_nulls_last(o) if isinstance(o, str) else o for o in order_by]
    rank = F.row_number().over(Window.partitionBy(*partition_by).orderBy(*order))
    name = "_rank"
    while name in (c.lower() for c in df.columns):  # a column of the table's own
        name += "_"
    return df.withColumn(name, rank).filter(F.col(name) == 1).drop(name)


COMPARISONS: dict[str, Callable[[Column, Column], Column]] = {
    "=": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "<=>": lambda column, value: column.eqNullSafe(value),
    "is distinct from": lambda column, value: ~column.eqNullSafe(value),
    "like": lambda column, value: F.like(column, value),
    "not like": lambda column, value: ~F.like(column, value),
    "ilike": lambda column, value: F.ilike(column, value),
    "rlike": lambda column, value: F.rlike(column, value),
}


def _avg_distinct(column: Column) -> Column:
    return F.sum_distinct(column) / F.count_distinct(column)


DISTINCT_FORMS = {F.sum: F.sum_distinct, F.count: F.count_distinct, F.avg: _avg_distinct, F.mean: _avg_distinct}


def pivot_columns(
    column: str,
    values: Sequence,
    agg: Callable[[Column], Column] = F.sum,
    cmp: str | Callable[[Column, Column], Column] = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    distinct: bool = False,
    slug_names: bool = False,
    alias: bool = True,
) -> list[Column]:
    """One aggregate per listed value, to put into any ``groupBy().agg()``.

    ``cmp`` is an operator by its SQL name, or a function of column and value. ``distinct``
    aggregates distinct cells: ``F.sum`` and ``F.count`` have a distinct form, the smallest and the
    largest value need none, any other aggregate is given its distinct form as ``agg`` itself.
    """
    compare = cmp if callable(cmp) else COMPARISONS[cmp.lower()]
    if distinct:
        agg = DISTINCT_FORMS.get(agg, agg)

    def cell(value) -> Column:
        hit = compare(F.col(column), F.lit(value))
        out = agg(F.when(hit, then_value).otherwise(else_value))
        name = f"{prefix}{value}{suffix}"
        return out.alias(slugify(name) if slug_names else name) if alias else out

    return [cell(v) for v in values]


def pivot(df: DataFrame, group_by: Sequence[str], column: str, values: Sequence, **options) -> DataFrame:
    """Listed values to columns: one hash aggregate, no discovery pass over the data."""
    return df.groupBy(*group_by).agg(*pivot_columns(column, values, **options))


def star(
    df: DataFrame,
    exclude: Sequence[str] = (),
    prefix: str = "",
    suffix: str = "",
    relation_alias: str | None = None,
) -> list[Column]:
    """Every column but the excluded ones, renamed with the prefix and suffix."""
    dropped = _lowered(exclude)
    qualifier = f"{relation_alias}." if relation_alias else ""
    return [
        F.col(f"{qualifier}`{c}`").alias(f"{prefix}{c}{suffix}")
        for c in df.columns
        if c.lower() not in dropped
    ]


def null_blanks(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Empty strings to NULL in the given columns, by default in every string column."""
    if columns is None:
        columns = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    wanted = set(columns)
    cell = lambda c: blank_to_null(F.col(quoted(c))).alias(c) if c in wanted else F.col(quoted(c))
    return df.select(*map(cell, df.columns))


def group_by_first(df: DataFrame, n: int) -> GroupedData:
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n])
