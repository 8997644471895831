"""Reading a relational database in parallel and landing it as raw Parquet."""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tierkit.sources.coerce import coerce_bronze
from tierkit.sources.layers import bronze_path, run_concurrently, write_layer

# Schemas that hold the server's own tables.
SYSTEM_SCHEMAS = ("sys", "INFORMATION_SCHEMA")

# Column types a table can be cut by into ranges.
RANGE_TYPES = (
    *("tinyint", "smallint", "int", "integer", "bigint", "decimal", "numeric"),
    *("date", "datetime", "datetime2", "smalldatetime", "timestamp"),
)


@dataclass(frozen=True)
class Dialect:
    """How a database quotes names, and the remainder of a column's hash by ``{n}``."""

    open: str
    close: str
    remainder: str

    def quote(self, name: str) -> str:
        return f"{self.open}{name.replace(self.close, self.close * 2)}{self.close}"


DIALECTS = {
    "sqlserver": Dialect("[", "]", "ABS(CAST(CHECKSUM({column}) AS BIGINT)) % {n}"),
    "mysql": Dialect("`", "`", "CRC32({column}) % {n}"),
    "mariadb": Dialect("`", "`", "CRC32({column}) % {n}"),
    "postgresql": Dialect('"', '"', "ABS(CAST(HASHTEXT(CAST({column} AS TEXT)) AS BIGINT)) % {n}"),
    "oracle": Dialect('"', '"', "ORA_HASH({column}, {n} - 1)"),
}
STANDARD = Dialect('"', '"', "")


@dataclass(frozen=True)
class JdbcSource:
    """Where to read from. Credentials come from the Spark configuration, never from code."""

    url: str
    database: str
    driver: str | None = None
    fetch_size: int = 100_000
    conf_prefix: str = "spark.tierkit.jdbc"
    extra: dict[str, str] = field(default_factory=dict)

    @property
    def dialect(self) -> Dialect:
        return DIALECTS.get(self.url.removeprefix("jdbc:").partition(":")[0], STANDARD)

    def options(self, spark: SparkSession) -> dict[str, str]:
        options = {"url": self.url, "fetchsize": str(self.fetch_size), **self.extra}
        if self.driver:
            options["driver"] = self.driver
        for key in ("user", "password"):
            value = spark.conf.get(f"{self.conf_prefix}.{key}", None)
            if value is not None:
                options[key] = value
        return options

    def table(self, schema: str, name: str) -> str:
        return f"{self.dialect.quote(schema)}.{self.dialect.quote(name)}"


@dataclass(frozen=True)
class Split:
    """How to cut one table into parallel reads: by equally wide ranges of a column between its
    bounds, by the ranges that begin at ``starts``, or, without either, by the hash of a column."""

    column: str
    lower: object
    upper: object
    partitions: int
    starts: tuple = ()

    def options(self, dialect: Dialect = STANDARD) -> dict[str, str]:
        return {
            "partitionColumn": dialect.quote(self.column),
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.partitions),
        }

    def predicates(self, dialect: Dialect) -> list[str]:
        """One condition a partition; together they take every row once, those with NULL first."""
        column = dialect.quote(self.column)
        if self.starts:
            marks = [literal(s) for s in self.starts]
            ranges = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(marks, marks[1:])]
            # rows that came after the question, below the first start, belong to the first part
            below = f"{column} < {marks[0]} OR {column} IS NULL"
            return [f"({below} OR {ranges[0]})" if ranges else "1 = 1", *ranges[1:], *([f"{column} >= {marks[-1]}"] if ranges else [])]
        share = dialect.remainder.format(column=column, n=self.partitions)
        first = f"({share} = 0 OR {column} IS NULL)"
        return [first, *(f"{share} = {k}" for k in range(1, self.partitions))]


def table_list_query(exclude_schemas: Sequence[str] = SYSTEM_SCHEMAS) -> str:
    """SQL that lists the base tables of a database, system schemas left out."""
    hidden = ", ".join(f"'{s}'" for s in exclude_schemas)
    return (
        "SELECT TABLE_SCHEMA, TABLE_NAME FROM INFORMATION_SCHEMA.TABLES "
        f"WHERE TABLE_TYPE = 'BASE TABLE' AND TABLE_SCHEMA NOT IN ({hidden})"
    )


def split_column_query() -> str:
    """SQL that lists the columns a table may be cut by, with their type: the first of its
    primary key, and its first column for tables without one."""
    return (
        "SELECT c.TABLE_SCHEMA, c.TABLE_NAME, c.COLUMN_NAME, c.DATA_TYPE, "
        "CASE WHEN k.COLUMN_NAME IS NULL THEN 0 ELSE 1 END AS IS_KEY FROM INFORMATION_SCHEMA.COLUMNS c "
        "LEFT JOIN (SELECT u.TABLE_SCHEMA, u.TABLE_NAME, u.COLUMN_NAME FROM INFORMATION_SCHEMA.TABLE_CONSTRAINTS t "
        "JOIN INFORMATION_SCHEMA.KEY_COLUMN_USAGE u "
        "ON u.CONSTRAINT_SCHEMA = t.CONSTRAINT_SCHEMA AND u.CONSTRAINT_NAME = t.CONSTRAINT_NAME "
        "WHERE t.CONSTRAINT_TYPE = 'PRIMARY KEY' AND u.ORDINAL_POSITION = 1) k "
        "ON k.TABLE_SCHEMA = c.TABLE_SCHEMA AND k.TABLE_NAME = c.TABLE_NAME AND k.COLUMN_NAME = c.COLUMN_NAME "
        "WHERE k.COLUMN_NAME IS NOT NULL OR c.ORDINAL_POSITION = 1"
    )


def bounds_query(source: JdbcSource, schema: str, table: str, column: str) -> str:
    name = source.dialect.quote(column)
    return f"SELECT MIN({name}) AS lower_bound, MAX({name}) AS upper_bound FROM {source.table(schema, table)}"


def literal(value: object) -> str:
    """A value that the database gave, as SQL text."""
    if isinstance(value, datetime.datetime):
        return f"'{value.isoformat(sep=' ')}'"
    if isinstance(value, datetime.date):
        return f"'{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return str(value)


def starts_query(source: JdbcSource, schema: str, table: str, column: str, partitions: int) -> str:
    """SQL for the least value of each of ``partitions`` equal shares of the rows, in order."""
    name = source.dialect.quote(column)
    return (
        f"SELECT share, MIN({name}) AS start_value FROM (SELECT {name}, NTILE({partitions}) OVER (ORDER BY {name}) AS share "
        f"FROM {source.table(schema, table)} WHERE {name} IS NOT NULL) s GROUP BY share"
    )


def balanced(column: str, starts: Sequence[object]) -> Split | None:
    """A cut into ranges of about equal numbers of rows from the starts of equal shares; a value that
    begins several shares has one range of its own and what follows it. None without starts."""
    distinct = sorted({s for s in starts if s is not None})
    return Split(column, None, None, len(distinct), tuple(distinct)) if distinct else None


def read_options(
    source: JdbcSource, spark: SparkSession, schema: str, table: str, split: Split | None
) -> dict[str, str]:
    options = {**source.options(spark), "dbtable": source.table(schema, table)}
    return options if split is None or split.lower is None else {**options, **split.options(source.dialect)}


def choose_column(columns: Sequence[tuple[str, str, int]]) -> tuple[str, bool] | None:
    """The column to cut a table by, and whether by ranges, from ``name, type, is key``; the key first."""
    if not columns:
        return None
    name, kind, _ = max(columns, key=lambda c: c[2])
    return name, kind.lower() in RANGE_TYPES


def list_tables(spark: SparkSession, source: JdbcSource) -> DataFrame:
    return spark.read.format("jdbc").options(**source.options(spark), query=table_list_query()).load()


def list_split_columns(spark: SparkSession, source: JdbcSource) -> DataFrame:
    return spark.read.format("jdbc").options(**source.options(spark), query=split_column_query()).load()


def find_split(
    spark: SparkSession, source: JdbcSource, schema: str, table: str, column: str, ranges: bool, partitions: int
) -> Split | None:
    """Bounds of the column, asked of the database, or a cut by its hash; None for an empty table,
    and where the dialect has no hash."""
    if not ranges:
        return Split(column, None, None, partitions) if source.dialect.remainder else None
    reader = spark.read.format("jdbc").options(**source.options(spark), query=bounds_query(source, schema, table, column))
    low, high = reader.load().first()
    return None if low is None else Split(column, low, high, partitions)


def find_balanced_split(
    spark: SparkSession, source: JdbcSource, schema: str, table: str, column: str, ranges: bool, partitions: int
) -> Split | None:
    """Like ``find_split`` with ranges of equal numbers of rows, for which the database sorts the column once."""
    if not ranges:
        return find_split(spark, source, schema, table, column, ranges, partitions)
    query = starts_query(source, schema, table, column, partitions)
    rows = spark.read.format("jdbc").options(**source.options(spark), query=query).load().collect()
    return balanced(column, [r["start_value"] for r in rows])


def read_table(
    spark: SparkSession, source: JdbcSource, schema: str, table: str, split: Split | None = None
) -> DataFrame:
    options = read_options(source, spark, schema, table, split)
    if split is not None and split.lower is None:
        name = options.pop("dbtable")
        return spark.read.jdbc(options.pop("url"), name, predicates=split.predicates(source.dialect), properties=options)
    return spark.read.format("jdbc").options(**options).load()


def extract_database(
    spark: SparkSession,
    source: JdbcSource,
    root: str,
    split_columns: dict[str, str] | None = None,
    partitions: int | None = None,
    threads: int = 4,
    by_rows: bool = False,
) -> list[tuple[str, str]]:
    """Land every base table under ``root``; rows stream from database to Parquet on executors.

    A table is read in parallel by ranges of its leading key column, or of the one that
    ``split_columns`` names for ``schema.table``; by the hash of a column of another type. By default
    there are as many parts as the session has cores. Ranges are equally wide, or with ``by_rows``
    hold equal numbers of rows, which keys with gaps need. Returns the (schema, table) pairs written.
    """
    partitions = partitions or spark.sparkContext.defaultParallelism
    listed: dict[str, list[tuple[str, str, int]]] = {}
    for s, t, column, kind, is_key in list_split_columns(spark, source).collect():
        listed.setdefault(f"{s}.{t}", []).append((column, kind, is_key))
    columns = {name: choose_column(found) for name, found in listed.items()}
    columns |= {name: (column, True) for name, column in (split_columns or {}).items()}

    def land(schema: str, table: str) -> None:
        chosen = columns.get(f"{schema}.{table}")
        find = find_balanced_split if by_rows else find_split
        split = find(spark, source, schema, table, *chosen, partitions) if chosen else None
        rows = coerce_bronze(read_table(spark, source, schema, table, split))
        write_layer(rows, bronze_path(root, source.database, schema, table))

    tables = sorted(map(tuple, list_tables(spark, source).collect()))
    run_concurrently(land, tables, threads)
    return tables


def sample_table(df: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` rows, in no particular order, coerced like a full extract."""
    return coerce_bronze(df.limit(n))
