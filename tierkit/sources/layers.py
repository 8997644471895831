"""Layers of a data platform: where tables lie, and how they move up."""

from __future__ import annotations

import contextlib
import time
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("bronze", "silver", "gold")


def bronze_path(root: str, database: str, schema: str, table: str) -> str:
    return f"{root}/bronze/{database}/{schema}/{table}"


def create_layers(spark: SparkSession, root: str, prefix: str = "") -> dict[str, str]:
    """One database per layer with its own location; returns layer -> database name."""
    names = {layer: f"{prefix}{layer}" for layer in LAYERS}
    for layer, name in names.items():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{root}/{layer}_tables'")
    return names


def write_layer(df: DataFrame, path: str, compression: str = "snappy") -> None:
    """Full refresh of one table directory; an empty table keeps its schema."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def scan_parquet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Open a directory by its footer schema, or by a pinned one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def external_table(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Name a Parquet directory, or move the name there; the schema comes from its footers."""
    _point(spark, table, path)
    return spark.table(table)


def _point(spark: SparkSession, table: str, folder: str) -> None:
    """Let ``table`` name ``folder``: one catalog change if the columns are those it has."""
    if spark.catalog.tableExists(table):
        if spark.table(table).schema == spark.read.parquet(folder).schema:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE TABLE {table} USING PARQUET LOCATION '{folder}'")


def materialize_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def table_location(spark: SparkSession, table: str) -> str | None:
    """Folder of a table, None when there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'")
    return described.first()["data_type"]


def materialize_table(df: DataFrame, table: str) -> DataFrame:
    """Write to a folder of its own, then point the table there.

    A model may so read its own previous version, a failed write leaves the table as it was
    and no folder behind, and nothing is renamed, which object stores do by copying. Earlier
    versions stay for those who still read them until ``clean_versions`` removes them. Tables are
    compressed with zstd, which halves the hexadecimal text of surrogate keys; snappy leaves it as it is.
    """
    spark = df.sparkSession
    folder = f"{_versions(spark, table)}{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    try:
        write_layer(df, folder, "zstd")
    except Exception:
        with contextlib.suppress(Exception):  # the reason of the failure is what counts
            delete_folder(spark, folder)
        raise
    _point(spark, table, folder)
    return spark.table(table)


def _versions(spark: SparkSession, table: str) -> str:
    database, _, name = table.rpartition(".")
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{home}/{name}__v_"


def clean_versions(spark: SparkSession, table: str, older_than: float = 86_400.0) -> list[str]:
    """Remove versions that a later one replaced ``older_than`` seconds ago; returns the folders removed.

    A separate step: run it when no query that began before is still reading.
    """
    prefix = _versions(spark, table)
    fs, parent = _file_system(spark, prefix.rpartition("/")[0])
    names = sorted(s.getPath().getName() for s in fs.listStatus(parent))
    own = [n for n in names if n.startswith(prefix.rpartition("/")[2])]
    now = time.time_ns()
    current = (table_location(spark, table) or "").rpartition("/")[2]
    gone = []
    for name, successor in zip(own, own[1:]):
        written = int(successor.rpartition("__v_")[2].partition("_")[0])
        if name != current and now - written >= older_than * 1e9:
            gone.append(f"{parent}/{name}")
            delete_folder(spark, gone[-1])
    return gone


def _file_system(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder of any file system that Spark knows. Spark offers no call of its own for
    this; it needs a classic session, like ``clean_versions``."""
    fs, path = _file_system(spark, folder)
    fs.delete(path, True)


def replace_table_as(source: DataFrame, table: str, where: str | None = None) -> DataFrame:
    """CREATE OR REPLACE ... AS SELECT, with an optional cleaning predicate."""
    return materialize_table(source if where is None else source.filter(where), table)


def promote_to_silver(
    spark: SparkSession,
    path: str,
    database: str,
    schema: str,
    table: str,
    clean: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Full refresh of ``<database>.silver_<schema>_<table>`` from a raw directory."""
    raw = scan_parquet(spark, path)
    name = f"{database}.silver_{schema.lower()}_{table.lower()}"
    return materialize_table(raw if clean is None else clean(raw), name)


def run_concurrently(
    work: Callable,
    items: Iterable[tuple],
    threads: int = 4,
    tries: int = 1,
    pause: float = 5.0,
) -> list:
    """``work(*item)`` for every item, a few Spark jobs at a time, with growing pauses between tries."""

    def attempt(item: tuple):
        for n in range(1, tries + 1):
            try:
                return work(*item)
            except Exception:
                if n == tries:
                    raise
                time.sleep(min(pause * n, 20.0))

    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(attempt, items))


def register_external(
    spark: SparkSession, root: str, source_database: str, tables: Iterable[tuple[str, str]], database: str
) -> dict[str, DataFrame]:
    """Name raw directories ``<database>.<schema>_<table>``, without copying them."""
    return {
        f"{schema}_{table}".lower(): external_table(
            spark, f"{database}.{schema}_{table}".lower(), bronze_path(root, source_database, schema, table)
        )
        for schema, table in tables
    }


def promote_many(
    spark: SparkSession,
    root: str,
    source_database: str,
    tables: Iterable[tuple[str, str]],
    database: str,
    threads: int = 4,
    tries: int = 3,
    pause: float = 5.0,
) -> dict[str, DataFrame]:
    """Promote a list of (schema, table); returns the silver tables by name."""
    tables = list(tables)

    def promote(schema: str, table: str) -> DataFrame:
        return promote_to_silver(spark, bronze_path(root, source_database, schema, table), database, schema, table)

    frames = run_concurrently(promote, tables, threads, tries, pause)
    return {f"silver_{s}_{t}".lower(): df for (s, t), df in zip(tables, frames)}
