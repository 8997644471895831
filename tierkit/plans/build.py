"""The daily run: land, promote, build the models, check them, stop on an error."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tierkit.checks import Check, gate, run_checks
from tierkit.sources.extract import JdbcSource, extract_database
from tierkit.sources.layers import create_layers, materialize_table, promote_many, run_concurrently

Model = Callable[[Mapping[str, DataFrame]], DataFrame]


def build_models(
    inputs: Mapping[str, DataFrame],
    models: Mapping[str, Model],
    database: str | None = None,
    threads: int = 4,
) -> dict[str, DataFrame]:
    """Every model as a DataFrame; with a database they are written there, ``threads`` at a time."""
    frames = {name: model(inputs) for name, model in models.items()}
    if database is None:
        return frames
    writes = [(df, f"{database}.{name}") for name, df in frames.items()]
    return dict(zip(frames, run_concurrently(materialize_table, writes, threads)))


def run_daily(
    spark: SparkSession,
    root: str,
    source_database: str,
    tables: Sequence[tuple[str, str]],
    models: Mapping[str, Model],
    checks: Callable[[Mapping[str, DataFrame]], list[tuple[DataFrame, Check]]],
    prefix: str = "",
    source: JdbcSource | None = None,
) -> list:
    """Raw to silver to gold to checks; returns the check results or raises ``ChecksFailed``.

    With a ``source`` its tables are landed first; without one the raw files are there already.
    """
    layers = create_layers(spark, root, prefix)
    if source is not None:
        extract_database(spark, source, root)
    silver = promote_many(spark, root, source_database, tables, layers["silver"])
    gold = build_models(silver, models, layers["gold"])
    return gate(run_checks(checks(gold)))
