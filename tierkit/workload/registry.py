"""Named queries over the test tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

import atexit
import contextlib
import itertools
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from tierkit.functions.keys import NULL_MARK
from tierkit.session import shared_dir
from tierkit.sources.layers import LAYERS, delete_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables(Mapping):
    """Parquet tables of one folder by name."""

    NAMES = tuple(
        "region nation customer supplier part orders lineitem events documents embeddings pages "
        "benchmark labels conversations".split()
    )

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __iter__(self):
        return iter(self.NAMES)

    def __len__(self):
        return len(self.NAMES)


def dates_as_text(df: DataFrame) -> DataFrame:
    """Dates as text, for the reports whose SQL writes them so."""
    dates = [f.name for f in df.schema if isinstance(f.dataType, DateType)]
    return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df


def query(name: str, sql: str):
    """Register ``fn(tables)`` under a name with its SQL twin; both sides have the same types."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        ORACLES[name] = sql
        return fn

    return register


_TAG = f"run_{uuid.uuid4().hex[:12]}_"
_CALLS = itertools.count()


def fresh_root(tables: Tables) -> tuple[str, str]:
    """A folder of this call's own, and the name prefix of this process's databases.

    All lie under one folder, which is removed with the databases when the process ends.
    """
    work = f"{shared_dir(tables.spark)}/{_TAG}work"
    call = next(_CALLS)
    if call == 0:
        atexit.register(_drop_work, work)
    return f"{work}/{call}", _TAG


def _drop_work(work: str) -> None:
    spark = SparkSession.getActiveSession()
    with contextlib.suppress(Exception):  # the session may have ended; then its databases have, too
        for layer in LAYERS:
            spark.sql(f"DROP DATABASE IF EXISTS `{_TAG}{layer}` CASCADE")
        delete_folder(spark, work)


def key_sql(*fields: str) -> str:
    """SQL text of a surrogate key."""
    texts = ", ".join(f"coalesce(cast({f} AS VARCHAR), '{NULL_MARK}')" for f in fields)
    return f"md5(concat_ws('-', {texts}))"
