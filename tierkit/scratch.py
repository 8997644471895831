"""Intermediate tables that later steps read again, and their removal."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from tierkit.session import shared_dir
from tierkit.sources.layers import delete_folder


class Scratch:
    """A folder of its own in the shared work folder, removed by ``remove``, at the end of a ``with``
    block, or when the process ends.

    A stored table is computed once, and neither a lost executor nor a long lineage undoes it. What
    still reads the tables must have run before they are removed.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
        self._tables = 0
        atexit.register(self._forget)

    def store(self, df: DataFrame) -> DataFrame:
        self._tables += 1
        path = f"{self.folder}/{self._tables}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        atexit.unregister(self._forget)
        delete_folder(self.spark, self.folder)

    def _forget(self) -> None:
        if SparkSession.getActiveSession() is not None:
            with contextlib.suppress(Exception):  # the session may have ended meanwhile
                delete_folder(self.spark, self.folder)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.remove()
