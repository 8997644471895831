"""Intermediate tables in the folder that the cluster shares, folds, and components of links."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierkit.functions._columns import quoted
from tierkit.session import shared_dir
from tierkit.sources.layers import delete_folder

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_work: ContextVar[str | None] = ContextVar("work", default=None)


@contextlib.contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries that run inside go when their query ends. Otherwise they stay until
    the driver collects its garbage, so a chain of steps holds the files of all of them."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """``df`` written to the shared folder and read back: later steps don't compute it again,
    and neither lost executors nor a long lineage can undo it."""
    spark = df.sparkSession
    path = f"{_work.get() or _tables(spark)}/{name}-{uuid.uuid4().hex}"
    with released(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few_files(df: DataFrame) -> DataFrame:
    """``df`` in a partition for six shuffle partitions, at least one a core, to be ``stored``: each file costs
    its task calls of the file system, and processes where that is a local one without Hadoop's library."""
    spark = df.sparkSession
    return df.coalesce(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 6))


def _tables(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/tierkit-llm"


@contextlib.contextmanager
def temporary(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """Tables ``stored`` inside are removed at the end of the block; gives a ``stored`` for those that
    stay, as tables of the block around it if there is one. What reads the others must have run by then."""
    around = _work.get()
    folder = f"{around or _tables(spark)}/work-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str = "step") -> DataFrame:
        token = _work.set(around)
        try:
            return stored(df, name)
        finally:
            _work.reset(token)

    token = _work.set(folder)
    try:
        yield kept
    finally:
        _work.reset(token)
        delete_folder(spark, folder)


def hidden(df: DataFrame) -> list[Column]:
    """The columns of ``df`` under names that no operator uses inside."""
    return [F.col(quoted(c)).alias(f"own{i}") for i, c in enumerate(df.columns)]


def shown(columns: list[str], added: Iterable[str] = ()) -> list[Column]:
    """The ``hidden`` columns under their own names, less those that ``added`` ones of the same name replace."""
    taken = {a.lower() for a in added}
    return [F.col(f"own{i}").alias(c) for i, c in enumerate(columns) if c.lower() not in taken]


def held_out(parts: int, doc_id: str = "doc_id") -> Column:
    """Whether crc32 of the ``doc_id`` as text leaves 2 by ``parts``."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts == 2


def small_side(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """``df`` stored, and marked for broadcast when it is no longer than ``most_rows``; a longer
    one is left to a shuffled join."""
    df = stored(df, "side")
    return F.broadcast(df) if df.limit(most_rows + 1).count() <= most_rows else df


def least_hashed(marked: DataFrame, most: int, seed: int) -> list:
    """Up to ``most`` distinct texts of each ``kind`` above 0 of ``marked(kind, text)``, those of
    least hash, as rows in the order of kind and hash.

    The kinds are counted first, so only about eight times as many rows pass the filter on the
    hash, whatever the size of the table; copies are folded before they are shuffled.
    """
    marked = marked.filter("kind > 0")
    chance = F.lit(0.0)
    for row in marked.groupBy("kind").agg(F.count("*").alias("n")).collect():
        chance = F.when(F.col("kind") == row["kind"], F.lit(8.0 * most / row["n"])).otherwise(chance)
    number = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1 << 40))
    few = marked.filter(number < chance * (1 << 40)).distinct()
    place = F.row_number().over(Window.partitionBy("kind").orderBy(number, "text"))
    few = few.withColumn("place", place).filter(F.col("place") <= most)
    return few.orderBy("kind", "place").select("kind", "text").collect()


def stars(links: DataFrame) -> DataFrame:
    """``a``, ``b`` (the least node reachable) for every end of ``links(a, b)`` but the least ones.

    Alternates large-star and small-star steps, each a minimum per node (partial before the
    shuffle) and a join that adaptive execution splits at hot nodes; the links shrink to
    stars around the least nodes. No group of neighbours is ever collected.
    """
    links = links.filter("a <> b").select("a", "b")
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up"))))
    while True:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").filter("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
            .select("x.a", "x.b")
            .filter("a <> b")
            .distinct()
        )
        links = stored(few_files(small), "links")
        # stars around the least nodes: every other node has one link up, and none down
        nodes = links.select(ends.alias("end")).select("end.*").groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("low"))
        with released(links.sparkSession):
            if nodes.filter("up > 1 OR up = 1 AND low = 0").isEmpty():
                break
    return links
