"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target of words: its weight's share of the mix, but at most ``MOST_EPOCHS``
times its size; what a full source cannot take goes to the others by weight. Each source
also has a schedule, the rate at which its words are wanted at each moment u of the
training (0 to 1), here a straight line ``1 - tilt + 2 * tilt * u`` that favours the source
early or late. Its integral, the cumulative demand ``(1 - tilt) * u + tilt * u**2``, is inverted:
the documents of a source queue in a fixed random order, and the one that begins after c of
the target's words gets the position u at which the demand reaches c. Sorting the whole mix
by position gives the training order.

The queue of a source runs through its documents once and then begins again; a document
is taken, whole, when its middle comes before the target is met. So a source misses its
target by half a document at most, and no document comes more than ``MOST_EPOCHS`` times.

No source is ever gathered in one task: its queue is cut by hash into stretches of about
``STRETCH`` documents; only the sums of the stretches are accumulated per source, and documents
are ordered inside their stretch.

Defined results: null and empty texts have size 0, and are taken once if their place in the
queue comes up, which adds nothing; a null source is a source of its own and sorts last; a
null ``doc_id`` sorts first; rows equal in ``doc_id`` and text are queued as separate rows;
if all sizes are 0 every target is 0 and nothing is taken; an empty table gives no rows; other
columns, whatever their names, are handed through; only those named like a column that
``plan`` adds are replaced there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkit.llm.shared import hidden, shown, small_side

WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MOST_EPOCHS = 2
TILTS = (0.5, -0.5, 0.0)
STRETCH = 2_000


def words_in(text: str = "text") -> Column:
    """Number of runs of characters other than space and \\x09-\\x0D; 0 for null."""
    trimmed = F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.coalesce(trimmed, F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = SHARE_PERCENT) -> DataFrame:
    """``source, source_size, n_docs, place, target`` of every source of ``sizes(source, size)``.

    One row a source after the sum; sources fill up in the order of capacity per weight, so
    one pass over the sorted sources finds where the excess stops being reshared.
    """
    of_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.lit(list(weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    ranked = of_source.withColumn("place", place).withColumn("weight", weight)
    ranked = ranked.withColumn("cap", F.col("source_size") * MOST_EPOCHS)
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(0, Window.unboundedFollowing)
    asked = F.sum("source_size").over(everything) * percent / F.lit(100)
    level = (asked - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after)
    # the level at the first source that does not fill up holds for all from there on
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    first_open = F.min(F.when(fits, F.struct(F.col("cap") / F.col("weight"), "place", "level"))).over(everything)
    cap = F.col("cap").cast("double")
    return (
        ranked.withColumn("level", level)
        .withColumn("open_level", first_open["level"])
        .withColumn("target", F.coalesce(F.least(F.col("open_level") * F.col("weight"), cap), cap))
        .select("source", "source_size", "n_docs", "place", "target")
    )


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


ADDED = ("_size", "_source_size", "_target", "_copies", "_positions")


def plan(docs: DataFrame, tilts: Sequence[float] = TILTS) -> DataFrame:
    """All columns of ``docs`` with ``_size``, ``_source_size``, ``_target``, ``_copies`` and the
    ``_positions`` of the copies in the training order."""
    return _planned(docs, tilts).select(*shown(docs.columns, ADDED), *ADDED)


def _planned(docs: DataFrame, tilts: Sequence[float]) -> DataFrame:
    """The ``hidden`` columns of each document with ``doc_id`` and the added columns."""
    own = hidden(docs)
    sized = docs.select(*own, "doc_id", "source", words_in().alias("_size"), F.xxhash64("text").alias("_tie"))
    goal = small_side(targets(sized.select("source", F.col("_size").alias("size"))).select(
        F.col("source").alias("_of"), F.col("source_size").alias("_source_size"), "n_docs",
        F.col("place").alias("_place"), F.col("target").alias("_target"),
    ))
    # the fixed random order: the first half of an md5, as a number
    rank = F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")
    stretches = F.ceil(F.col("n_docs") / STRETCH)
    queued = (
        sized.withColumn("_rank", rank)
        .join(goal, _same("source", "_of"))
        .withColumn("_stretch", F.floor(F.col("_rank") / F.lit(16**15) * stretches))
    )
    sums = (
        queued.groupBy("_place", "_stretch")
        .agg(F.sum("_size").alias("_sum"))
        .withColumn(
            "_offset",
            F.sum("_sum").over(Window.partitionBy("_place").orderBy("_stretch")) - F.col("_sum"),
        )
        .select("_place", "_stretch", "_offset")
    )
    inside = Window.partitionBy("_place", "_stretch").orderBy("_rank", "doc_id", "_size", "_tie")
    begin = F.col("_offset") + F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_size")
    placed = queued.join(sums, ["_place", "_stretch"]).withColumn("_begin", begin)
    middle = F.col("_begin") + F.col("_size") / 2
    copies = sum(
        (F.when(middle + k * F.col("_source_size") < F.col("_target"), 1).otherwise(0) for k in range(MOST_EPOCHS)),
        F.lit(0),
    )
    tilt = F.element_at(F.lit([float(t) for t in tilts]), (F.pmod("_place", F.lit(len(tilts))) + 1).cast("int"))

    def position(epoch: Column) -> Column:
        done = (F.col("_begin") + epoch * F.col("_source_size")) / F.col("_target")
        root = F.sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * done)
        return F.when(tilt == 0, done).otherwise((root - (1 - tilt)) / (2 * F.when(tilt != 0, tilt)))

    epochs = F.slice(F.lit(list(range(MOST_EPOCHS))), 1, F.col("_copies"))
    placed = placed.withColumn("_copies", copies).withColumn("_positions", F.transform(epochs, position))
    return placed.select(*[f"own{i}" for i in range(len(own))], "doc_id", *ADDED)


def mixed(docs: DataFrame, tilts: Sequence[float] = TILTS) -> DataFrame:
    """The training sequence: every taken copy as a row of ``docs``, range-sorted by position."""
    copies = _planned(docs, tilts).withColumn("_position", F.explode("_positions"))
    return copies.orderBy("_position", "doc_id").select(*shown(docs.columns))
