"""Sharding by sampled splitters: shards of nearly equal bytes over a range of keys.

The key of a record is a hash of its text, so equal texts are neighbours in key order. Keys are
drawn with a chance in proportion to their record's size; quantiles of the sample are the
splitters of fine ranges, ``RANGES`` to a shard or more. The exact bytes of every range are then
counted. A range with more than ``OVERFULL`` times the mean, which is the mark of a large group
of equal texts, is subdivided by a hash of ``doc_id``. Consecutive pieces fill the shards by
cumulative bytes.

Everything is DataFrame functions. What reaches the driver are the splitters and nothing
else: their number follows the row count so that a piece keeps about ``PIECE_ROWS`` rows,
8 bytes each; a place in a shard is numbered piece by piece, so no task holds a shard.

Defined results: a null text has size 8, checksum 0, and the key of the empty text; a null
``doc_id`` is hashed like a value; repeated rows are records of their own; an empty table
gives no rows; other columns, whatever their names, are handed through; only those named like
a column that is added are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkit.llm.shared import hidden, shown

SHARDS = 24
RANGES = 64
OVERFULL = 4
PIECE_ROWS = 200_000
PER_SPLITTER = 8
RECORD_BYTES = 8


def _drawn(size: str, rate: Column) -> Column:
    """Whether a record is in the sample: its own uniform number against size times rate."""
    uniform = F.pmod(F.xxhash64("_key", "doc_id", F.lit(7)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return uniform < F.col(size) * rate


def _place(splitters: list[int]) -> Column:
    """Number of splitters up to the key, by binary search."""
    if not splitters:
        return F.lit(0)
    steps = [1 << b for b in range(len(splitters).bit_length() - 1, -1, -1)]
    table = F.lit(splitters)
    jump = lambda at, step: F.when(F.get(table, at + step - 1) <= F.col("_key"), at + step).otherwise(at)
    return F.aggregate(F.lit(steps), F.lit(0), jump)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the ``_size``, ``_crc`` and ``_key`` of the text, all that ``place`` looks at."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + RECORD_BYTES).cast("long")
    return docs.withColumns({"_size": size, "_crc": F.crc32(text.cast("binary")), "_key": F.xxhash64(text)})


def place(records: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``keyed`` records with ``_shard`` and ``_slot``."""
    placed = _placed(records.select(*hidden(records), "doc_id", "_size", "_crc", "_key"), shards)
    return placed.select(*shown(records.columns, ("_shard", "_slot")), "_shard", "_slot")


def _placed(records: DataFrame, shards: int) -> DataFrame:
    """``records``, their own columns ``hidden``, with ``_shard`` and ``_slot``."""
    small = records.select("_key", "doc_id", "_size")
    rows, total = small.agg(F.count("*"), F.sum("_size")).first()
    wanted = max(shards * RANGES, rows // PIECE_ROWS)
    sample = small.filter(_drawn("_size", F.lit(wanted * PER_SPLITTER / max(total or 1, 1))))
    cuts = sample.agg(F.percentile_approx("_key", [i / wanted for i in range(1, wanted)], 100 * wanted)).first()[0]
    ranged = records.withColumn("_range", _place(sorted(set(cuts or []))))

    # Both tables below have a row for each range or piece, at most 3 * wanted in all, so they are broadcast
    mean = F.lit((total or 0) / wanted)
    weight = F.sum("_size").alias("_bytes")
    full = ranged.groupBy("_range").agg(weight).filter(F.col("_bytes") > OVERFULL * mean)
    split = full.select("_range", F.ceil(F.col("_bytes") / mean).cast("int").alias("_pieces"))
    ranged = ranged.join(F.broadcast(split), "_range", "left")
    piece = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.col("_pieces"))
    ranged = ranged.withColumn("_piece", F.coalesce(piece, F.lit(0))).drop("_pieces")
    inside = ranged.groupBy("_range", "_piece").agg(weight, F.count("*").alias("_rows"))
    in_order = Window.orderBy("_range", "_piece")
    middle = F.sum("_bytes").over(in_order) - F.col("_bytes") / 2
    shard = F.least(F.floor(middle * shards / F.lit(total or 1)), F.lit(shards - 1)).cast("int")
    inside = inside.withColumn("_shard", shard)
    offset = F.sum("_rows").over(Window.partitionBy("_shard").orderBy("_range", "_piece")) - F.col("_rows")
    inside = inside.withColumn("_offset", offset).select("_range", "_piece", "_shard", "_offset")
    number = F.row_number().over(Window.partitionBy("_range", "_piece").orderBy("_key", "doc_id", "_size", "_crc"))
    placed = ranged.join(F.broadcast(inside), ["_range", "_piece"])
    return placed.withColumn("_slot", F.col("_offset") + number - 1).select(*records.columns, "_shard", "_slot")


def assign(
    docs: DataFrame, shards: int = SHARDS, size: str | None = "_size", shard: str = "_shard", slot: str = "_slot"
) -> DataFrame:
    """All columns of ``docs`` with the record's size (None: not given), shard and slot under these names."""
    records = keyed(docs.select(*hidden(docs), "doc_id", "text")).drop("text")
    placed = _placed(records, shards)
    names = {"_size": size, "_shard": shard, "_slot": slot}
    added = {c: name for c, name in names.items() if name is not None}
    return placed.select(*shown(docs.columns, added.values()), *(F.col(c).alias(n) for c, n in added.items()))
