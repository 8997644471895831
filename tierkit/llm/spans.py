"""Substring dedup on a compacted de Bruijn graph of words.

Every run of ``WINDOW`` words is an edge between its first and its last ``WINDOW - 1`` words. Edges
that more than one document holds are repeated.

Each window has an anchor, the least of the hashes of its ``ANCHOR``-word runs; equal windows
have equal anchors, and neighbouring windows mostly share theirs. The windows of a text on
one anchor are a path of edges. A first aggregate over the anchors, a fifth of the windows,
finds those that two documents share; all other edges occur once and are never shuffled.
Where all paths on a shared anchor are the same words, the path does not branch and is
compacted: one row stands for its edges. Only the edges on branching anchors are joined one
by one, told apart by 96 bits. Neighbouring pieces of a text that the same documents hold
then compact into one span with its source coordinates: document, first word, words, and
the first document that holds it.

Hot anchors and edges are folded before the aggregates, and adaptive execution splits them
in the joins. The tasks get a bitmap of the shared anchors, 16 MB at every size: no anchor outside
it is shared, and what passes it without being shared falls away in the joins. At sizes where
most bits are set it only stops sparing rows.

Defined results: null and empty texts have no words; texts shorter than a window keep all
words; a window that only one document repeats is not repeated; a row with a null ``doc_id``
takes no part and keeps all words; rows that repeat a ``doc_id`` are the same document,
neither smaller than the other, each with its own coordinates if the texts differ; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierkit.llm.shared import stored
from tierkit.llm.words import Words, column, map_slices, mix, packed, unpacked_array

WINDOW = 13
ANCHOR = 5
BITMAP = 1 << 27


def _sliding(values: np.ndarray, size: int, fold) -> np.ndarray:
    """``fold`` over every run of ``size`` values."""
    width, out = 1, values
    while width * 2 <= size:
        out = fold(out[:-width], out[width:])
        width *= 2
    rest = size - width
    return fold(out[: len(out) - rest], out[rest:]) if rest else out


class Graph:
    """Windows of the texts of a slice, with the anchor of each."""

    def __init__(self, texts: pa.Array, window: int):
        self.words = w = Words(texts)
        self.hashes = w.hash
        n = len(self.hashes) - window + 1
        size = min(ANCHOR, window)
        if n <= 0:
            self.at, self.anchor = np.zeros(0, np.int64), np.zeros(0, np.uint64)
            return
        grams = np.zeros(len(self.hashes) - size + 1, np.uint64)
        for j in range(size):
            grams *= np.uint64(0xD6E8FEB86659FD93)
            grams += self.hashes[j : j + len(grams)]
        self.at = np.flatnonzero(w.doc[:n] == w.doc[window - 1 :])
        self.anchor = _sliding(mix(grams), window - size + 1, np.minimum)[self.at]

    def edges(self, chosen: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the chosen windows."""
        at = self.at[chosen]
        high, low = np.zeros(len(at), np.uint64), np.full(len(at), 7, np.uint64)
        for j in range(window):
            word = self.hashes[at + j]
            high = high * np.uint64(0xD6E8FEB86659FD93) + word
            low = (low ^ mix(word + np.uint64(j))) * np.uint64(0x9E3779B97F4A7C15)
        return mix(high), (mix(low) >> np.uint64(33)).astype(np.int32)


def _anchors(docs: DataFrame, window: int) -> DataFrame:
    """``doc_id, anchor``, once a text."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        g = Graph(part.column("text"), window)
        doc = g.words.doc[g.at]
        new = np.ones(len(doc), bool)  # neighbours mostly share their anchor
        new[1:] = (g.anchor[1:] != g.anchor[:-1]) | (doc[1:] != doc[:-1])
        return pa.RecordBatch.from_pydict(
            {"doc_id": part.column("doc_id").take(pa.array(doc[new])), "anchor": column(g.anchor[new])}
        )

    return map_slices(docs, work, "doc_id long, anchor long")


def _bitmap(anchors: DataFrame) -> np.ndarray:
    """A bit for each remainder of an anchor by ``BITMAP``, in bytes, least bit first."""
    cell = F.pmod("anchor", F.lit(BITMAP)) + 1  # the bitmap functions count from 1
    parts = anchors.groupBy(F.bitmap_bucket_number(cell).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(cell)).alias("bits")
    )
    out = np.zeros(BITMAP // 8, np.uint8)
    for bucket, bits in parts.collect():  # as many as the bitmap has parts of 4 KB, at most
        out[(bucket - 1) * len(bits) : bucket * len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def _on_anchors(docs: DataFrame, anchors: DataFrame, window: int, pieces, schema: str) -> DataFrame:
    """``pieces(graph, chosen windows)`` over the windows on ``anchors`` and a few more, with ``doc_id`` and ``place``.

    ``place`` holds 31 bits that tell texts of one ``doc_id`` apart above 32 bits for the number of
    the first word.
    """
    known = docs.sparkSession.sparkContext.broadcast(_bitmap(anchors))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        g = Graph(part.column("text"), window)
        cell = g.anchor & np.uint64(BITMAP - 1)
        chosen = np.flatnonzero(known.value[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8) & 1)
        at, columns = pieces(g, chosen)
        doc = g.words.doc[at]
        tag = _tags(g.words)[doc] << np.uint64(32)
        place = tag | (at - g.words.first[doc]).astype(np.uint64)
        columns = {k: column(v) for k, v in (*columns.items(), ("place", place))}
        return pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id").take(pa.array(doc)), **columns})

    return map_slices(docs, work, f"doc_id long, {schema}, place long")


def _tags(w: Words) -> np.ndarray:
    """31 bits of each text."""
    return w.spans(w.bounds[:-1], w.bounds[1:]) >> np.uint64(33)


def _paths(docs: DataFrame, anchors: DataFrame, window: int) -> DataFrame:
    """``doc_id, anchor, path, edges, place``: the windows of a text on one anchor as one path."""

    def pieces(g: Graph, chosen: np.ndarray):
        at, anchor = g.at[chosen], g.anchor[chosen]
        new = np.ones(len(at), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (np.diff(at) > 1) | (np.diff(g.words.doc[at]) > 0)
        first, n = np.flatnonzero(new), np.diff(np.append(np.flatnonzero(new), len(at)))
        return at[first], {
            "anchor": anchor[first],
            "path": g.words.phrases(g.hashes, at[first], at[first] + n + window - 1),
            "edges": n.astype(np.int32),
        }

    return _on_anchors(docs, anchors, window, pieces, "anchor long, path long, edges int")


def _edges(docs: DataFrame, anchors: DataFrame, window: int) -> DataFrame:
    """``doc_id, high, low, place`` of the single windows on ``anchors``."""

    def pieces(g: Graph, chosen: np.ndarray):
        high, low = g.edges(chosen, window)
        return g.at[chosen], {"anchor": g.anchor[chosen], "high": high, "low": low}

    found = _on_anchors(docs, anchors, window, pieces, "anchor long, high long, low int")
    return found.join(anchors, "anchor", "left_semi").drop("anchor")


def _held(df: DataFrame, *keys: str) -> DataFrame:
    """What more than one document holds, with the first and the last of them."""
    documents = (F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
    paths = (F.min("path").alias("low_path"), F.max("path").alias("high_path")) if "path" in df.columns else ()
    return df.groupBy(*keys).agg(*documents, *paths).filter("first_doc < last_doc")


def repeated_spans(docs: DataFrame, window: int = WINDOW, later_only: bool = False) -> DataFrame:
    """``doc_id, tag, start, words, first_doc, last_doc``: the nonbranching repeated paths, at each
    place where they occur; ``later_only`` leaves out the first document of each.

    Neighbouring pieces of a text belong to one path while the same first and last document
    hold them. ``tag`` tells texts that share a ``doc_id`` apart.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id IS NOT NULL")
    shared = stored(_held(_anchors(docs, window), "anchor").select("anchor"), "anchors")
    paths = _paths(docs, shared, window)
    held = stored(_held(paths, "anchor"), "paths")
    straight = paths.join(held.filter("low_path = high_path"), "anchor")
    branching = held.filter("low_path <> high_path").select("anchor")
    edges = _edges(docs, branching, window)
    single = edges.join(_held(edges, "high", "low"), ["high", "low"]).withColumn("edges", F.lit(1))
    columns = ("doc_id", "place", "edges", "first_doc", "last_doc")
    found = straight.select(*columns).union(single.select(*columns))
    if later_only:
        found = found.filter("doc_id > first_doc")
    # a group is one document's pieces, so it is bounded by the length of a text
    in_text = Window.partitionBy("doc_id").orderBy("place")
    again = F.col("place").eqNullSafe(F.lag("place").over(in_text))  # from rows that repeat a document
    found = found.withColumn("again", again).filter("NOT again").drop("again")
    follows = F.col("place").eqNullSafe(F.lag(F.col("place") + F.col("edges")).over(in_text))
    for c in ("first_doc", "last_doc"):
        follows &= F.col(c).eqNullSafe(F.lag(c).over(in_text))
    number = F.sum("begins").over(in_text.rowsBetween(Window.unboundedPreceding, 0))
    chained = found.withColumn("begins", F.when(follows, 0).otherwise(1)).withColumn("number", number)
    spans = chained.groupBy("doc_id", "number").agg(
        F.min("place").alias("place"),
        F.sum("edges").alias("edges"),
        F.min("first_doc").alias("first_doc"),
        F.min("last_doc").alias("last_doc"),
    )
    return spans.select(
        "doc_id",
        F.shiftright("place", 32).alias("tag"),
        F.col("place").bitwiseAND((1 << 32) - 1).alias("start"),
        (F.col("edges") + window - 1).alias("words"),
        "first_doc",
        "last_doc",
    )


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` (binary: kept words joined by one space) of every row,
    without the words of windows that a document of smaller ``doc_id`` holds too."""
    later = repeated_spans(docs, window, later_only=True)
    by_doc = later.groupBy("doc_id").agg(F.collect_list(F.struct("tag", "start", "words")).alias("spans"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        w = Words(unpacked_array(part.column("text")))
        spans = part.column("spans").fill_null([])
        row = np.repeat(np.arange(part.num_rows), spans.value_lengths().to_numpy())
        tag, start, words = (f.to_numpy(zero_copy_only=False).astype(np.int64) for f in spans.flatten().flatten())
        own = tag == _tags(w).astype(np.int64)[row]
        begin = w.first[row[own]] + start[own]
        step = np.zeros(len(w.start) + 1, np.int64)
        np.add.at(step, begin, 1)
        np.add.at(step, begin + words[own], -1)
        gone = np.cumsum(step)[:-1] > 0
        data, kept = w.data.tobytes(), []
        for d in range(part.num_rows):
            some = range(w.first[d], w.first[d + 1])
            kept.append(b" ".join([data[w.start[i] : w.end[i]] for i in some if not gone[i]]))
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                "n_words": column(w.n.astype(np.int64)),
                "n_removed": column(np.bincount(w.doc[gone], minlength=len(w.n)).astype(np.int64)),
                "kept": pa.array(kept, pa.binary()),
            }
        )

    both = packed(texts).join(by_doc, "doc_id", "left")
    return map_slices(both, work, "doc_id long, n_words long, n_removed long, kept binary")
