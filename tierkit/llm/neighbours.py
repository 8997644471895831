"""Quality by the votes of the nearest labelled texts in a latent-semantic space.

A text is the sum of its features: words, word shapes (letters by case, digits, other signs; runs
folded), neighbouring shapes, words that repeat the one before, and the order of its length. Each is
hashed to a column of ``WIDTH``; a text's share of a column is weighted by the root, and by
how rare the column is among the labelled texts. ``RANK`` singular directions of the labelled texts
span the space, and a text is its unit vector there.

Every text is compared with all labelled vectors, exactly, as products of blocks. The nearest, half the
root of the labelled texts' number but ``VOTES`` at most, and all that tie with the last of them
vote for their labels by the similarity's power ``SHARPNESS``, weighted so that the two labels count
as often as they occur.

The model is fitted on at most ``LEARN`` distinct labelled texts of either label, those of least
hash: that bounds what is fetched and what is sent (``2 * LEARN * RANK`` numbers), whatever the size of
the tables. Copies of a text count once, with their mean label. Scoring reads whole texts, in
slices, and moves none.

Defined results: a null, empty or blank text has no feature but its length and is scored by that;
a vector without a neighbour of positive similarity has the labels' own share as its score; without
labelled texts the score is 0.5; null labels, labels without a document and null ``doc_id`` teach
nothing; repeated rows are each scored; an empty table gives no rows; columns other than
``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkit.llm.shared import stored
from tierkit.llm.words import Words, column, map_slices, mix

LEARN = 2048
WIDTH = 4096
RANK = 48
VOTES = 25
SHARPNESS = 4
BLOCK = 512
_FAMILIES = 5
_SIGNS = np.arange(256, dtype=np.uint8)
_SIGNS[65:91] = 1
_SIGNS[97:123] = _SIGNS[128:] = 2
_SIGNS[48:58] = 3


def _shapes(w: Words) -> np.ndarray:
    """Hash of the shape of each word: its signs with runs folded."""
    signs = _SIGNS[w.data]
    kept = np.ones(len(signs), bool)
    kept[1:] = signs[1:] != signs[:-1]
    kept[w.start] = True
    at = np.concatenate(([0], np.cumsum(kept)))
    folded = Words(pa.array([], pa.string()))
    folded.data = signs[kept]
    return folded.spans(at[w.start], at[w.end])


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Text, column and weight of the features of each text, columns in order, and the number of texts."""
    w = Words(texts)
    words, shapes = w.hash, _shapes(w)
    same = np.flatnonzero(w.doc[1:] == w.doc[:-1])
    again = same[words[1:][same] == words[:-1][same]]
    size = np.frexp(w.n)[1].astype(np.uint64)  # the order of the number of words
    doc = np.concatenate((w.doc, w.doc, w.doc[same], w.doc[again], np.arange(len(w.n))))
    pairs = mix(shapes[same]) + shapes[same + 1]
    keys = (words, shapes, pairs, np.ones(len(again), np.uint64), size)
    seed = np.repeat(np.arange(_FAMILIES, dtype=np.uint64) * np.uint64(0x51ED), [len(k) for k in keys])
    at = (mix(np.concatenate(keys) + seed) >> np.uint64(40)) % np.uint64(WIDTH)
    cell = doc.astype(np.int64) * WIDTH + at.astype(np.int64)
    cells, counts = np.unique(cell, return_counts=True)
    doc = cells // WIDTH
    return doc, cells % WIDTH, np.sqrt(counts / np.maximum(w.n, 1)[doc]), len(w.n)


@dataclass(frozen=True)
class Model:
    """Projection of the columns, the labelled unit vectors, and what each votes for and counts."""

    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    counts: np.ndarray

    def place(self, doc: np.ndarray, at: np.ndarray, weight: np.ndarray, rows: int) -> np.ndarray:
        """Unit vectors of the texts; zero where nothing falls into the space."""
        out = np.zeros((rows, self.projection.shape[1]), np.float32)
        first = np.searchsorted(doc, np.arange(rows + 1))
        for i in range(rows):
            some = slice(first[i], first[i + 1])
            out[i] = weight[some].astype(np.float32) @ self.projection[at[some]]
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    def score(self, texts: pa.Array, votes: int) -> np.ndarray:
        *found, rows = features(texts)
        if not len(self.labels):
            return np.full(rows, 0.5)
        share = float(self.labels @ self.counts / self.counts.sum())
        placed, out = self.place(*found, rows), np.full(rows, share)
        votes = max(1, min(votes, round(len(self.labels) ** 0.5 / 2)))
        for at in range(0, rows, BLOCK):
            near = np.round(placed[at : at + BLOCK] @ self.vectors.T, 5)
            last = np.partition(near, -votes, axis=1)[:, -votes, None]
            power = np.where(near >= np.maximum(last, 1e-5), near, 0).astype(np.float64) ** SHARPNESS * self.counts
            total = power.sum(axis=1)
            some = total > 0
            out[at : at + BLOCK][some] = (power @ self.labels)[some] / total[some]
        return np.round(np.clip(out, 0, 1), 6)


def _sampled(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """``hash, label, n`` of the distinct labelled texts of least hash, up to ``most`` with a label of a half or
    more and as many below; ``n`` rows of all labelled texts stand behind each."""
    hashed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    known = labels.filter("doc_id IS NOT NULL").join(hashed, "doc_id")
    texts = stored(known.groupBy("hash").agg(F.avg("label").alias("label")), "labelled")
    kind, number = F.col("label") >= 0.5, F.pmod(F.xxhash64("hash", F.lit(11)), F.lit(1 << 40))
    sizes = texts.groupBy(kind.alias("kind")).agg(F.count("*").alias("of"))
    # four times as many as wanted, and some more, lie below this bound but for chance
    bound = F.lit(0)
    for row in sizes.collect():  # two rows
        bound = F.when(kind == row["kind"], F.lit(min((4 * most + 64) * (1 << 40) // row["of"], 1 << 40))).otherwise(bound)
    order = Window.partitionBy(kind).orderBy(number, "hash")
    few = texts.filter(number < bound).withColumn("place", F.row_number().over(order)).filter(F.col("place") <= most)
    few = few.join(F.broadcast(sizes), F.col("kind") == kind)  # two rows
    return few.select("hash", "label", (F.col("of") / F.least(F.col("of"), F.lit(most))).alias("n"))


def learn(docs: DataFrame, labels: DataFrame, most: int = LEARN, rank: int = RANK) -> Model:
    """A model from ``labels(doc_id, label)``, label 0 or 1, of the ``docs``."""
    columns = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    chosen = _sampled(columns, labels.filter("label IS NOT NULL"), most)
    rows = chosen.collect()  # at most 2 * most
    spark = docs.sparkSession
    if not rows:
        empty = np.zeros((0, rank), np.float32)
        return Model(np.zeros((WIDTH, rank), np.float32), empty, np.zeros(0), np.zeros(0))
    known = F.broadcast(spark.createDataFrame(rows, chosen.schema).select("hash"))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        doc, at, weight, n = features(part.column("text"))
        first = pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32))
        lists = {"at": pa.ListArray.from_arrays(first, column(at)), "weight": pa.ListArray.from_arrays(first, column(weight))}
        return pa.RecordBatch.from_pydict({"hash": part.column("hash"), **lists})

    texts = columns.withColumn("hash", F.xxhash64("text")).join(known, "hash", "left_semi").select("hash", "text")
    wanted = map_slices(texts, work, "hash long, at array<long>, weight array<double>").dropDuplicates(["hash"])
    table = wanted.orderBy("hash").toArrow()
    of = {r["hash"]: r for r in rows}
    picked = [of[h] for h in table.column("hash").to_pylist()]
    sizes = table.column("at").combine_chunks().value_lengths().to_numpy()
    doc = np.repeat(np.arange(len(picked)), sizes)
    at, weight = (table.column(c).combine_chunks().flatten().to_numpy() for c in ("at", "weight"))
    rarity = np.log1p(len(picked) / np.maximum(np.bincount(at, minlength=WIDTH), 1)).astype(np.float32)
    matrix = np.zeros((len(picked), WIDTH), np.float32)
    matrix[doc, at] = weight * rarity[at]
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)
    directions = _directions(matrix, min(rank, *matrix.shape))
    labels, counts = (np.array([r[c] for r in picked], np.float64) for c in ("label", "n"))
    model = Model(rarity[:, None] * directions, np.zeros((0, 0)), labels, counts)
    vectors = model.place(doc, at, weight, len(picked))
    return Model(model.projection, vectors, labels, counts)


def _directions(matrix: np.ndarray, rank: int) -> np.ndarray:
    """The leading right singular directions, by subspace iteration."""
    rng = np.random.default_rng(11)
    basis = np.linalg.qr(rng.standard_normal((matrix.shape[1], min(rank + 16, *matrix.shape))).astype(np.float32))[0]
    for _ in range(6):
        basis = np.linalg.qr(matrix.T @ (matrix @ basis))[0]
    _, _, turn = np.linalg.svd(matrix @ basis, full_matrices=False)
    return (basis @ turn.T)[:, :rank]


def score(docs: DataFrame, model: Model, votes: int = VOTES) -> DataFrame:
    """``doc_id, score`` of every row: the share of votes for label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        found = sent.value.score(part.column("text"), votes)
        return pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "score": column(found)})

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, "doc_id long, score double")


def fold(parts: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the ``doc_id`` as text by ``parts``."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % parts
