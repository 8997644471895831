"""Benchmark decontamination: CGK embeddings, bit-sampling LSH, exact edit verification.

A text is its sequence of words, lower-cased, with everything but letters and digits as
separators. The CGK embedding reads such a sequence by a random walk: at every step it emits
the word it stands on, and a random bit of (step, word) decides whether it goes on to the
next, so that a small edit distance becomes a small Hamming distance. A walk starts at every
word of the documents and at every word of the benchmark items; a table samples ``SAMPLES``
steps of the walk as a key. ``WALKS`` independent walks with ``TABLES`` samplings each bring an
item within the allowed distance to a common key with the recall that the tests measure. An
item of fewer than ``WALKED`` words has too few walks inside it for that: it is cut into one
piece more than it may have edits, so at least one piece occurs as it is in every passage within
the distance, and the hashes of its pieces are its keys; none is missed. A
common key aligns an item with a place in a document; the item-sized window there, widened
by the allowed edits, is then compared with the item exactly.

An item of n words is found in a document when the word edit distance between the item and
some passage of the document is at most ``(1 - similarity) * n``. Items shorter than
``LEAST_WORDS`` words must occur exactly.

The benchmark goes to the tasks in blocks of ``BLOCK_WORDS`` words, one pass over the documents
a block, so what is sent has a fixed size and there is no limit on the number of items. The
documents are never shuffled.

Defined results: null or empty texts, and items without a word, match nothing; a null
``item_id`` or ``doc_id`` is reported as null; items with equal text are all reported; rows that
repeat a document report once per ``doc_id``; empty tables give no rows; other columns are
not looked at and ``filter_documents`` hands them through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.llm.words import LOWER, Lookup, Words, column, map_slices, mix, slices

WALKS = 2
TABLES = 6
SAMPLES = 7
STEPS = 16
LEAST_WORDS = 5
WALKED = 20
BLOCK_WORDS = 50_000

_LETTERS = LOWER.copy()
_LETTERS[[b for b in range(128) if not chr(b).isalnum()]] = 32
_GROW = np.uint64(0x9E3779B97F4A7C15)
_random = np.random.default_rng(1)
_PLAN = [[sorted(_random.choice(STEPS, SAMPLES, replace=False).tolist()) for _ in range(TABLES)] for _ in range(WALKS)]


def normalised(texts: pa.Array) -> Words:
    """Words of letters and digits, in lower case."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if bounds[-1] == bounds[0]:
        return Words(texts)
    data = _LETTERS[np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]]
    offsets = pa.py_buffer((bounds - bounds[0]).tobytes())
    return Words(pa.Array.from_buffers(pa.large_binary(), len(texts), [None, offsets, pa.py_buffer(data)]))


def embed(hashes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Table number, key, and last word read, of a walk from every word."""
    n = len(hashes)
    padded = np.concatenate((hashes, np.zeros(STEPS + 1, np.uint64)))
    for walk in range(WALKS):
        bits = mix(padded ^ mix(np.full(1, walk + 11, np.uint64)))
        keys = [np.full(n, 97 * walk + t + 1, np.uint64) for t in range(TABLES)]
        last = [np.zeros(n, np.int64) for _ in range(TABLES)]
        at = np.arange(n)
        for step in range(max(max(p) for p in _PLAN[walk]) + 1):
            users = [t for t in range(TABLES) if step in _PLAN[walk][t]]
            if users:
                read = padded[at]
                for t in users:
                    keys[t] *= _GROW
                    keys[t] += read
                    if step == _PLAN[walk][t][-1]:
                        last[t] = at.copy()
            at = at + ((bits[at] >> np.uint64(step)) & np.uint64(1)).astype(np.int64)
        for t in range(TABLES):
            yield walk * TABLES + t, mix(keys[t]), last[t]


class Items:
    """One block of benchmark items: their words, and the places behind every key."""

    def __init__(self, ids: list, texts: list, similarity: float):
        w = normalised(pa.array(texts, pa.string()))
        self.ids, self.words, self.first, self.n = ids, w.hash, w.first, w.n
        self.allowed = np.floor((1 - similarity) * w.n + 1e-9).astype(np.int64)
        long = w.n >= WALKED
        self.tables = []
        for _, keys, last in embed(self.words):
            own = np.flatnonzero(long[w.doc] & (last < w.first[1:][w.doc]))
            order = own[np.argsort(keys[own], kind="stable")]
            self.tables.append((keys[order], order, w.doc[order], Lookup(np.unique(keys[order]), 7)))
        self.pieces = {}
        begins, sizes = self._pieces(~long & (w.n > 0))
        for size in np.unique(sizes).tolist():
            wanted = np.zeros(len(self.words), bool)
            wanted[begins[sizes == size]] = True
            at, keys = w.windows(self.words, size)
            at, keys = at[wanted[at]], keys[wanted[at]]
            order = np.argsort(keys, kind="stable")
            at, keys = at[order], keys[order]
            self.pieces[size] = (keys, at, w.doc[at], Lookup(np.unique(keys), 7))

    def _pieces(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First word and size of the pieces of the chosen items."""
        begins, sizes = [], []
        for i in np.flatnonzero(chosen):
            n = int(self.n[i])
            cuts = min(int(self.allowed[i]) + 1, n) if n >= LEAST_WORDS else 1
            edges = np.arange(cuts + 1) * n // cuts
            begins.append(self.first[i] + edges[:-1])
            sizes.append(np.diff(edges))
        none = np.zeros(0, np.int64)
        return np.concatenate([none, *begins]), np.concatenate([none, *sizes])

    def aligned(self, w: Words, hashes: np.ndarray) -> np.ndarray:
        """Distinct (text, item, place in ``hashes`` where the item would begin)."""
        found = [np.zeros((0, 3), np.int64)]
        pieces = ((table, *w.windows(hashes, size)) for size, table in self.pieces.items())
        walked = ((self.tables[t], np.arange(len(k)), k) for t, k, _ in embed(hashes))
        for (table, places, items, lookup), at, keys in chain(pieces, walked):
            hit, place = lookup.find(keys)
            if not len(hit):
                continue
            low = np.searchsorted(table, lookup.keys[place])
            many = np.searchsorted(table, lookup.keys[place], "right") - low
            spread = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            word, item = np.repeat(at[hit], many), items[spread]
            found.append(np.stack((w.doc[word], item, word - (places[spread] - self.first[item])), axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def distances(self, w: Words, hashes: np.ndarray, hits: np.ndarray) -> np.ndarray:
        """Edit distance of each hit's item from the nearest passage around its place."""
        doc, item, begin = hits.T
        slack = self.allowed[item]
        n = self.n[item]
        length, most = int((n + 2 * slack).max()), int(n.max())
        at = (begin - slack)[:, None] + np.arange(length)
        inside = (at >= w.first[doc][:, None]) & (at < w.first[doc + 1][:, None]) & (np.arange(length) < (n + 2 * slack)[:, None])
        region = np.where(inside, hashes[np.clip(at, 0, len(hashes) - 1)], np.uint64(0))
        row = np.zeros((len(hits), length + 1), np.int32)
        step = np.arange(length + 1, dtype=np.int32)
        best = np.full(len(hits), 1 << 30, np.int64)
        for i in range(most):
            word = self.words[np.minimum(self.first[item] + i, len(self.words) - 1)]
            differs = region != word[:, None]
            below = row + 1
            below[:, 1:] = np.minimum(below[:, 1:], row[:, :-1] + differs)
            row = np.minimum.accumulate(below - step, axis=1) + step
            done = n == i + 1
            if done.any():
                best[done] = row[done].min(axis=1)
        return best

    def search(self, part: pa.RecordBatch) -> dict[str, np.ndarray]:
        """Text and item of every match in a slice, with the least distance."""
        w = normalised(part.column("text"))
        hashes = w.hash
        hits = self.aligned(w, hashes) if len(hashes) else np.zeros((0, 3), np.int64)
        far = [self.distances(w, hashes, hits[i : i + 2000]) for i in range(0, len(hits), 2000)]
        far = np.concatenate(far) if far else np.zeros(0, np.int64)
        near = far <= self.allowed[hits[:, 1]]
        hits, far = hits[near], far[near]
        order = np.lexsort((far, hits[:, 1], hits[:, 0]))
        hits, far = hits[order], far[order]
        new = np.ones(len(hits), bool)
        new[1:] = (hits[1:, :2] != hits[:-1, :2]).any(axis=1)
        return {"doc": hits[new, 0], "item": hits[new, 1], "edits": far[new]}


def blocks(benchmark: DataFrame, similarity: float) -> Iterator[Items]:
    """Benchmark items in blocks of a fixed number of words."""
    ids, texts, words = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        ids.append(row["item_id"])
        texts.append(row["text"])
        words += len((row["text"] or "").split())
        if words >= BLOCK_WORDS:
            yield Items(ids, texts, similarity)
            ids, texts, words = [], [], 0
    if ids:
        yield Items(ids, texts, similarity)


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """``doc_id, item_id, item_words, edits`` of every item found in a document."""
    schema = "doc_id long, item_id long, item_words long, edits long"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def over(items: Items) -> DataFrame:
        shipped = docs.sparkSession.sparkContext.broadcast(items)

        def work(part: pa.RecordBatch) -> pa.RecordBatch:
            block = shipped.value
            found = block.search(part)
            return pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id").take(pa.array(found["doc"])),
                    "item_id": pa.array([block.ids[i] for i in found["item"]], pa.int64()),
                    "item_words": column(block.n[found["item"]].astype(np.int64)),
                    "edits": column(found["edits"].astype(np.int64)),
                }
            )

        return map_slices(docs, work, schema)

    parts = [over(items) for items in blocks(benchmark, similarity)]
    if not parts:
        return docs.sparkSession.createDataFrame([], schema)
    return reduce(DataFrame.union, parts).groupBy("doc_id", "item_id", "item_words").agg(F.min("edits").alias("edits"))


def filter_documents(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The documents in which no item is found, with all their columns, without a shuffle."""
    for items in blocks(benchmark, similarity):
        docs = _without(docs, docs.sparkSession.sparkContext.broadcast(items))
    return docs


def _without(docs: DataFrame, shipped) -> DataFrame:
    def keep(batches):
        for part in slices(batches):
            clean = np.ones(part.num_rows, bool)
            clean[shipped.value.search(part)["doc"]] = False
            yield part.filter(pa.array(clean))

    return docs.mapInArrow(keep, docs.schema)
