"""Runs: stretches of words that repeat with a period, found by difference-cover extension queries.

A run is a stretch of words with a smallest period ``q``, at least ``LEAST`` words and at least
``REPEATS * q`` words long, that no neighbouring word extends with that period. Work is by the
slice of texts; every text ends with a word of its own, so nothing reaches into the next.

How far two places agree is a longest-common-extension query. Only the suffixes at places
that the difference cover samples, 6 of 31, are sorted: by their first 31 words, then by
doubling over places 31 words apart, which are sampled too. For any two places some shift
below 31 brings both to sampled ones; up to there words are compared one by one, and the rest is
a minimum over the sorted neighbours' common lengths, read from a sparse table. A second
index over the reversed words extends to the left.

Runs come from harmonic grids: a run of period ``p`` holds at least ``max(LEAST - p, 2p)`` places in
a row whose word is that ``p`` places on, so of a grid of that step one place is among them.
All grids together have ``n log n`` places. Extending such a place both ways gives the run; a
stretch found with several periods has the smallest.

Memory follows the longest text; texts are never cut, and nothing is shuffled, so a hot group
of copies costs what its rows cost. Defined results: a null, empty or blank text has no runs
and an empty collapsed text; a null ``doc_id`` stays null; repeated rows are each judged; an empty
table gives no rows; columns other than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.llm.words import Words, column, map_slices

LEAST = 24
REPEATS = 3
GRID_PLACES = 1 << 21
# A perfect difference set, whose differences modulo 31 are all numbers below 31.
SPAN = 31
COVER = np.array([0, 1, 3, 8, 12, 18])

_SLOT = np.full(SPAN, -1)
_SLOT[COVER] = np.arange(len(COVER))


def _shifts() -> np.ndarray:
    """Least shift that brings places of two residues to sampled ones."""
    sampled = _SLOT >= 0
    steps = (np.arange(SPAN)[:, None] + np.arange(SPAN)) % SPAN  # residue, shift
    both = sampled[steps][:, None, :] & sampled[steps][None, :, :]
    return both.argmax(axis=2)


_SHIFT = _shifts()


class Extensions:
    """Longest common extensions of places in ``ids``, whose last word occurs once."""

    def __init__(self, ids: np.ndarray):
        self.ids, n = ids, len(ids)
        self.places = np.flatnonzero(_SLOT[np.arange(n) % SPAN] >= 0)
        self.levels = [self._blocks()]
        step, count = len(COVER), len(self.places)
        while True:
            rank = self.levels[-1]
            if rank.max() + 1 == count:
                break
            after = np.zeros(count, np.int64)
            after[: max(count - step, 0)] = rank[step:] + 1
            keys = rank * (count + 1) + after
            order = np.argsort(keys, kind="stable")
            new = np.ones(count, np.int64)
            new[0] = 0
            new[1:] = keys[order[1:]] != keys[order[:-1]]
            rank = np.empty(count, np.int64)
            rank[order] = np.cumsum(new)
            self.levels.append(rank)
            step *= 2
        self.rank = self.levels[-1]
        order = np.empty(count, np.int64)
        order[self.rank] = np.arange(count)
        self.minima = [self._neighbours(order[:-1], order[1:])]
        while 2 << (len(self.minima) - 1) < count:
            width = 1 << (len(self.minima) - 1)
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
        del self.levels

    def _blocks(self) -> np.ndarray:
        """Ranks of the sampled places by their first ``SPAN`` words, several words to a sort key."""
        bits = int(self.ids.max() + 1).bit_length()
        each = 62 // bits
        padded = np.concatenate((self.ids + 1, np.zeros(SPAN + each, np.int64)))
        order, keys = np.arange(len(self.places)), []
        for start in reversed(range(0, SPAN, each)):
            key = np.zeros(len(self.places), np.int64)
            for j in range(start, min(start + each, SPAN)):
                key = (key << bits) | padded[self.places + j]
            keys.append(key)
            order = order[np.argsort(key[order], kind="stable")]
        new = np.zeros(len(order), bool)
        for key in keys:
            new[1:] |= key[order[1:]] != key[order[:-1]]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _neighbours(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common words of the sampled suffixes ``a`` and ``b``: whole blocks by the ranks, the rest one by one."""
        count, done = len(self.places), np.zeros(len(a), np.int64)
        for k in reversed(range(len(self.levels))):
            x, y = a + done, b + done
            inside = np.maximum(x, y) < count
            same = inside.copy()
            same[inside] = self.levels[k][x[inside]] == self.levels[k][y[inside]]
            done[same] += len(COVER) << k
        blocks = done // len(COVER) * SPAN
        x, y = self.places[a] + blocks, self.places[b] + blocks
        return blocks + self._walk(x, y, np.full(len(a), SPAN))

    def _walk(self, i: np.ndarray, j: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Words that agree from ``i`` and ``j`` on, up to ``most``."""
        out, left = most.copy(), np.arange(len(i))
        for t in range(SPAN):
            left = left[most[left] > t]
            if not len(left):
                break
            same = self.ids[i[left] + t] == self.ids[j[left] + t]
            out[left[~same]] = t
            left = left[same]
        return out

    def length(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words from two different places on."""
        shift = _SHIFT[i % SPAN, j % SPAN]
        out = self._walk(i, j, shift)
        far = np.flatnonzero(out == shift)
        x, y = i[far] + shift[far], j[far] + shift[far]
        x, y = (self.rank[p // SPAN * len(COVER) + _SLOT[p % SPAN]] for p in (x, y))
        low, high = np.minimum(x, y), np.maximum(x, y)
        level = np.frexp(high - low)[1] - 1
        for k in np.unique(level):
            some = level == k
            table, at = self.minima[k], far[some]
            out[at] += np.minimum(table[low[some]], table[high[some] - (1 << k)])
        return out


def _grids(n: np.ndarray, least: int, repeats: int):
    """Text, period and place of all grid points, in portions of bounded size."""
    most = np.where(n >= least, n // repeats, 0)
    doc = np.repeat(np.arange(len(n)), most)
    period = np.arange(len(doc)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = np.maximum(np.maximum(least - period, (repeats - 1) * period), 1)
    points = -(-(n[doc] - period) // step)
    ends, at = np.cumsum(points), 0
    while at < len(doc):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GRID_PLACES, "right"))
        some = slice(at, max(to, at + 1))
        at = some.stop
        number = np.arange(points[some].sum()) - np.repeat(np.cumsum(points[some]) - points[some], points[some])
        yield (
            np.repeat(doc[some], points[some]),
            np.repeat(period[some], points[some]),
            number * np.repeat(step[some], points[some]),
        )


def find_runs(words: np.ndarray, n: np.ndarray, least: int = LEAST, repeats: int = REPEATS):
    """``text, start, length, period`` of all runs, by text and start, of texts of ``n`` words each in ``words``."""
    empty = np.zeros(0, np.int64)
    if not len(words) or n.max() < least:
        return empty, empty, empty, empty
    number = np.unique(words, return_inverse=True)[1].astype(np.int64)
    # a mark before the first text and one after each
    first = np.cumsum(n) - n + np.arange(len(n)) + 1
    ids = np.empty(len(words) + len(n) + 1, np.int64)
    marks = np.concatenate(([0], first + n))
    ids[marks] = number.max() + 1 + np.arange(len(marks))
    ids[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(len(words))] = number
    right = left = None
    found = []
    for doc, period, place in _grids(n, least, repeats):
        x = first[doc] + place
        some = np.flatnonzero(ids[x] == ids[x + period])
        if not len(some):
            continue
        if right is None:
            right, left = Extensions(ids), Extensions(ids[::-1].copy())
        doc, p, x = doc[some], period[some], x[some]
        back = left.length(len(ids) - x, len(ids) - x - p)
        length = back + right.length(x, x + p) + p
        some = length >= np.maximum(least, repeats * p)
        found.append(np.stack((doc, x - back - first[doc], length, p))[:, some])
    if not found:
        return empty, empty, empty, empty
    doc, start, length, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, length, start, doc))
    doc, start, length, period = (v[order] for v in (doc, start, length, period))
    new = np.ones(len(doc), bool)  # the smallest period of each stretch
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    order = np.flatnonzero(new)
    order = order[np.lexsort((period[order], start[order], doc[order]))]
    return doc[order], start[order], length[order], period[order]


def _joined(w: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    word = np.flatnonzero(kept)
    size = w.end[word] - w.start[word]
    last = np.ones(len(word), bool)
    last[:-1] = w.doc[word[1:]] != w.doc[word[:-1]]
    wide = size + ~last
    ends = np.cumsum(wide)
    source = np.arange(ends[-1] if len(ends) else 0) + np.repeat(w.start[word] - (ends - wide), wide)
    data = np.append(w.data, np.uint8(32))[source]  # a last word may end the slice
    data[(ends - 1)[~last]] = 32
    offsets = np.zeros(len(w.n) + 1, np.int32)
    offsets[1:] = np.cumsum(np.bincount(w.doc[word], wide, len(w.n)))
    return pa.StringArray.from_buffers(len(w.n), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes()))


def collapse_runs(docs: DataFrame, least: int = LEAST, repeats: int = REPEATS) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row: the runs of its words (``start, length, period``, by
    start, then period), and the words left when each run keeps its first period only."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        w = Words(part.column("text"))
        doc, start, length, period = find_runs(w.hash, w.n, least, repeats)
        change = np.zeros(len(w.start) + 1, np.int64)
        np.add.at(change, w.first[doc] + start + period, 1)
        np.add.at(change, w.first[doc] + start + length, -1)
        offsets = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(w.n))))).astype(np.int32)
        fields = {"start": start, "length": length, "period": period}
        found = pa.StructArray.from_arrays([column(v) for v in fields.values()], list(fields))
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                "n_words": column(w.n.astype(np.int64)),
                "runs": pa.ListArray.from_arrays(pa.array(offsets), found),
                "collapsed": _joined(w, np.cumsum(change)[:-1] == 0),
            }
        )

    run = "struct<start: long, length: long, period: long>"
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_slices(columns, work, f"doc_id long, n_words long, runs array<{run}>, collapsed string")


def strongest(found) -> F.Column:
    """Of an array of runs the one with the greatest ratio of length to period, the first of equals."""
    nothing = F.lit(None).cast("struct<start: long, length: long, period: long>")
    better = lambda a, b: a.isNull() | (b["length"] * a["period"] > a["length"] * b["period"])
    return F.aggregate(found, nothing, lambda a, b: F.when(better(a, b), b).otherwise(a))


def with_cycles(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where a tenth of the texts turns periodic from some word on: runs to measure by.

    With ``h`` the crc32 of the ``doc_id``, texts with ``h % 10 = 0`` go on from word ``a = h div 10 % n`` with
    the words ``a`` to ``a + p``, over and over, for ``p = 1 + (n - a) div (3 + h div 10 % 8)``.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit("[^\\x20\\x09-\\x0D]+"), F.lit(0))
    planted = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    planted = planted.withColumn("n", F.expr("nullif(size(words), 0)"))
    planted = planted.withColumn("a", F.expr("CAST(g % n AS INT)"))
    planted = planted.withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    cycle = "flatten(array_repeat(slice(words, a + 1, p), CAST(ceil((n - a) / p) AS INT)))"
    text = F.expr(f"array_join(slice(concat(slice(words, 1, a), {cycle}), 1, n), ' ')")
    return planted.select("doc_id", F.when(F.col("n") > 0, text).otherwise(F.col("text")).alias("text"))
