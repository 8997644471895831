"""Words of whole texts as numpy arrays, for the operators that run inside Arrow batches.

A word is a run of bytes other than space and ``\\x09-\\x0D`` in the UTF-8 text; these bytes
never occur inside a longer UTF-8 sequence, so bytes and code points agree on the words.
Batches are cut into slices of about a megabyte of text, so memory follows the longest
text, not the number of rows. Null texts count as empty.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

SLICE_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_KEYS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, grown on demand."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            n = max(n, 2 * SLICE_BYTES)
            cls.up, cls.down = (np.full(n, b, np.uint64) for b in (np.uint64(_BASE), _INVERSE))
            for table in (cls.up, cls.down):
                table[0] = 1
                np.multiply.accumulate(table, out=table)
        return cls.up, cls.down


class Words:
    """Words of the texts of one slice.

    ``start``/``end`` are byte offsets into ``data``, ``n`` the words of each text, ``doc`` the
    text of each word, ``first`` the index of each text's first word, ``hash`` 64 bits a word.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        size = int(bounds[-1] - bounds[0])
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[bounds[0] : bounds[-1]] if size else np.zeros(0, np.uint8)
        self.data = LOWER[data] if lower else data
        self.bounds = bounds - bounds[0]
        self.space = SPACE[data]
        edge = np.zeros(size + 1, bool)
        edge[self.bounds] = True
        inside = ~self.space
        before = np.ones(size, bool)
        before[1:] = self.space[:-1]
        after = np.ones(size, bool)
        after[:-1] = self.space[1:]
        self.start = np.flatnonzero(inside & (before | edge[:-1]))
        self.end = np.flatnonzero(inside & (after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, self.bounds)
        self.n = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(self.n)), self.n)
        self._sums = None

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes of each span."""
        up, down = _Powers.upto(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, np.uint64)
            np.cumsum(BYTE_KEYS[self.data] * up[: len(self.data)], out=self._sums[1:])
        return mix((self._sums[end] - self._sums[start]) * down[start] + (end - start).astype(np.uint64))

    def phrases(self, hashes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words of each range."""
        up, down = _Powers.upto(len(hashes) + 1)
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
        return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))

    @property
    def hash(self) -> np.ndarray:
        return self.spans(self.start, self.end)

    def windows(self, hashes: np.ndarray, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``size`` words inside one text."""
        n = len(hashes) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        total = np.full(n, seed, np.uint64)
        for j in range(size):
            total *= _STEP
            total += hashes[j : j + n]
        at = np.flatnonzero(self.doc[:n] == self.doc[size - 1 :])
        return at, mix(total[at])

    def per_doc(self, mask: np.ndarray) -> np.ndarray:
        """Number of set bytes of each text."""
        return np.diff(np.searchsorted(np.flatnonzero(mask), self.bounds))


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the runs of equal values in a sorted array."""
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return start, np.diff(np.concatenate((start, [len(values)])))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches after about ``SLICE_BYTES`` of text, at least one row each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(column).cast(pa.large_binary())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(bounds, bounds[at] + SLICE_BYTES, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def packed(df, column_name: str = "text"):
    """``df`` with a text column compressed, for shuffles that move every text."""

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = part.column(column_name).cast(pa.large_binary()).to_pylist()
        small = pa.array([None if t is None else zlib.compress(t, 4) for t in texts], pa.binary())
        return part.set_column(part.schema.get_field_index(column_name), column_name, small)

    kinds = StructType([StructField(f.name, BinaryType() if f.name == column_name else f.dataType) for f in df.schema])
    return map_slices(df, work, kinds, column_name)


def unpacked_array(values: pa.Array) -> pa.Array:
    texts = [None if v is None else zlib.decompress(v) for v in values.to_pylist()]
    return pa.array(texts, pa.large_binary())


def unpacked_slices(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
    """Batches cut after about ``SLICE_BYTES`` of unpacked text in ``columns``, at least one row each, with
    these texts. Packed bytes say little about it: repeated lines shrink to a hundredth and less."""
    for batch in batches:
        values = [batch.column(c) for c in columns]
        at, size, texts = 0, 0, [[] for _ in columns]
        for row in range(batch.num_rows):
            for packed_ones, own in zip(values, texts):
                value = packed_ones[row].as_py()
                own.append(None if value is None else zlib.decompress(value))
                size += len(own[-1] or b"")
            if size >= SLICE_BYTES or row + 1 == batch.num_rows:
                yield batch.slice(at, row + 1 - at), [pa.array(own, pa.large_binary()) for own in texts]
                at, size, texts = row + 1, 0, [[] for _ in columns]


def unpacked(df, column_name: str = "text"):
    """The opposite of ``packed``."""

    def work(batches):
        for part, (texts,) in unpacked_slices(batches, column_name):
            texts = texts.cast(pa.large_string()).cast(pa.string())
            yield part.set_column(part.schema.get_field_index(column_name), column_name, texts)

    kinds = StructType([StructField(f.name, StringType() if f.name == column_name else f.dataType) for f in df.schema])
    return df.mapInArrow(work, kinds)


def map_slices(df, work: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema, column: str = "text"):
    """``work`` over every slice of a DataFrame."""

    def run(batches):
        for part in slices(batches, column):
            out = work(part)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


class Counter64:
    """Counts of 64-bit keys in bounded memory: full tables are given out, to be summed later."""

    def __init__(self, most: int = 1 << 20):
        self.most, self.parts, self.size = most, [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray | None = None) -> tuple | None:
        start, length = runs(order := np.sort(keys)) if counts is None else (None, None)
        part = (order[start], length) if counts is None else (keys, counts)
        self.parts.append(part)
        self.size += len(part[0])
        if self.size > self.most:
            folded = self.fold()
            if len(folded[0]) > self.most // 2:
                return folded
            self.parts, self.size = [folded], len(folded[0])
        return None

    def fold(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys, counts = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.size = [], 0
        order = np.argsort(keys)
        start, _ = runs(keys[order])
        return keys[order][start], np.add.reduceat(counts[order], start) if len(start) else counts


class Lookup:
    """Finds 64-bit hashes in a sorted table; most misses cost one look at a small bitmap."""

    def __init__(self, keys: np.ndarray, spare_bits: int = 5):
        self.keys = np.sort(keys)
        bits = max(12, int(len(keys)).bit_length() + spare_bits)
        self.mask = np.uint64((1 << bits) - 1)
        self.maybe = np.zeros(1 << bits, bool)
        self.maybe[keys & self.mask] = True

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices of the hashes found, and their places in ``keys``."""
        at = np.flatnonzero(self.maybe[hashes & self.mask])
        if not len(at):
            return at, at
        place = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        found = self.keys[place] == hashes[at]
        return at[found], place[found]


def column(values: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, kind)
