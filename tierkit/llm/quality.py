"""Quality rules: surface counts, and divergence of a text from the languages of the corpus.

A document first meets fixed rules on its length and its repeated passages. What passes is
compared with every language: the histogram of its character classes and the histogram of
the language's common words (words without a letter in front share one bin), both by Jensen-Shannon distance (the root of the divergence in
bits, 0 to 1). A document is kept if at least one language lies near in both. Each distance
counts only for texts long enough to have a histogram worth comparing.

References come from the corpus itself: per language, the class counts and the counts of the
common words over all documents that pass the fixed rules. A word is common in a language
when it makes up at least ``COMMON_SHARE`` of its words, so a language has at most
1 / ``COMMON_SHARE`` of them; a language has a reference when it holds at least
``REFERENCE_WORDS`` words, however little of the corpus that is. References go to the tasks in
blocks of about ``BLOCK_LANGUAGES``, one pass over the documents a block, so what is sent has a
fixed size and there is no limit on the number of languages.

Defined results: a null or empty text has no words and fails the fixed rules; a null language
adds to no reference but is compared like any other; a document whose language has no
reference is judged by the fixed rules alone; repeated rows are judged one by one; an
empty table gives no rows; columns other than ``doc_id``, ``text`` and ``lang`` are not looked
at, and ``filter_documents`` hands them through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.llm.shared import stored
from tierkit.llm.words import Counter64, Lookup, Words, column, map_slices, mix, runs, slices

WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
COMMON_SHARE = 0.001
LEAST_SHARE = 0.01  # of the SQL twin only, which agrees while every language has this share
REFERENCE_WORDS = 2000
BLOCK_LANGUAGES = 256
AT_ONCE = 16
CLASS_LIMIT = 0.30
WORD_LIMIT = 0.50
LEAST_CLASS_CHARS = 200
LEAST_COMMON_WORDS = 40

CLASSES = ("lower", "upper", "digit", "stop", "mark", "other")
_CLASS = np.full(256, len(CLASSES) - 1, np.uint8)
_CLASS[97:123] = 0
_CLASS[192:] = 0  # a letter outside ASCII counts once, by its lead byte
_CLASS[128:192] = 255
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[ord(c) for c in ".,;:!?'\"()-"]] = 3
_CLASS[[ord(c) for c in "#*$%&|<>"]] = 4
_CLASS[[32, 9, 10, 11, 12, 13]] = 255
_ALPHA = (_CLASS == 0) | (_CLASS == 1)
BARE = np.uint64(1)
_NONE = np.zeros(0, np.uint64)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_CARRIED = ("_tierkit_class", "_tierkit_word", "_tierkit_near", "_tierkit_met")


def _repeated_words(w: Words, hashes: np.ndarray) -> np.ndarray:
    """Words of each text inside windows that the text holds twice or more."""
    at, keys = w.windows(hashes, WINDOW)
    keys = mix(keys ^ mix(w.doc[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys)
    _, length = runs(keys[order])
    twice = at[order[np.repeat(length > 1, length)]]
    step = np.bincount(twice, minlength=len(hashes) + WINDOW) - np.bincount(
        twice + WINDOW, minlength=len(hashes) + WINDOW
    )
    covered = np.cumsum(step)[: len(hashes)] > 0
    return np.bincount(w.doc[covered], minlength=len(w.n))


def _repeated_lines(w: Words) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line."""
    stop = np.zeros(len(w.data) + 1, bool)
    stop[: len(w.data)] = w.data == 10
    # each text, also an empty one, ends a line at its end
    ends = np.sort(np.concatenate((np.flatnonzero(stop), w.bounds[1:])))
    doc = np.searchsorted(w.bounds[1:], ends)
    starts = np.concatenate(([0], ends[:-1]))
    starts = starts + ((starts < len(w.data)) & stop[starts] & (starts >= w.bounds[doc]) & (np.arange(len(ends)) > 0))
    starts = np.minimum(np.maximum(starts, w.bounds[doc]), ends)
    full = np.searchsorted(w.start, ends) > np.searchsorted(w.end, starts, "right")
    starts, ends, doc = starts[full], ends[full], doc[full]
    keys = mix(w.spans(starts, ends) ^ mix(doc.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(keys)
    keys = keys[order]
    again = np.zeros(len(keys), bool)
    again[1:] = keys[1:] == keys[:-1]
    return np.bincount(doc[order][again], minlength=len(w.n))


def _failed(w: Words, hashes: np.ndarray) -> np.ndarray:
    return (w.n < LEAST_WORDS) | (100 * _repeated_words(w, hashes) > MOST_REPEATED_PERCENT * w.n)


def _surface(w: Words, hashes: np.ndarray) -> dict[str, np.ndarray]:
    repeated = _repeated_words(w, hashes)
    return {
        "n_words": w.n,
        "word_chars": w.per_doc(~w.space & ((w.data & 0xC0) != 0x80)),
        "n_symbols": w.per_doc(_SYMBOL[w.data]),
        "n_dup_lines": _repeated_lines(w),
        "n_repeat_words": repeated,
        "base_failed": (w.n < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * w.n),
    }


def _bins(w: Words, hashes: np.ndarray) -> np.ndarray:
    """What the word histogram counts: words, and as one bin those that start with no letter."""
    return np.where(_ALPHA[w.data[w.start]], hashes, BARE) if len(hashes) else hashes


def _class_counts(w: Words) -> np.ndarray:
    kinds = _CLASS[w.data]
    rare = [w.per_doc(kinds == k) for k in range(1, len(CLASSES))]
    lower = w.per_doc(kinds != 255) - sum(rare)
    return np.stack([lower, *rare], axis=1)


def references(docs: DataFrame) -> Iterator[dict]:
    """Class and common-word histograms of each language, learned from all passing documents, in
    blocks of languages."""

    def count(batches):
        words, classes = {}, {}
        for part in slices(batches):
            w = Words(part.column("text"))
            hashes = w.hash
            passed = ~_failed(w, hashes)
            kinds = _class_counts(w)
            bins = _bins(w, hashes)
            for lang in part.column("lang").unique().to_pylist():
                if lang is None:
                    continue
                own = passed & (np.array(part.column("lang").to_pylist(), object) == lang)
                classes[lang] = classes.get(lang, 0) + kinds[own].sum(axis=0)
                full = words.setdefault(lang, Counter64()).add(bins[own[w.doc]])
                if full:
                    yield _counts(lang, *full)
        for lang, counter in words.items():
            yield _counts(lang, *counter.fold())
            yield _counts(lang, np.arange(len(CLASSES), dtype=np.uint64), classes[lang], "class")

    counted = (
        docs.select("text", "lang")
        .mapInArrow(count, "lang string, kind string, key long, n long")
        .groupBy("lang", "kind", "key")
        .agg(F.sum("n").alias("n"))
    )
    total = F.sum(F.when(F.col("kind") == "word", F.col("n")))
    # one row a language and key is never collected: only the common words of a block are
    counted = stored(counted, "counted")
    large = counted.groupBy("lang").agg(total.alias("total")).filter(F.col("total") >= REFERENCE_WORDS)
    common = counted.join(large, "lang").filter(
        (F.col("kind") == "class") | (F.col("n") >= COMMON_SHARE * F.col("total")) | (F.col("key") == int(BARE))
    )
    common = stored(common, "common")
    blocks = -(-common.select("lang").distinct().count() // BLOCK_LANGUAGES)
    for block in range(blocks):
        own = common.filter(F.pmod(F.xxhash64("lang"), F.lit(blocks)) == block)
        found = {}
        for r in own.toLocalIterator():
            ref = found.setdefault(r["lang"], {"total": r["total"], "words": {}, "class": np.zeros(len(CLASSES))})
            if r["kind"] == "class":
                ref["class"][r["key"]] = r["n"]
            else:
                ref["words"][r["key"]] = r["n"]
        if not found:
            continue
        yield {
            lang: {
                "class": ref["class"] / ref["class"].sum(),
                "keys": (keys := np.array(sorted(ref["words"]), np.int64).view(np.uint64)),
                "words": np.array([*(ref["words"][int(k)] for k in keys.view(np.int64))]) / ref["total"],
            }
            for lang, ref in sorted(found.items())
        }


def _counts(lang: str, keys: np.ndarray, counts: np.ndarray, kind: str = "word") -> pa.RecordBatch:
    n = len(keys)
    return pa.RecordBatch.from_pydict(
        {
            "lang": pa.array([lang] * n, pa.string()),
            "kind": pa.array([kind] * n, pa.string()),
            "key": column(keys),
            "n": column(np.asarray(counts, np.int64)),
        }
    )


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of each row of ``p`` from ``q``."""
    m = (p + q) / 2

    def against(x):
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(x > 0, x * np.log2(x / m), 0.0).sum(axis=1)

    return np.sqrt(np.maximum((against(p) + against(np.broadcast_to(q, p.shape))) / 2, 0))


def _nearest(w: Words, hashes: np.ndarray, refs: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distances from the nearest language, and whether one is near in both."""
    docs, kinds = len(w.n), _class_counts(w)
    chars, n = kinds.sum(axis=1), np.maximum(w.n, 1)
    best_class, best_word, near = np.ones(docs), np.ones(docs), np.zeros(docs, bool)
    bins, every = _bins(w, hashes), list(refs.values())
    rest = lambda x: np.concatenate((x, 1 - x.sum(axis=-1, keepdims=True)), axis=-1)
    for first in range(0, len(every), AT_ONCE):
        some = every[first : first + AT_ONCE]
        lookup = Lookup(np.unique(np.concatenate([ref["keys"] for ref in some])))
        at, place = lookup.find(bins)
        common = np.bincount(w.doc[at] * len(lookup.keys) + place, minlength=docs * len(lookup.keys))
        common = common.reshape(docs, len(lookup.keys)) / n[:, None]
        for ref in some:
            by_class = divergence(kinds / np.maximum(chars, 1)[:, None], ref["class"])
            by_word = divergence(rest(common[:, np.searchsorted(lookup.keys, ref["keys"])]), rest(ref["words"]))
            near |= ((by_class <= CLASS_LIMIT) | (chars < LEAST_CLASS_CHARS)) & (
                (by_word <= WORD_LIMIT) | (w.n < LEAST_COMMON_WORDS)
            )
            best_class, best_word = np.minimum(best_class, by_class), np.minimum(best_word, by_word)
    return best_class, best_word, near


def _compared(part: pa.RecordBatch, w: Words, hashes: np.ndarray, refs: dict) -> list[np.ndarray]:
    """``_nearest`` over this block and those before, and whether a document's own language was among them."""
    values = [*_nearest(w, hashes, refs), pc.is_in(part.column("lang"), pa.array(list(refs), pa.string()))]
    values[3] = values[3].to_numpy(zero_copy_only=False)
    if _CARRIED[0] in part.schema.names:
        before = [part.column(c).to_numpy(zero_copy_only=False) for c in _CARRIED]
        join = (np.minimum, np.minimum, np.logical_or, np.logical_or)
        values = [f(a, b) for f, a, b in zip(join, before, values)]
    return values


def _near(part: pa.RecordBatch, near: np.ndarray, met: np.ndarray, refs: dict) -> np.ndarray:
    """The verdict on likeness, once all blocks are compared."""
    named = part.column("lang").is_valid().to_numpy(zero_copy_only=False)
    return near | (named & ~met) | (not refs)


def _passes(docs: DataFrame, refs: Iterator[dict]):
    """``docs`` compared with all blocks but the last, and the last one, sent to the tasks."""
    shipped = [docs.sparkSession.sparkContext.broadcast(block) for block in refs]
    shipped = shipped or [docs.sparkSession.sparkContext.broadcast({})]
    for block in shipped[:-1]:
        docs = _carrying(docs, block)
    return docs, shipped[-1]


def _carrying(docs: DataFrame, block) -> DataFrame:
    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        w = Words(part.column("text"))
        values = _compared(part, w, w.hash, block.value)
        own = [c for c in part.schema.names if c not in _CARRIED]
        return pa.RecordBatch.from_arrays([*(part.column(c) for c in own), *map(column, values)], [*own, *_CARRIED])

    schema = docs.drop(*_CARRIED).schema
    for name, kind in zip(_CARRIED, ("double", "double", "boolean", "boolean")):
        schema = schema.add(name, kind)
    return map_slices(docs, work, schema)


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, surface counts, both distances and the verdict ``kept`` of every document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    docs, last = _passes(docs, references(docs))

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        w = Words(part.column("text"))
        hashes = w.hash
        out = _surface(w, hashes)
        out["class_distance"], out["word_distance"], near, met = _compared(part, w, hashes, last.value)
        out["kept"] = ~out["base_failed"] & _near(part, near, met, last.value)
        return pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), **{k: column(v) for k, v in out.items()}})

    return map_slices(
        docs,
        work,
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, class_distance double, word_distance double, kept boolean",
    )


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns, without a shuffle."""
    schema = docs.schema
    docs, last = _passes(docs, references(docs))

    def keep(batches):
        for part in slices(batches):
            w = Words(part.column("text"))
            hashes = w.hash
            near, met = _compared(part, w, hashes, last.value)[2:]
            kept = part.filter(pa.array(~_failed(w, hashes) & _near(part, near, met, last.value)))
            yield kept.select(schema.names)

    return docs.mapInArrow(keep, schema)
