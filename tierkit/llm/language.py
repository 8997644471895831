"""Language identification by cross-parsing entropy.

Each language has a suffix automaton of a sample of its labelled text. A text is parsed
against it from left to right into phrases, each the longest match that the automaton allows
from there; the fewer phrases a text needs, the closer it is to the sample. Phrases are
weighed by the logarithm of the sample's length, which makes their number an estimate of the
cross entropy, and the language with the least wins; ties go to the name that sorts first.

The samples are bounded: of every language ``SAMPLE_DOCS`` documents, those of least hash, up to
``SAMPLE_CHARS`` characters each, and ``SAMPLE_BYTES`` bytes in all, or an even part of ``TOTAL_BYTES`` if
there are many languages. So the automata that are sent to the tasks have a fixed size.

Texts are compared in lower case with every run of other characters than letters as one
space. They are parsed whole, in stretches of ``STRETCH`` bytes at whose ends a phrase ends
too, for all languages alike; a byte that the sample lacks ends a phrase and begins the next.
The stretches of many texts advance together.

Defined results: a null text, an empty one and one without a letter are ``und`` with score 0;
with no labelled text at all everything is ``und``; a label that is null is not learned from;
rows that repeat are learned from and judged one by one; an empty table gives no rows; only
``text`` is looked at for a prediction, and other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierkit.llm.words import column, map_slices

SAMPLE_DOCS = 64
SAMPLE_CHARS = 2000
SAMPLE_BYTES = 32_000
TOTAL_BYTES = 256_000
STRETCH = 512
UNKNOWN = "und"
_OTHER = re.compile(r"[\W\d_]+")


def cleaned(text: str | None) -> bytes:
    """Letters in lower case, everything else as single spaces; nothing if there is no letter."""
    out = _OTHER.sub(" ", text.lower()).strip() if text else ""
    return out.encode() if any(c.isalpha() for c in out) else b""


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that reads every substring."""
    moves, link, length = [{}], [-1], [0]
    last = 0
    for byte in text:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and byte not in moves[at]:
            moves[at][byte] = state
            at = link[at]
        if at >= 0:
            target = moves[at][byte]
            if length[target] == length[at] + 1:
                link[state] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                length.append(length[at] + 1)
                link.append(link[target])
                link[target] = link[state] = copy
                while at >= 0 and moves[at].get(byte) == target:
                    moves[at][byte] = copy
                    at = link[at]
        last = state
    return moves


class Parser:
    """Parses texts against one automaton a language, as dense tables."""

    def __init__(self, samples: dict[str, list[bytes]]):
        self.languages = sorted(lang for lang, texts in samples.items() if any(texts))
        share = min(SAMPLE_BYTES, TOTAL_BYTES // max(len(self.languages), 1))
        joined = {lang: b"\0".join(samples[lang])[:share] for lang in self.languages}
        known = sorted(set(b"".join(joined.values())) - {0})
        # class 0 pads a stretch, class 1 is every byte that no sample has
        self.classes = np.ones(256, np.int32)
        self.classes[known] = np.arange(2, len(known) + 2)
        self.width = len(known) + 2
        self.tables, self.weight = [], []
        for lang in self.languages:
            moves = suffix_automaton(joined[lang])
            table = np.full((len(moves), self.width), -1, np.int32)
            for state, out in enumerate(moves):
                for byte, target in out.items():
                    if byte:
                        table[state, self.classes[byte]] = target
            # no way on: the phrase ends, and the next one begins with this byte
            table = np.where(table >= 0, table * 2, np.maximum(table[0], 0) * 2 + 1).astype(np.int32)
            table[:, 0] = np.arange(len(moves)) * 2
            self.tables.append(table.reshape(-1))
            self.weight.append(np.log2(len(joined[lang]) + 2))

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Number of phrases of each text (rows) in each language (columns)."""
        size = np.array([len(t) for t in texts], np.int64)
        pieces = -(-size // STRETCH)
        owner = np.repeat(np.arange(len(texts)), pieces)
        first = np.concatenate(([0], np.cumsum(pieces)))
        data = self.classes[np.frombuffer(b"".join(texts), np.uint8)]
        lane = np.repeat(np.arange(len(owner)), np.minimum(size[owner] - (np.arange(len(owner)) - first[owner]) * STRETCH, STRETCH))
        within = np.arange(len(data)) - np.repeat(np.cumsum(size) - size, size)
        grid = np.zeros((STRETCH, len(owner)), np.int32)
        grid[within % STRETCH, lane] = data
        out = np.zeros((len(texts), len(self.languages)))
        for k, table in enumerate(self.tables):
            state, ends = np.zeros(len(owner), np.int32), np.ones(len(owner), np.int32)
            for row in grid:
                moved = table[state * self.width + row]
                ends += moved & 1
                state = moved >> 1
            out[:, k] = np.bincount(owner, ends, len(texts))
        return out

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        some = [i for i, t in enumerate(texts) if t]
        names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not some or not self.languages:
            return names, score
        cost = self.phrases([texts[i] for i in some]) * np.array(self.weight)
        best = cost.argmin(axis=1)
        least = cost.min(axis=1)
        cost[np.arange(len(some)), best] = np.inf
        for i, b in zip(some, best):
            names[i] = self.languages[b]
        score[some] = 1 - least / cost.min(axis=1)
        return names, score


def learn(labelled: DataFrame) -> Parser:
    """Automata of a bounded sample of ``labelled(doc_id, text, lang)``."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id", F.xxhash64("text"))
    rows = (
        labelled.filter("lang IS NOT NULL AND text IS NOT NULL")
        .select("doc_id", "lang", F.substring("text", 1, SAMPLE_CHARS).alias("text"))
        .withColumn("_n", F.row_number().over(order))
        .filter(F.col("_n") <= SAMPLE_DOCS)
        .orderBy("lang", "_n")
        .collect()
    )
    samples: dict[str, list[bytes]] = {}
    for r in rows:
        samples.setdefault(r["lang"], []).append(cleaned(r["text"]))
    return Parser(samples)


def identify(docs: DataFrame, parser: Parser) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(parser)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        names, score = shipped.value.predict([cleaned(t) for t in part.column("text").to_pylist()])
        return pa.RecordBatch.from_pydict(
            {"doc_id": part.column("doc_id"), "lang_pred": pa.array(names, pa.string()), "score": column(score)}
        )

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_slices(docs, work, "doc_id long, lang_pred string, score double")
