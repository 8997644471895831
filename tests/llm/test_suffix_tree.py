"""Scores against word counts and against a tree walked byte by byte."""

import math
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tierkit.llm import suffix_tree
from tierkit.llm.words import Words


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


@pytest.fixture(scope="module")
def rows(docs):
    words = "the of and to in xylophone zebra é straße quick brown".split()
    texts = [" ".join(words[(i * k) % 11] for k in range(1, 5 + i % 9)) for i in range(150)]
    return [*enumerate(texts), (900, None), (901, ""), (902, "The\nTHE\tthe"), (903, "unseen€ words"), (None, "the of"), (904, "the of " * 9000), (7, texts[7])]


def test_base_scores(docs, rows):
    held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows}
    counts = Counter(t for d, text in rows if not held[d] for t in tokens(text))
    total, kinds = sum(counts.values()), len(counts)
    want = []
    for d, text in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in own)
        want.append((d, held[d], len(own), sum(counts[t] > 0 for t in own), total, round(base, 6)))
    frame = docs(*rows, extra=("score", "n", "word"))
    got = suffix_tree.score(frame).collect()
    assert sorted(((*tuple(r)[:5], round(r["base_score"], 6)) for r in got), key=str) == sorted(want, key=str)
    assert all(r["score"] < 0 for r in got)


def test_rare_words_are_joined(docs, rows, monkeypatch):
    before = {(r["doc_id"], r["n_known"], round(r["base_score"], 6)) for r in suffix_tree.score(docs(*rows)).collect()}
    monkeypatch.setattr(suffix_tree, "HEAD_SHARE", 0.05)
    assert {(r["doc_id"], r["n_known"], round(r["base_score"], 6)) for r in suffix_tree.score(docs(*rows)).collect()} == before


def walk(tree, text):
    """Score by following the automaton one symbol at a time."""
    data = " ".join(t for t in tokens(text) if t is not None).encode()
    state, total = 0, 0.0
    for symbol in [suffix_tree.START] * suffix_tree.DEPTH + list(data) + [suffix_tree.END]:
        c = tree.column[symbol]
        total += 0 if symbol == suffix_tree.START else float(tree.score[state, c])
        state = tree.next[state, c]
    return total


def test_lanes_follow_the_automaton(docs, rows):
    tree = suffix_tree.fit(docs(*rows))
    texts = [t for _, t in rows]
    got = tree.scores(Words(pa.array(texts), lower=True))
    assert np.allclose(got, [walk(tree, t) for t in texts], rtol=1e-4)


def test_distributions_sum_to_one(docs, rows):
    tree = suffix_tree.fit(docs(*rows))
    seen = [c for s, c in enumerate(tree.column[:257]) if c < tree.width - 1]
    p = 10.0 ** tree.score.astype(float)
    unseen = 257 - len(seen)
    assert np.allclose(p[:, seen].sum(axis=1) + unseen * p[:, tree.width - 1], 1, atol=1e-3)


def test_longer_contexts_help(docs, prose, monkeypatch):
    texts = [" ".join(w[:3] for w in prose(i, 60)) for i in range(200)]
    others = Words(pa.array([" ".join(w[:3] for w in prose(i, 60)) for i in range(900, 920)]))
    full = suffix_tree.fit(docs(*texts))
    monkeypatch.setattr(suffix_tree, "DIVERGENCE", 1e9)
    root = suffix_tree.fit(docs(*texts))
    assert len(root.score) == 1 < len(full.score)
    assert (full.scores(others) > 0.75 * root.scores(others)).all()
    backwards = Words(pa.array(["".join(reversed(t)) for t in texts[:20]]))
    assert full.scores(backwards).sum() < full.scores(Words(pa.array(texts[:20]))).sum()


def test_tree_is_built_in_little_memory():
    """The driver holds the distributions and the scores, and of all else a few rows at a time."""
    rng = np.random.default_rng(3)
    text = rng.integers(97, 137, 60_000)
    entries = []
    for d in range(suffix_tree.DEPTH + 1):
        runs = np.zeros(len(text) - d, np.int64)
        for j in range(d + 1):
            runs = (runs << suffix_tree.BITS) | text[j : j + len(runs)]
        runs, n = np.unique(runs, return_counts=True)
        entries.append((np.full(len(runs), d), runs >> suffix_tree.BITS, runs & 511, n))
    columns = [np.concatenate(x) for x in zip(*entries)]
    tracemalloc.start()
    tree = suffix_tree.Tree(*columns)
    kept, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(tree.score) > 50_000
    assert peak < 2.5 * kept


def test_empty_tables(docs):
    assert suffix_tree.score(docs("x").filter("false")).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    row = suffix_tree.score(docs((held, "ab"))).first()
    assert (row["train_tokens"], row["n_known"], row["base_score"]) == (0, 0, 0.0)
    assert round(row["score"], 4) == round(-3 * math.log10(257), 4)
