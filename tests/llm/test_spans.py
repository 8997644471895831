"""Repeated spans against all windows."""

import random
import re

import pytest

from tierkit.llm import spans


def brute(rows, window):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            if d is not None:
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone.update(range(i, i + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone).encode()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    some = lambda n, v=5000: [f"w{rng.randrange(v)}" for _ in range(n)]
    passages = [some(rng.randrange(10, 60)) for _ in range(12)]
    texts = [None, "", "few words", " ".join(["again"] * 400), " ".join(["again"] * 13), " ".join(some(20_000))]
    for _ in range(80):
        parts = [some(rng.randrange(0, 30)) for _ in range(3)]
        inside = [rng.choice(passages) for _ in range(2)]
        cut = inside[0][rng.randrange(0, 8) : len(inside[0]) - rng.randrange(0, 8)]
        texts.append(rng.choice([" ", "\n", "  \t"]).join([*parts[0], *cut, *parts[1], *inside[1], *parts[2]]))
    texts += texts[10:40]
    texts += [" ".join(some(60, 3)) for _ in range(20)]  # few different words: many branches
    out = list(enumerate(texts))
    rng.shuffle(out)
    return [*out, (None, texts[12]), (3, texts[3]), (20, texts[21])]


@pytest.mark.parametrize("bits", [15, 27])
@pytest.mark.parametrize("window", [5, 13])
def test_removed_words(docs, rows, window, bits, monkeypatch):
    """With the usual bitmap, and with one so small that most of its bits are set."""
    monkeypatch.setattr(spans, "BITMAP", 1 << bits)
    frame = docs(*rows, extra=("anchor", "spans", "kept"))
    got = spans.remove_repeats(frame, window)
    assert sorted(((r[0], r[1], r[2], bytes(r[3])) for r in got.collect()), key=str) == brute(rows, window)


def test_spans_carry_source_coordinates(docs, prose):
    shared = prose(1, 80)
    texts = [" ".join([*prose(10 + d, 20), *shared, *prose(20 + d, 20)]) for d in range(3)]
    found = sorted(tuple(r)[2:] + (r["doc_id"],) for r in spans.repeated_spans(docs(*texts)).collect())
    assert [(start, words, first, last) for start, words, first, last, _ in found] == [(20, 80, 0, 2)] * 3
    assert {r["doc_id"] for r in spans.repeated_spans(docs(*texts), later_only=True).collect()} == {1, 2}


def test_empty_table(docs):
    none = docs("x").filter("false")
    assert spans.remove_repeats(none).count() == 0 and spans.repeated_spans(none).count() == 0
