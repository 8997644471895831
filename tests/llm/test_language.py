"""Cross-parsing against a search for the longest match, and held-out accuracy."""

import random
import zlib

import pytest

from tierkit.llm import language
from tierkit.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.01"


def phrases(text, sample):
    """Greedy parse into longest substrings of the sample, stretch by stretch; a byte that the
    sample lacks ends a phrase and is part of no match."""
    total = 0
    for at in range(0, len(text), language.STRETCH):
        part, first = text[at : at + language.STRETCH], 0
        total += 1
        for i in range(len(part)):
            if part[first : i + 1] not in sample:
                total += 1
                first = i if part[i : i + 1] in sample else i + 1
    return total


def test_phrases_are_longest_matches():
    rng = random.Random(1)
    some = lambda n, a: "".join(rng.choice(a) for _ in range(n)).encode()
    samples = {"x": [some(300, "abc "), some(200, "ab")], "y": [some(400, "bcd é")]}
    parser = language.Parser(samples)
    texts = [some(n, "abcd z") for n in (1, 5, 511, 512, 513, 3000)]
    joined = [b"\0".join(samples[lang]) for lang in parser.languages]
    assert parser.phrases(texts).tolist() == [[phrases(t, j) for j in joined] for t in texts]


def test_automaton_reads_exactly_the_substrings():
    text = b"abcbcabcab"
    moves = language.suffix_automaton(text)

    def reads(word):
        state = 0
        for b in word:
            if b not in moves[state]:
                return False
            state = moves[state][b]
        return True

    rng = random.Random(0)
    for _ in range(500):
        word = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 7)))
        assert reads(word) == (word in text)


def test_held_out_accuracy(spark):
    truth = {r["doc_id"]: (r["lang"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = QUERIES["op2_cross_parsing"](spark, SMALL).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == truth[r["doc_id"]][0] for r in held) >= 0.98 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)


@pytest.fixture(scope="module")
def parser(docs):
    return language.learn(docs((1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, "le chat", None), (4, None, "fr"), (5, "1 2", "it")))


def test_edges(docs, parser):
    frame = docs(None, "", "12 34 ²½ #", "THE DOG", "Die Katze!", "und " * 30_000, (9, "the cat", "de"), (9, "the cat", "de"), extra=("lang_pred",))
    got = sorted((r["doc_id"], r["lang_pred"], r["score"] > 0) for r in language.identify(frame, parser).collect())
    assert parser.languages == ["de", "en"]
    assert [g[1] for g in got] == ["und", "und", "und", "en", "de", "de", "en", "en"]
    assert [g[2] for g in got[:3]] == [False] * 3
    assert language.identify(docs("x").filter("false"), parser).count() == 0


def test_nothing_learned(docs):
    parser = language.learn(docs((1, "text", None), (2, None, "en")))
    assert [tuple(r) for r in language.identify(docs("some text"), parser).collect()] == [(0, "und", 0.0)]
