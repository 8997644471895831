"""Quality rules against a word-by-word count, and the verdicts."""

import random
import re

import numpy as np
import pytest

from tierkit.llm import quality

SURFACE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def surface(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed)


@pytest.fixture(scope="module")
def some(docs):
    rows = ["", None, "  \n\t ", "one", "a b c d e f g h a b c d e f g h", "é ß # * |\n\nx\nx\nx \n\n", "x" * 50_000]
    rows += ["w " * 3000, "\n".join(["same line here"] * 30), " ".join(str(i) for i in range(200)), "|||\n|||\n \n \n", "a\n"]
    rows += ["a b c d e f g h i a b c d e f g h j " + "k " * 9, "\x1cx\x85y z", "\nq\nq", "q\r\nq\r\nq"]
    return docs(*rows, *rows[3:5], extra=("n_words", "kept"))


def test_surface_counts(some):
    text = {(r["doc_id"], r["text"]) for r in some.collect()}
    got = sorted(quality.judge(some).collect(), key=lambda r: r["doc_id"])
    assert [tuple(r[c] for c in SURFACE) for r in got] == [surface(t) for _, t in sorted(text, key=lambda x: x[0])]
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_unlike_texts_go_and_clean_ones_stay(docs, prose):
    clean = [" ".join(prose(i, 200)) for i in range(40)]
    marks = [" ".join(w + "***" for w in prose(100 + i, 200)) for i in range(3)]
    table = [" | ".join(f"x{i}{w}" for w in prose(200 + i, 200) if w[0] == "w") for i in range(3)]
    short = [" ".join(prose(300, 25))]
    frame = docs(*clean, *marks, *table, *short, (99, clean[0], None, None))
    kept = {r["doc_id"] for r in quality.judge(frame).filter("kept").collect()}
    assert kept == {*range(40), 46, 99}
    left = quality.filter_documents(frame)
    assert left.columns == frame.columns and {r["doc_id"] for r in left.collect()} == kept


def test_languages_with_a_small_share_are_judged_by_their_own_words(docs, monkeypatch):
    """One language holds over 99 % of the words; a second has a reference, a third too few words for one."""
    rng = random.Random(4)

    def other(stem, n=150):
        return [stem + (rng.choice("abcdefghij") if rng.random() < 0.65 else f"r{rng.randrange(10**6)}") for _ in range(n)]

    rows = [(i, " ".join(other("e", 2000)), "en", "s0") for i in range(250)]
    rows += [(1000 + i, " ".join(other("q")), "qq", "s0") for i in range(25)]
    rows += [(2000 + i, " ".join(other("z")), "zz", "s0") for i in range(3)]
    rows += [(3000, " ".join(w + "***" for w in other("q")), "qq", "s0"), (3001, " ".join(other("q")), None, "s0")]
    rows += [(3002, " ".join(other("z")), None, "s0"), (3003, "too short", "zz", "s0")]
    frame = docs(*rows)
    want = {i for i, *_ in rows} - {3000, 3002, 3003}
    one = sorted(map(tuple, quality.judge(frame).collect()))
    assert {r[0] for r in one if r[-1]} == want
    assert {r["doc_id"] for r in quality.filter_documents(frame).collect()} == want
    monkeypatch.setattr(quality, "BLOCK_LANGUAGES", 1)
    assert sorted(map(tuple, quality.judge(frame).collect())) == one
    left = quality.filter_documents(frame)
    assert left.columns == frame.columns and {r["doc_id"] for r in left.collect()} == want


def test_empty_table_and_no_language(docs):
    none = docs("x").filter("false")
    assert quality.judge(none).count() == 0 and quality.filter_documents(none).count() == 0
    alone = docs((1, " ".join(f"w{i}" for i in range(50)), None, None))
    assert quality.judge(alone).first()["kept"]


def test_divergence_is_a_bounded_distance():
    p, q = np.array([[0.5, 0.5, 0.0], [0, 0, 1.0]]), np.array([0.5, 0.5, 0.0])
    assert quality.divergence(p, q).round(9).tolist() == [0.0, 1.0]
