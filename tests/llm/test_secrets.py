"""Secrets: the patterns, the field's decoding against all labellings, and what it finds."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tierkit.llm import secrets
from tierkit.llm.words import Words


def brute(text):
    text, found = text or "", []
    key = "|".join("".join(f"[{c}{c.upper()}]" for c in n) for n in ("password", "passwd", "secret", "token"))
    key = f"({key}|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    for m in re.finditer(key + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        found += [(m.start(), 0, m.end())] if len(m[2]) >= 8 else []
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


HEX = "0b96a8c8d79c4a5085c919698889f59b72ab7bb6"
EDGES = [
    *(None, "", "é€ token = \"" + HEX + "\" ß", "TOKEN:abcdefgh", "token=short", "token = secret: abcdefghij"),
    *("password=password=abcdefgh", "api_key='k-1.2_3/4+5='", "apikey   :   aaaaaaaa", "toKen=Kabcdefgh"),
    *("AKIA1234567890AB", "AKIA12345", "xAKIAAKIA1234567890", "f" * 31, "f" * 32, "g" + "a" * 40 + "g", "toſecret=abcdefgh"),
    *("x" * 90_000 + " token=abcdefghi " + "9" * 90_000, "secret = " * 50, "no secret here"),
]


@pytest.fixture(scope="module")
def learned(docs):
    rng = random.Random(0)
    word = lambda: "".join(rng.choice("abcdeinorst") for _ in range(rng.randrange(2, 9)))
    rows = []
    for i in range(240):
        own = [word() for _ in range(30)]
        if i % 3 == 0:
            own[10:10] = ["token", "=", f'"{rng.randrange(16**40):040x}"']
        if i % 3 == 1:
            own[5:5] = [rng.choice(["192.168.100.20", f"{rng.randrange(10**15, 10**16)}", "someone.else@mail.example.com", "2024-05-06T10:11:12"])]
        rows.append(" ".join(own))
    return secrets.learn(docs(*rows))


def test_patterns(docs, learned):
    frame = docs(*EDGES, (500, EDGES[2]), (500, EDGES[2]), extra=("base", "spans"))
    for field in (secrets.Field(), learned):
        got = sorted((r["doc_id"], r["base"], r["spans"]) for r in secrets.scan(frame, field).collect())
        assert [(d, b) for d, b, _ in got] == [(i, brute(t)) for i, t in enumerate(EDGES)] + [(500, brute(EDGES[2]))] * 2
        for _, base, spans in got:
            assert set(filter(None, base.split(","))) <= set(spans.split(","))
            starts = [int(s.split(":")[1]) for s in spans.split(",") if s]
            assert starts == sorted(starts)
    counts = {r["doc_id"]: (r["n_assign"], r["n_access"], r["n_hex"]) for r in secrets.scan(frame, learned).collect()}
    assert counts[2] == (1, 0, 1) and counts[10] == (0, 1, 0)


def test_field_finds_other_keys_and_leaves_other_words(docs, learned):
    yes = ["the key ghp_a8Bd93kfLs02mXz81LqPoT7wYvU3nR5e is here", "bearer eyJhbGciOiJIUzI1.eyJzdWIiOiIxMjM0.SflKxwRJSMeKKF2QT4 ok"]
    no = ["call +1 (743) 555-3824 or 4465758382889437", "see 192.168.100.25 and me.12@mail.example.com", "thesewordsareverylonganyway and others"]
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(docs(*yes, *no), learned).collect()}
    assert got[0] == "crf:8:44" and got[1] == "crf:7:59"
    assert [got[i] for i in (2, 3, 4)] == [""] * 3


def test_traits_are_those_of_the_whole_text():
    """Code after more than 64 Ki characters of prose, and prose after as much code."""
    prose, code = "plain words é " * 6000, "{ a = b ; } " * 20_000
    at = secrets._INDEX["code_text"]
    texts = [f"key1234567 {prose}{code}", f"{code[:70_000]} key1234567 {prose * 20}", "key1234567 = <b>;", "key1234567"]
    w = Words(pa.array(texts))
    found = {d: rows[:, at].tolist() for d, rows, _ in secrets._runs(w, secrets.candidate_words(w))}
    assert found == {d: [50 * len(re.findall("[{};=<>]", t)) > len(t)] for d, t in enumerate(texts)}
    assert [found[d] for d in range(4)] == [[1], [0], [1], [0]]


def test_viterbi_is_the_best_of_all_labellings(learned):
    rng = np.random.default_rng(1)
    for n in (1, 2, 4, 5):
        rows = (rng.random((n, len(secrets.FEATURES))) < 0.3).astype(np.float32)
        score = rows @ learned.emit

        def value(labels):
            ends = [0, *labels]
            return sum(score[i, y] for i, y in enumerate(labels)) + sum(learned.move[a, b] for a, b in zip(ends, [*labels, 0]))

        best = max(itertools.product(range(3), repeat=n), key=value)
        assert value(learned.decode(rows)) == pytest.approx(value(best))


def test_nothing_to_learn_from(docs):
    assert not secrets.learn(docs("plain words only")).trained
    assert secrets.scan(docs("x").filter("false")).count() == 0


def test_every_word_may_be_a_secret(docs):
    """A short word without a digit, by its neighbour alone."""
    field = secrets.Field()
    field.emit[secrets._INDEX["name_before"], 1], field.emit[secrets._INDEX["bias"], 1] = 9, -5
    field.emit[:, 2], field.trained = -5, True
    got = {r["doc_id"]: r["spans"] for r in secrets.scan(docs("my pass abcd é", "no more", "pwd é", "key"), field).collect()}
    assert got == {0: "crf:8:12", 1: "", 2: "crf:4:5", 3: ""}


def test_shapes_of_many_words_are_those_of_each():
    rng = random.Random(5)
    marks = "aZ09éÄ٣²ßſKf.=:@+-_\"'`,;$\0\U0001F600ñ中"
    words = ["".join(rng.choice(marks) for _ in range(rng.randrange(1, 24))) for _ in range(4000)]
    words += ["".join(rng.choice("0123.") for _ in range(rng.randrange(1, 8))) for _ in range(300)]
    words += ["x" * 90, "...", "=", "my_pwd=abc", "PaſsWord", "toKen:", "auth", "word,", "é.", "1.2.3.", "deadBEEF", "a" * 64]
    got = secrets.shapes(words)
    assert [bytes(r) for r in got] == [secrets.shape(x) for x in words]


def value(field, features, labels):
    ends = [0, *labels]
    score = features.scores(field.emit)
    return sum(score[i, y] for i, y in enumerate(labels)) + sum(field.move[a, b] for a, b in zip(ends, [*labels, 0]))


def test_scan_is_the_best_labelling_of_whole_texts(docs):
    """Words that a bound rules out change nothing, whatever the field."""
    rng = random.Random(3)
    parts = ["key", "a=", "the", "ab12cd34", "x", "Zq9_zz7788aa", "é,", "{", "words", "a" * 30, "12345678"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(40)]
    for seed in range(4):
        noise = np.random.default_rng(seed)
        field = secrets.Field()
        field.emit, field.trained = noise.normal(0, 1.5, field.emit.shape), True
        field.move = noise.normal(0, 2, (3, 3))
        field.move[0, 2] = -1e4
        for d, row in enumerate(sorted(secrets.scan(docs(*texts), field).collect())):
            w = Words(pa.array([texts[d]]))
            assert row["doc_id"] == d
            features = secrets.Features(w)
            labels = field.decode(features.rows(np.arange(len(w.start)))) if len(w.start) else []
            assert np.allclose(features.scores(field.emit), features.rows(np.arange(len(w.start))) @ field.emit, atol=1e-4)
            some = field.open_words(features.scores(field.emit), w.doc)
            assert {i for i, y in enumerate(labels) if y} <= set(some.tolist())
            pieced = [0] * len(labels)
            for run in secrets._cut(w, some):
                for i, y in zip(run, field.best(features.scores(field.emit)[run])):
                    pieced[i] = y
            assert value(field, features, pieced) == pytest.approx(value(field, features, labels))
