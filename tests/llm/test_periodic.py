"""Runs by difference-cover extension queries, against a walk over every period."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from tierkit.llm import periodic
from tierkit.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def brute(words, least=24, repeats=3):
    """``start, length, period`` of all runs: each period's stretches, the smallest period of each."""
    n, found = len(words), {}
    for p in range(1, n // repeats + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, repeats * p):
                found.setdefault((i, j - i + p), p)
            i = j + 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def texts(rng):
    """A few texts over small alphabets, some with periodic stretches."""
    out = []
    for _ in range(rng.randrange(1, 6)):
        letters = rng.choice([1, 2, 3, 50])
        words = [rng.randrange(letters) for _ in range(rng.choice([0, 1, 23, 24, 40, 100, 300]))]
        for _ in range(rng.randrange(3) if len(words) > 30 else 0):
            at, p = rng.randrange(len(words)), 1 + rng.randrange(30)
            for i in range(at, min(len(words), at + rng.randrange(200))):
                words[i] = words[at + (i - at) % p]
        out.append(words)
    return out


@pytest.mark.parametrize("least,repeats", [(24, 3), (6, 3), (5, 2), (24, 2)])
def test_runs_against_brute_force(least, repeats):
    rng = random.Random(least * 10 + repeats)
    for _ in range(60):
        some = texts(rng)
        words = np.array([w for t in some for w in t], np.uint64)
        doc, *rest = periodic.find_runs(words, np.array([len(t) for t in some]), least, repeats)
        got = [[tuple(map(int, r)) for d, *r in zip(doc, *rest) if d == i] for i in range(len(some))]
        assert got == [brute(t, least, repeats) for t in some]


def test_portions_of_the_grids_give_the_same(monkeypatch):
    some = texts(random.Random(5)) + [[1, 2, 3] * 40]
    words, n = np.array([w for t in some for w in t], np.uint64), np.array([len(t) for t in some])
    whole = periodic.find_runs(words, n)
    monkeypatch.setattr(periodic, "GRID_PLACES", 7)
    assert all((a == b).all() for a, b in zip(whole, periodic.find_runs(words, n)))


def test_extensions_count_common_words():
    rng = np.random.default_rng(4)
    ids = np.append(rng.integers(0, 2, 400), 9)
    ids[200:330] = ids[20:150]
    found = periodic.Extensions(ids)
    i, j = (rng.integers(0, 401, 3000) for _ in range(2))
    i, j = i[i != j], j[i != j]
    want = []
    for a, b in zip(i, j):
        n = 0
        while max(a, b) + n < len(ids) and ids[a + n] == ids[b + n]:
            n += 1
        want.append(n)
    assert found.length(i, j).tolist() == want


def test_the_cover_brings_any_two_places_together():
    sampled = {c for c in periodic.COVER.tolist()}
    for a in range(periodic.SPAN):
        for b in range(periodic.SPAN):
            shift = int(periodic._SHIFT[a, b])
            assert {(a + shift) % periodic.SPAN, (b + shift) % periodic.SPAN} <= sampled


def test_defined_results(spark, docs, rows):
    again = "x y z " * 10
    df = docs((1, None), (2, ""), (3, " \n\t"), (4, again), (4, again), (None, again), (5, "a " * 5000), (6, "b c"), extra=["runs", "n_words"])
    got = {r["doc_id"]: r for r in periodic.collapse_runs(df).collect()}
    assert periodic.collapse_runs(df).count() == 8
    for blank in (1, 2, 3):
        assert (got[blank]["n_words"], got[blank]["runs"], got[blank]["collapsed"]) == (0, [], "")
    assert [tuple(r) for r in got[4]["runs"]] == [(0, 30, 3)] and got[4]["collapsed"] == "x y z"
    assert got[None]["collapsed"] == "x y z"
    assert [tuple(r) for r in got[5]["runs"]] == [(0, 5000, 1)] and got[5]["collapsed"] == "a"
    assert got[6]["runs"] == [] and got[6]["collapsed"] == "b c"
    assert periodic.collapse_runs(df.limit(0)).collect() == []


def test_strongest_prefers_the_first_of_equals(spark):
    run = "array<struct<start: long, length: long, period: long>>"
    df = spark.createDataFrame([([(0, 24, 2), (30, 36, 3), (80, 60, 5)],), ([],), ([(0, 30, 3), (50, 24, 1)],)], f"runs {run}")
    assert [r[0] and tuple(r[0]) for r in df.select(periodic.strongest("runs")).collect()] == [(0, 24, 2), None, (50, 24, 1)]


def by_hand(i, text):
    words = re.findall(r"[^\x20\x09-\x0d]+", text or "")
    h, n = (zlib.crc32(str(i).encode()), len(words)) if i is not None else (1, 0)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p, own = 1 + (n - a) // (3 + g % 8), list(words)
        for k in range(a, n):
            words[k] = own[a + (k - a) % p]
    found = brute(words)
    gone = {k for s, n, p in found for k in range(s + p, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    left = " ".join(w for k, w in enumerate(words) if k not in gone)
    return i, len(found), *best, 1000 * best[1] // best[2] if found else None, sha(lines), sha(left)


def test_query_against_brute_force(spark):
    """Every text of the smallest tables up to 40,000 characters; the longer ones take the walk too long."""
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op13_cover_runs"](spark, FOLDER).collect()}
    texts = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want = {i: by_hand(i, t) for i, t in texts if len(t or "") < 40_000}
    assert len(want) > 150 and sum(v[1] > 0 for v in want.values()) > 10
    assert {i: got[i] for i in want} == want


def test_with_cycles_leaves_nulls(spark, docs):
    tenth = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    df = docs((tenth[0], None), (tenth[1], " "), (None, "a b"), (tenth[2], " é  b c d\n"), extra=["words", "g", "n", "a", "p"])
    got = {r["doc_id"]: r["text"] for r in periodic.with_cycles(df).collect()}
    assert got[tenth[0]] is None and got[tenth[1]] == " " and got[None] == "a b"
    assert len(got[tenth[2]].split(" ")) == 3
