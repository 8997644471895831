"""Leaks against the edit distance of every item from every passage."""

import random
import re

import pytest

from tierkit.llm import decontaminate


def words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, b in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (a != b))
    return min(row)


def brute(rows, items, similarity=0.8):
    found = set()
    for d, text in rows:
        for i, item in items:
            n = len(words(item))
            edits = distance(words(item), words(text)) if n else 1
            if n and (edits <= (1 - similarity) * n + 1e-9 if n >= decontaminate.LEAST_WORDS else edits == 0):
                found.add((d, i, n, edits))
    return found


@pytest.fixture(scope="module")
def benchmark(spark):
    rng = random.Random(8)
    items = [(i, " ".join(f"Q{rng.randrange(400)}" for _ in range(rng.randrange(8, 45)))) for i in range(30)]
    items += [(30, "three short words"), (31, None), (32, "..."), (33, items[0][1]), (None, items[1][1])]
    return spark.createDataFrame(items, "item_id long, text string"), items


def test_leaks(docs, prose, benchmark):
    frame, items = benchmark
    rng = random.Random(2)
    rows = [None, "", "three, SHORT words!", "three short other words", " ".join(prose(9, 20_000)), items[3][1][:40]]
    for i, item in items[:30]:
        for share in (0, 0.1, 0.2, 0.4):
            w = item.split()
            for _ in range(int(share * len(w))):
                kind, at = rng.random(), rng.randrange(len(w))
                w[at : at + 1] = [] if kind < 0.2 else [f"new{rng.randrange(99)}"] if kind < 0.8 else [w[at], "more"]
            lead, rest = prose(i, rng.randrange(0, 30)), prose(i + 50, rng.randrange(0, 30))
            rows.append(" ".join([*lead, rng.choice([" ", ", ", "\n"]).join(w), *rest]))
    frame_of_rows = docs(*rows, (0, None), (500, rows[10]), (500, rows[10]), extra=("item_id",))
    got = {tuple(r) for r in decontaminate.leaks(frame_of_rows, frame).collect()}
    want = brute([*enumerate(rows), (500, rows[10])], items)
    assert got <= want
    assert len(got) >= 0.97 * len(want)  # the target recall of the tables
    assert {g for g in got if g[3] == 0} == {g for g in want if g[3] == 0}
    left = decontaminate.filter_documents(frame_of_rows, frame)
    assert left.columns == frame_of_rows.columns
    flagged = {d for d, *_ in got}
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(r["doc_id"] for r in frame_of_rows.collect() if r["doc_id"] not in flagged)


def test_short_items_are_found_at_every_allowed_distance(spark, docs, prose):
    """Of items of 5 to 19 words no passage is missed, exact or with all edits that 0.8 allows."""
    rng = random.Random(6)
    items = [(i, " ".join(rng.choice(["the", "of", f"q{rng.randrange(300)}"]) for _ in range(5 + i % 15))) for i in range(90)]
    rows = []
    for i, item in items:
        for edits in range(len(item.split()) // 5 + 1):
            for turn in range(3):
                w = item.split()
                for at in rng.sample(range(len(w)), edits):
                    kind = rng.random()
                    w[at] = "" if kind < 0.3 else f"new{rng.randrange(99)}" if kind < 0.7 else f"{w[at]} more"
                rows.append(" ".join([*prose(i, 9), *w, *prose(i + turn, 9)]))
    frame = spark.createDataFrame(items, "item_id long, text string")
    got = {tuple(r) for r in decontaminate.leaks(docs(*rows), frame).collect()}
    assert got == brute(enumerate(rows), items)


def test_blocks_find_the_same(docs, benchmark, monkeypatch):
    frame, items = benchmark
    rows = docs(*[f"before {t} after" for _, t in items[:10]])
    whole = {tuple(r) for r in decontaminate.leaks(rows, frame).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 60)
    assert {tuple(r) for r in decontaminate.leaks(rows, frame).collect()} == whole


def test_empty_tables(docs, benchmark):
    frame, _ = benchmark
    none = docs("x").filter("false")
    assert decontaminate.leaks(none, frame).count() == 0
    assert decontaminate.leaks(docs("a b c"), frame.filter("false")).count() == 0
    assert decontaminate.filter_documents(docs("a b c"), frame.filter("false")).count() == 1
