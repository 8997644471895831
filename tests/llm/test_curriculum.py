"""Targets by pouring in small steps, queues document by document."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from tierkit.llm import curriculum

WEIGHTS = (3, 1, 2)


def pour(sizes):
    """Water filling with every source's cap at twice its size, by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, full = 1.5 * sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        total = sum(weight[s] for s in rest)
        share = {s: left * weight[s] / total for s in rest}
        over = [s for s in rest if share[s] > 2 * sizes[s] + 1e-9]
        if not over:
            return {**full, **share}
        for s in over:
            full[s] = 2.0 * sizes[s]
            left -= full[s]


def brute(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    of = defaultdict(int)
    for (_, _, s), n in zip(rows, size):
        of[s] += n
    target, out = pour(of), []
    for s in of:
        own = [(hashlib.md5(str(d if d is not None else "").encode()).hexdigest()[:15], d, n) for (d, _, t), n in zip(rows, size) if t == s]
        begin = 0
        for _, d, n in sorted(own, key=lambda x: (x[0], x[1] is not None, x[1] or 0, x[2])):
            out.append((d, n, of[s], round(target[s], 6), sum(n for k in (0, 1) if begin + n / 2 + k * of[s] < target[s])))
            begin += n
    return Counter(out)


@pytest.mark.parametrize("stretch", [1, 7, 10_000])
def test_plan(docs, prose, monkeypatch, stretch):
    monkeypatch.setattr(curriculum, "STRETCH", stretch)
    sources = ["b", "a", "é", "Z", None, "empty", "hot"]
    rows = [(i, " ".join(prose(i, 1 + (i * 7) % 40)), sources[i % 5]) for i in range(60)]
    rows += [(100 + i, "w " * 50, "hot") for i in range(40)]
    rows += [(200, None, "empty"), (201, "", "empty"), (202, "x " * 3000, "a"), (None, "no id here", "b"), (5, rows[5][1], "b")]
    frame = docs(*[(d, t, "en", s) for d, t, s in rows], extra=("_size", "target"))
    planned = curriculum.plan(frame.drop("_size"))
    got = Counter(
        (r["doc_id"], r["_size"], r["_source_size"], round(r["_target"], 6), r["_size"] * r["_copies"]) for r in planned.collect()
    )
    assert got == brute(rows)
    for r in planned.collect():
        assert len(r["_positions"]) == r["_copies"] and all(0 <= p <= 1 for p in r["_positions"])


def test_schedules_shift_sources(docs):
    """A source that rises comes later in the training order than one that falls."""
    frame = docs(*[(i, "w " * 10, "en", "ab"[i % 2]) for i in range(400)])
    rows = curriculum.mixed(frame).collect()
    at = defaultdict(list)
    for place, r in enumerate(rows):
        at[r["source"]].append(place)
    mean = {s: sum(p) / len(p) for s, p in at.items()}
    assert mean["a"] > len(rows) * 0.52 > len(rows) * 0.48 > mean["b"]
    assert len(rows[0]) == 5


def test_nothing_to_mix(docs):
    assert curriculum.plan(docs("x").filter("false")).count() == 0
    row = curriculum.plan(docs((1, None), (2, ""))).collect()
    assert [(r["_target"], r["_copies"]) for r in row] == [(0.0, 0)] * 2
    assert curriculum.mixed(docs((1, None))).count() == 0


def test_reruns_agree(docs, prose):
    frame = docs(*[(i, " ".join(prose(i, 20)), "en", f"s{i % 3}") for i in range(50)])
    first = [r["doc_id"] for r in curriculum.mixed(frame).collect()]
    assert [r["doc_id"] for r in curriculum.mixed(frame.repartition(7)).collect()] == first


INSIDE = "n_docs _place _of _rank _stretch _offset _begin _tie _sum _position row".split()


def test_columns_of_any_name_are_handed_through(docs):
    """The names used inside are the user's own; ``plan`` replaces those it adds, ``mixed`` none."""
    rows = [(i, "w " * (1 + i % 7), "en", f"s{i % 3}") for i in range(60)]
    frame = docs(*rows, extra=[*INSIDE, *curriculum.ADDED])
    plain = docs(*rows)
    planned = curriculum.plan(frame)
    assert planned.columns == [*plain.columns, *INSIDE, *curriculum.ADDED]
    some = ("doc_id", *curriculum.ADDED)
    assert sorted(map(str, planned.select(*some).collect())) == sorted(map(str, curriculum.plan(plain).select(*some).collect()))
    mixed = curriculum.mixed(frame)
    assert mixed.columns == frame.columns
    got = mixed.collect()
    assert all(r[c] == 2 * r["n_chars"] for r in got for c in (*INSIDE, *curriculum.ADDED))
    assert [r["doc_id"] for r in got] == [r["doc_id"] for r in curriculum.mixed(plain).collect()]
