"""Personal data: the patterns, the best segmentation against all, and what the field adds."""

import random
import re
import sys

import numpy as np
import pytest

from tierkit.llm import personal


sys.set_int_max_str_digits(0)


def check_digit(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    text, found = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        found += [(m.start(), 1, m.end())] if all(int(p) <= 255 for p in m[0].split(".")) else []
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        found += [(m.start(), 2, m.end())] if 14 <= len(digits(m)) <= 19 and check_digit(digits(m)) else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        found += [(m.start(), 3, m.end())] if 10 <= len(digits(m)) <= 15 else []
    return ",".join(f"{personal.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


CARD = "4465758382889437"
EDGES = [
    *(None, "", f"é {CARD} ß", "a@b", "a@b.c@d.e", "a@b.com_x@y.zz", "@x.y a..b@c-d.e.f.", "x@y.z@", "é@é.com"),
    *("1.2.3.4.5.6.7.8", "256.1.1.1.1.1", "001.02.3.255x", "1..2.3.4", f"{CARD[:4]}-{CARD[4:8]} {CARD[8:12]}-{CARD[12:]}"),
    *(f"{CARD} {CARD}", f"{CARD}  1", f"{CARD}0", "+1 (743) 555-3824", "+1-2", "+49 (0) 30.123456-", "++1 234 567 8901", "+1 2 3"),
    *("1" * 5000 + ".1.1.1", "a" * 60_000 + "@b.c", "0" * 5000 + "1.1.1.1", "1 " * 30_000),
]


def numbers(rng):
    while True:
        card = str(rng.randrange(10**15, 10**16))
        if check_digit(card):
            return card


@pytest.fixture(scope="module")
def learned(docs):
    rng = random.Random(0)
    rows = []
    for i in range(300):
        own = ["".join(rng.choice("abcdeinorst") for _ in range(rng.randrange(2, 9))) for _ in range(20)]
        own[8:8] = [[
            numbers(rng), f"{own[0]}.{i}@mail{i}.example.com", f"{i % 256}.{rng.randrange(256)}.7.9",
            f"+{rng.randrange(1, 99)} ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}", f"{rng.randrange(10**15, 10**16)}", "2024-05-06 10:11:12",
        ][i % 6]]
        rows.append(" ".join(own))
    return personal.learn(docs(*rows))


def test_patterns(docs, learned):
    frame = docs(*EDGES, (500, EDGES[2]), (500, EDGES[2]), extra=("base", "n_ip"))
    for field in (personal.Field(), learned):
        got = sorted((r["doc_id"], r["base"], r["spans"]) for r in personal.scan(frame, field).collect())
        assert [(d, b) for d, b, _ in got] == [(i, brute(t)) for i, t in enumerate(EDGES)] + [(500, brute(EDGES[2]))] * 2
        for _, base, spans in got:
            assert set(filter(None, base.split(","))) <= set(spans.split(","))


def test_field_parts_what_the_patterns_take_as_one(docs, learned):
    got = {r["doc_id"]: r["spans"] for r in personal.scan(docs(f"pay {CARD} {CARD} now", "on 2024-05-06 at 10:11:12 and 123456789012"), learned).collect()}
    assert got == {0: "card:4:20,card:21:37", 1: ""}


def test_best_segmentation(learned):
    """The programme's choice scores as much as the best of all segmentations."""
    text = f"{CARD} {CARD} +1 (743) 555-3824"
    atoms = personal._atoms(text, 0, len(text))
    some = personal.segments(text, atoms)
    score = {(i, j): max(learned.weight[on].sum(axis=0)) for i, j, on in some}

    def best(at):
        if at >= len(atoms):
            return 0.0
        return max([best(at + 1), *(s + best(j) for (i, j), s in score.items() if i == at)])

    import functools

    best = functools.lru_cache(None)(best)
    chosen = learned.decode(len(atoms), some)
    assert sum(learned.weight[on].sum(axis=0)[kind] for i, j, on in some for a, b, kind in chosen if (i, j) == (a, b)) == pytest.approx(best(0))
    assert [text[atoms[i][0] : atoms[j - 1][1]] for i, j, _ in chosen] == [CARD, CARD, "+1 (743) 555-3824"]


def test_lattice_sums_all_segmentations():
    ends, score = [(0, 1), (0, 2), (1, 3), (2, 3)], np.array([0.3, -0.2, 0.9, 0.1])
    ahead, behind = personal._lattice(3, ends, score)
    ways = [0, 0.3, -0.2, 0.9, 0.1, 0.3 + 0.9, 0.3 + 0.1, -0.2 + 0.1]
    assert ahead[3] == pytest.approx(np.log(np.exp(ways).sum())) and behind[0] == pytest.approx(ahead[3])


def test_nothing_to_learn_from(docs):
    assert not personal.learn(docs("plain words only")).trained
    assert personal.scan(docs("x").filter("false")).count() == 0
