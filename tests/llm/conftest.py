import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """Texts, or (doc_id, text, lang, source), as a table of documents."""

    def make(*rows, extra=()):
        full = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(r + ("en", "s0")[len(r) - 2 :])[:4] for r in full]
        frame = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], SCHEMA)
        for name in extra:
            frame = frame.selectExpr("*", f"n_chars * 2 AS `{name}`")
        return frame

    return make


@pytest.fixture
def prose():
    """``prose(seed, n)``: n invented words, some of them common."""
    common = "the of and to in is that it for on".split()

    def make(seed, n, stem="w"):
        rng = random.Random(seed)
        return [rng.choice(common) if rng.random() < 0.4 else f"{stem}{rng.choice('abcdefgh')}{rng.randrange(10**6)}" for _ in range(n)]

    return make
