"""Words and hashes inside Arrow batches."""

import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tierkit.llm.words import SLICE_BYTES, Counter64, Lookup, Words, slices, unpacked_slices

texts = st.lists(st.none() | st.text("aAéß# \t\n\x0b\x0c\r\x1c\x85 €.", max_size=30), max_size=6)


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_are_runs_without_ascii_space(some):
    w = Words(pa.array(some, pa.string()))
    got = [[] for _ in some]
    for d, a, b in zip(w.doc, w.start, w.end):
        got[d].append(w.data[a:b].tobytes().decode())
    assert got == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in some]
    assert w.n.tolist() == [len(g) for g in got]
    hashes = {}
    for h, (d, a, b) in zip(w.hash, zip(w.doc, w.start, w.end)):
        assert hashes.setdefault(w.data[a:b].tobytes(), h) == h
    assert len(set(hashes.values())) == len(hashes)


@settings(max_examples=100, deadline=None)
@given(texts, st.integers(1, 4))
def test_windows_stay_inside_a_text(some, size):
    w = Words(pa.array(some, pa.string()))
    at, keys = w.windows(w.hash, size)
    want = {}
    for d in range(len(some)):
        words = re.findall(r"[^\x20\x09-\x0D]+", some[d] or "")
        for i in range(len(words) - size + 1):
            want[int(w.first[d]) + i] = tuple(words[i : i + size])
    assert at.tolist() == sorted(want)
    by_key = {}
    for i, k in zip(at.tolist(), keys):
        assert by_key.setdefault(want[i], k) == k
    assert len(set(by_key.values())) == len(by_key)


def test_slices_hold_all_rows_and_sliced_arrays_work():
    batch = pa.RecordBatch.from_pydict({"text": ["x " * 600_000, None, "b", "c d"] * 2, "n": list(range(8))})
    parts = list(slices(iter([batch.slice(1), batch.slice(0, 0)])))
    assert [n for p in parts for n in p.column("n").to_pylist()] == list(range(1, 8))
    assert len(parts) > 1
    assert sum(Words(p.column("text")).n.sum() for p in parts) == 3 + 600_000 + 3


def test_counter_gives_out_full_tables():
    counter, out = Counter64(most=10), []
    for i in range(20):
        full = counter.add(np.arange(i, i + 6, dtype=np.uint64))
        out += [full] if full else []
    out.append(counter.fold())
    total = {}
    for keys, counts in out:
        for k, n in zip(keys.tolist(), counts.tolist()):
            total[k] = total.get(k, 0) + n
    want = {}
    for i in range(20):
        for k in range(i, i + 6):
            want[k] = want.get(k, 0) + 1
    assert total == want


def test_lookup_finds_exactly_its_keys():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**63, 500).astype(np.uint64))
    at, place = Lookup(keys[::2]).find(keys)
    assert at.tolist() == list(range(0, len(keys), 2)) and (keys[::2][place] == keys[at]).all()


def test_slices_follow_the_unpacked_bytes():
    """Texts of one word again and again, a thousandth when packed, don't meet in one slice."""
    texts = [b"again " * 50_000, None, b"", *[b"again " * 50_000] * 20, b"end"]
    small = pa.array([None if t is None else zlib.compress(t, 4) for t in texts], pa.binary())
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": small})
    parts = list(unpacked_slices([batch.slice(0, 0), batch], "text"))
    assert [t for _, (own,) in parts for t in own.to_pylist()] == texts
    assert [i for part, _ in parts for i in part.column("id").to_pylist()] == list(range(len(texts)))
    assert all(sum(len(t or b"") for t in own.to_pylist()[:-1]) < SLICE_BYTES for _, (own,) in parts)
    assert len(parts) == 6
