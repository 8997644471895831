"""Secret scan: fixed patterns, and a linear-chain conditional random field over words.

Three patterns always count: assignments of a value to a name like ``token``, access keys, and
long hexadecimal runs. A conditional random field adds what they miss. Its labels are
``B`` (a secret begins), ``I`` (it goes on) and ``O``; its features are the shape of a word, its
neighbours, and traits of the whole text. Every word of a text is scored and may have any label.
A word that would better be ``O`` whatever the labels around it (``Field.open_words``) is ``O`` in the
best labelling, so Viterbi finds that labelling on the runs of other words; nothing is approximated.

The field is trained where it is used: on at most ``SAMPLE_TEXTS`` texts in which a pattern
matches, whose values are ``B``, and as many without one, all of less than 20,000 characters; those of least hash are
taken. Copies of the former in which the value is replaced by keys of other make, and the neighbours
by other words, keep the field from learning the patterns by heart. Their words are learned in pieces
of ``PIECE``; of the pieces without a secret or a key-like word at most ``PLAIN_PIECES`` count, for all.

Defined results: a null or empty text has no spans; offsets are code points, ends exclusive;
spans that the field adds never overlap those of the patterns; without a text to learn from
only the patterns count; rows that repeat are scanned one by one; an empty table gives no
rows; other columns are not looked at.
"""

from __future__ import annotations

import functools
import random
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.llm.shared import least_hashed
from tierkit.llm.words import Words, column, map_slices, slices

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 8, 16, 32

LEAST_LENGTH = 8
LONG = 20
SAMPLE_TEXTS = 300
PIECE = 12
PLAIN_PIECES = 2000
ROUNDS = 200
_EDGES = "\"'`,;:()[]{}<>#*$%&!?.|="
_HINT = re.compile(r"pass|pwd|secret|token|key|auth|bearer|credential", re.I)
_CODE = np.zeros(256, bool)
_CODE[[ord(c) for c in "{};=<>"]] = True


def patterns(text: str) -> list[tuple[int, int, int, int, int]]:
    """``start, kind, end`` of the pattern matches in order, and the ends of the value inside."""
    found = []
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= LEAST_VALUE:
            found.append((m.start(), 0, m.end(), *m.span(2)))
    for kind, pattern, least in ((1, ACCESS, LEAST_ACCESS), (2, HEX, LEAST_HEX)):
        for m in pattern.finditer(text):
            if m.end() - m.start() >= least:
                found.append((m.start(), kind, m.end(), *m.span()))
    return sorted(found)


# --- features ---------------------------------------------------------------------------

_SIZES = (12, 16, 24, 40)
_WIDTHS = (8, 16, 64)
_VOWELS, _HEX_DIGITS = "aeiouAEIOUäöüéèêíóáú", "0123456789abcdefABCDEF"
FEATURES = (
    ["bias", *(f"size{i}" for i in range(5)), "lower", "upper", "both", "hex", "number", "dotted", "mail", "plus"]
    + [*(f"digits{i}" for i in range(4)), *(f"turns{i}" for i in range(4)), *(f"kinds{i}" for i in range(3))]
    + ["vowels", "inner", "quoted", "named", "name_before", "set_before", "hint_near", "word_after", "run"]
    + ["code_text", "many", "long_text", "punctuated"]
)
_INDEX = {name: i for i, name in enumerate(FEATURES)}
#: features by the words before and after, and by the whole text; all others are of the word alone
CONTEXT = ("name_before", "set_before", "hint_near", "word_after", "run")
TRAITS = ("code_text", "many", "long_text")
_CONTEXT, _TRAITS = ([_INDEX[name] for name in names] for names in (CONTEXT, TRAITS))


def _bucket(value: float, cuts) -> int:
    return sum(value >= c for c in cuts)


def shape(word: str) -> bytes:
    """Features of a word alone, then what it is to its neighbours: a hint, an assignment, key-like, plain."""
    core = word.strip(_EDGES) or word
    digits = sum(c.isdigit() for c in core)
    lower, upper = sum(c.islower() for c in core), sum(c.isupper() for c in core)
    kinds = ["d" if c.isdigit() else "a" if c.isalpha() else "s" for c in core]
    turns = sum(a != b for a, b in zip(kinds, kinds[1:]))
    letters = lower + upper
    size = len(core)
    on = ["bias", f"size{_bucket(size, _SIZES)}", f"digits{_bucket(digits / size, (0.01, 0.2, 0.6))}"]
    on += [f"turns{_bucket(turns / size, (0.01, 0.15, 0.35))}", f"kinds{_bucket(len(set(core)) / size, (0.3, 0.6))}"]
    on += [name for name, yes in (
        ("lower", lower and not upper), ("upper", upper and not lower), ("both", upper and lower),
        ("hex", letters and all(c in _HEX_DIGITS for c in core)), ("number", digits and not letters),
        ("dotted", re.fullmatch(r"[0-9]+(\.[0-9]+)+", core)), ("mail", "@" in core), ("plus", core.startswith("+")),
        ("vowels", letters and sum(c in _VOWELS for c in core) / letters >= 0.28),
        ("inner", any(not c.isalnum() for c in core)), ("quoted", word[0] in "\"'`"),
        ("punctuated", word[-1] in ".,;:!?" and word[:-1].isalpha()),
        ("named", _HINT.search(core) and "=" in word),
    ) if yes]
    row = bytearray(len(FEATURES) + 4)
    for name in on:
        row[_INDEX[name]] = 1
    keylike = len(word) >= LEAST_LENGTH and any(c.isdigit() for c in word)
    row[-4:] = bytes(map(bool, (_HINT.search(word), word[-1] in "=:", keylike, word.strip(_EDGES).isalpha())))
    return bytes(row)


@functools.cache
def _classes() -> np.ndarray:
    """What ``shape`` asks of a character, as bits of a number for each code point of two bytes."""
    out = np.zeros(1 << 16, np.uint8)
    for point in range(1 << 16):
        c = chr(point)
        asked = c.isdigit(), c.isalpha(), c.islower(), c.isupper(), c.isalnum(), c in _EDGES, c in _VOWELS, c in _HEX_DIGITS
        out[point] = sum(yes << i for i, yes in enumerate(asked))
    return out


def _shapes_of_size(words: list[str], size: np.ndarray, most: int) -> np.ndarray:
    """``shape`` of many words of at most ``most`` code points of two bytes, none of them 0, but for hints."""
    m = np.array(words, f"U{most}").view(np.uint32).reshape(-1, most).astype(np.uint16)
    each, places = np.arange(len(words)), np.arange(most)
    bits = _classes()[m]
    bits[m == 0] = 0
    edge = (bits & 32) > 0
    body = (m > 0) & ~edge
    only_edges = ~body.any(axis=1)
    low = np.where(only_edges, 0, body.argmax(axis=1))
    high = np.where(only_edges, size, most - body[:, ::-1].argmax(axis=1))
    core = (places >= low[:, None]) & (places < high[:, None])
    length = high - low
    digit, alpha, lower, upper, alnum, _, vowel, hexa = ((bits & (1 << i) > 0) & core for i in range(8))
    digits, lowers, uppers = (x.sum(axis=1) for x in (digit, lower, upper))
    letters = lowers + uppers
    kind = np.where(digit, 2, np.where(alpha, 1, 0))
    turns = ((kind[:, 1:] != kind[:, :-1]) & core[:, 1:] & core[:, :-1]).sum(axis=1)
    ordered = np.sort(np.where(core, m, 0), axis=1)
    others = ((ordered[:, 1:] != ordered[:, :-1]) & (ordered[:, 1:] > 0)).sum(axis=1) + (ordered[:, 0] > 0)
    first, last = m[:, 0], m[each, size - 1]
    dot = (m == ord(".")) & core
    number = core & (m >= 48) & (m <= 57)
    dotted = dot.any(axis=1) & ((number | dot) == core).all(axis=1) & ~(dot[:, 1:] & dot[:, :-1]).any(axis=1) & ~only_edges
    out = np.zeros((len(words), len(FEATURES) + 4), np.uint8)
    out[:, _INDEX["bias"]] = 1
    for name, value, cuts in (
        ("size", length, _SIZES), ("digits", digits / length, (0.01, 0.2, 0.6)),
        ("turns", turns / length, (0.01, 0.15, 0.35)), ("kinds", others / length, (0.3, 0.6)),
    ):
        out[each, _INDEX[f"{name}0"] + np.searchsorted(cuts, value, "right")] = 1
    plain = ((bits & 2 > 0) == (m > 0))
    plain[each, size - 1] = True
    for name, yes in (
        ("lower", (lowers > 0) & (uppers == 0)), ("upper", (uppers > 0) & (lowers == 0)), ("both", (uppers > 0) & (lowers > 0)),
        ("hex", (letters > 0) & (hexa == core).all(axis=1)), ("number", (digits > 0) & (letters == 0)), ("dotted", dotted),
        ("mail", ((m == ord("@")) & core).any(axis=1)), ("plus", m[each, low] == ord("+")),
        ("vowels", vowel.sum(axis=1) / np.maximum(letters, 1) >= 0.28), ("inner", (alnum != core).any(axis=1)),
        ("quoted", np.isin(first, [ord(c) for c in "\"'`"])),
        ("punctuated", np.isin(last, [ord(c) for c in ".,;:!?"]) & plain.all(axis=1) & (size > 1)),
    ):
        out[:, _INDEX[name]] = yes
    out[:, _INDEX["named"]] = (m == ord("=")).any(axis=1)
    out[:, -3] = np.isin(last, [ord(c) for c in "=:"])
    out[:, -2] = (size >= LEAST_LENGTH) & (bits & 1 > 0).any(axis=1)
    out[:, -1] = (alpha == core).all(axis=1) & ~only_edges
    return out


def shapes(words: list[str]) -> np.ndarray:
    """``shape`` of every word, a row each; rare long words and rare characters one by one."""
    out = np.zeros((len(words), len(FEATURES) + 4), np.uint8)
    size = np.array([len(x) for x in words], np.int64)
    own = np.array([max(x) > "\uffff" or "\0" in x for x in words], bool) | (size > _WIDTHS[-1])
    for i in np.flatnonzero(own):
        out[i] = np.frombuffer(shape(words[i]), np.uint8)
    for least, most in zip((0, *_WIDTHS), _WIDTHS):
        at = np.flatnonzero(~own & (size > least) & (size <= most))
        if len(at):
            out[at] = _shapes_of_size([words[i] for i in at.tolist()], size[at], most)
    ends = np.cumsum(size + 1)
    hints = np.array([m.start() for m in _HINT.finditer(" ".join(words))], np.int64)
    hint = np.zeros(len(words), bool)
    hint[np.searchsorted(ends, hints, "right")] = True
    out[~own, -4], out[~own, _INDEX["named"]] = hint[~own], (hint & (out[:, _INDEX["named"]] > 0))[~own]
    return out


class Features:
    """Features of all words of a slice: ``own`` ones of its distinct words, the number of the
    distinct word of each word, ``context`` of each word and ``traits`` of each text."""

    def __init__(self, w: Words):
        self.doc = w.doc
        data = w.data.tobytes()
        _, at, self.number = np.unique(w.hash, return_index=True, return_inverse=True)
        words = [data[a:b].decode() for a, b in zip(w.start[at].tolist(), w.end[at].tolist())]
        table = shapes(words)
        self.own = table[:, :-4].astype(np.float32)
        hint, sets, keylike, plain = table[self.number, -4:].T.astype(bool)

        def shifted(flag: np.ndarray, by: int) -> np.ndarray:
            """The flag of the word ``by`` words before, within a text."""
            out = np.zeros(len(flag), bool)
            here, there = (slice(by, None), slice(None, -by)) if by > 0 else (slice(None, by), slice(-by, None))
            out[here] = flag[there] & (w.doc[here] == w.doc[there])
            return out

        near = shifted(hint, 1) | shifted(hint, 2) | shifted(hint, 3)
        self.context = np.stack((shifted(hint, 1), shifted(sets, 1), near, shifted(plain, -1), shifted(keylike, 1)), axis=1).astype(np.float32)
        code, points = w.per_doc(_CODE[w.data]), w.per_doc((w.data & 0xC0) != 0x80)
        keys = np.bincount(w.doc[candidate_words(w)], minlength=len(w.n))
        self.traits = np.stack((code * 50 > points, keys * 10 > w.n, w.n > 1000), axis=1).astype(np.float32)

    def rows(self, at: np.ndarray) -> np.ndarray:
        """The features of some words, a row each."""
        out = self.own[self.number[at]]
        out[:, _CONTEXT], out[:, _TRAITS] = self.context[at], self.traits[self.doc[at]]
        return out

    def scores(self, emit: np.ndarray) -> np.ndarray:
        """``rows`` of all words times ``emit``."""
        return (self.own @ emit)[self.number] + self.context @ emit[_CONTEXT] + (self.traits @ emit[_TRAITS])[self.doc]


def candidate_words(w: Words) -> np.ndarray:
    """Indices of the words that look like keys: a trait of a text, and never plain in learning."""
    digit = np.flatnonzero((w.data >= 48) & (w.data <= 57))
    size = w.end - w.start
    some = np.unique(np.searchsorted(w.start, digit, "right") - 1)
    some = some[size[some] >= LEAST_LENGTH] if len(some) else some
    return np.union1d(some, np.flatnonzero(size >= LONG))


# --- the field --------------------------------------------------------------------------


class Field:
    """Linear-chain conditional random field with the labels O, B, I over runs of words."""

    def __init__(self):
        self.emit = np.zeros((len(FEATURES), 3))
        self.move = np.zeros((3, 3))
        self.move[0, 2] = -1e4  # I never follows O
        self.trained = False

    def fit(self, rows: list[np.ndarray], labels: list[np.ndarray], weights: list[float] | None = None) -> Field:
        """Maximum likelihood with a small penalty, by Adam over all runs at once; a run counts ``weights`` times."""
        if not any((y == 1).any() for y in labels):
            return self
        most = max(len(y) for y in labels)
        n = len(labels)
        x = np.zeros((n, most, len(FEATURES)), np.float32)
        y = np.zeros((n, most), np.int64)
        real = np.zeros((n, most), bool)
        for i, (r, lab) in enumerate(zip(rows, labels)):
            x[i, : len(lab)], y[i, : len(lab)], real[i, : len(lab)] = r, lab, True
        times = np.ones(n) if weights is None else np.array(weights, float)
        before = np.concatenate((np.zeros((n, 1), np.int64), y[:, :-1]), axis=1)
        told_emit = np.einsum("ntf,ntk->fk", x * (real * times[:, None])[..., None], np.eye(3)[y])
        told_move = np.zeros((3, 3))
        np.add.at(told_move, (before[real], y[real]), np.repeat(times, real.sum(axis=1)))
        free = self.move > -1e3
        momentum, square = np.zeros(told_emit.size + 9), np.zeros(told_emit.size + 9)
        for t in range(1, ROUNDS + 1):
            e = x @ self.emit
            e[..., 2] += np.where(np.arange(most) == 0, -1e4, 0)
            forward = np.zeros((n, most, 3))
            state = np.tile(np.array([0.0, -1e9, -1e9]), (n, 1))
            arrivals = []
            for j in range(most):
                arrive = state[:, :, None] + self.move
                arrivals.append(arrive)
                state = np.logaddexp.reduce(arrive, axis=1) + e[:, j]
                forward[:, j] = state
            behind = np.zeros((n, 3))
            want_emit, want_move = np.zeros_like(told_emit), np.zeros((3, 3))
            last = real.sum(axis=1) - 1
            whole = np.logaddexp.reduce(forward[np.arange(n), last], axis=1)
            for j in range(most - 1, -1, -1):
                live = real[:, j]
                joint = arrivals[j] + (e[:, j] + behind)[:, None, :]
                share = np.where(live[:, None, None], np.exp(np.minimum(joint - whole[:, None, None], 0)), 0) * times[:, None, None]
                want_move += share.sum(axis=0)
                want_emit += x[:, j].T @ share.sum(axis=1)
                moved = np.logaddexp.reduce(self.move + (e[:, j] + behind)[:, None, :], axis=2)
                behind = np.where(live[:, None], moved, 0)
            slope = np.concatenate((((told_emit - want_emit) - 0.5 * self.emit).ravel(), (np.where(free, told_move - want_move, 0) - 0.5 * np.where(free, self.move, 0)).ravel())) / times.sum()
            momentum = 0.9 * momentum + 0.1 * slope
            square = 0.99 * square + 0.01 * slope**2
            change = 0.1 * (momentum / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
            self.emit += change[: told_emit.size].reshape(told_emit.shape)
            self.move += np.where(free, change[told_emit.size :].reshape(3, 3), 0)
        self.trained = True
        return self

    def open_words(self, score: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Indices of the words that may be other than O in the best labelling of their text.

        A label x other than O becomes O at a loss of at most the score of x against O, the greatest
        difference of the moves to it, and that of the moves from it; an I behind becomes a B, at the
        loss of the one against the other. Where that sum is below 0 for both, O is better.
        """
        m = self.move
        into = (m - m[:, :1]).max(axis=0)
        out = (m[:, :2] - m[0, :2]).max(axis=1)
        behind = np.full(len(score), -np.inf)
        same = doc[1:] == doc[:-1]
        behind[:-1][same] = (score[1:, 2] - score[1:, 1])[same] + (m[2] - m[1]).max()
        bounds = [score[:, x] - score[:, 0] + into[x] + np.maximum(out[x], m[x, 2] - m[0, 1] + behind) for x in (1, 2)]
        return np.flatnonzero(np.maximum(*bounds) > -1e-6)

    def decode(self, rows: np.ndarray) -> list[int]:
        """The best labels of a run of words by their features."""
        return self.best(rows @ self.emit)

    def best(self, score: np.ndarray) -> list[int]:
        """The best labels of a run of words by their scores, between two words with O, by Viterbi."""
        state, back = np.array([0.0, -1e9, -1e9]), []
        for e in score:
            arrive = state[:, None] + self.move
            back.append(arrive.argmax(axis=0))
            state = arrive.max(axis=0) + e
        label = int((state + self.move[:, 0]).argmax())
        out = [label]
        for b in back[:0:-1]:
            label = int(b[label])
            out.append(label)
        return out[::-1]


# --- scanning ---------------------------------------------------------------------------


def _cut(w: Words, some: np.ndarray) -> list[np.ndarray]:
    """Words by runs of neighbours in one text."""
    return np.split(some, np.flatnonzero((np.diff(some) > 1) | (np.diff(w.doc[some]) > 0)) + 1) if len(some) else []


def _runs(w: Words, some: np.ndarray):
    """Runs of neighbouring words: text number, features, byte ranges of the words."""
    features = Features(w)
    for run in _cut(w, some):
        yield int(w.doc[run[0]]), features.rows(run), [(int(w.start[i]), int(w.end[i])) for i in run]


def _may_match(w: Words) -> np.ndarray:
    """Texts in which a pattern can match at all."""
    lower = np.where((w.data >= 65) & (w.data <= 90), w.data + 32, w.data).astype(np.uint8).tobytes()
    places = [w.start[(w.end - w.start) >= LEAST_HEX]]
    for body, names in ((lower, NAMES), (w.data.tobytes(), (b"AKIA",))):
        for name in names:
            at, found = body.find(name), []
            while at >= 0:
                found.append(at)
                at = body.find(name, at + 1)
            places.append(np.array(found, np.int64))
    flag = np.zeros(len(w.n), bool)
    flag[np.searchsorted(w.bounds[1:], np.concatenate(places), "right")] = True
    return flag


def _points(w: Words):
    """Code point offset in its text of a byte offset in the slice."""
    tails = np.flatnonzero((w.data & 0xC0) == 0x80)

    def offset(d: int, byte: int) -> int:
        begin = int(w.bounds[d])
        low, high = np.searchsorted(tails, (begin, byte))
        return byte - begin - int(high - low)

    return offset


def scan(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id``, and the spans of the patterns and of all kinds, as arrays of
    ``kind, start, end`` in order of start and kind."""
    shipped = docs.sparkSession.sparkContext.broadcast(learn(docs) if field is None else field)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        w = Words(part.column("text"))
        texts = part.column("text").to_pylist()
        base = [[] for _ in texts]
        for d in np.flatnonzero(_may_match(w)):
            base[d] = patterns(texts[d])
        added = [[] for _ in texts]
        field = shipped.value
        if field.trained:
            offset = _points(w)
            score = Features(w).scores(field.emit)
            for run in _cut(w, field.open_words(score, w.doc)):
                d, labels = int(w.doc[run[0]]), field.best(score[run])
                for k, label in enumerate(labels):
                    if label == 1:
                        stop = k
                        while stop + 1 < len(labels) and labels[stop + 1] == 2:
                            stop += 1
                        start, end = offset(d, int(w.start[run[k]])), offset(d, int(w.end[run[stop]]))
                        core = texts[d][start:end]
                        end -= len(core) - len(core.rstrip(_EDGES))
                        start += len(core) - len(core.lstrip(_EDGES))
                        if start < end and all(end <= b[0] or start >= b[2] for b in base[d]):
                            added[d].append((start, 3, end))
        spans = [sorted([b[:3] for b in one] + more) for one, more in zip(base, added)]
        text = lambda found: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)
        count = lambda kind: column(np.array([sum(b[1] == kind for b in one) for one in base], np.int64))
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                "n_assign": count(0),
                "n_access": count(1),
                "n_hex": count(2),
                "n_crf": column(np.array([len(a) for a in added], np.int64)),
                "base": pa.array([text([b[:3] for b in one]) for one in base], pa.string()),
                "spans": pa.array([text(s) for s in spans], pa.string()),
            }
        )

    return map_slices(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        work,
        "doc_id long, n_assign long, n_access long, n_hex long, n_crf long, base string, spans string",
    )


def _other_key(rng: random.Random) -> str:
    letters = string.ascii_letters + string.digits
    some = lambda n, a=letters: "".join(rng.choice(a) for _ in range(n))
    make = rng.randrange(5)
    if make == 0:
        return some(rng.randrange(20, 44))
    if make == 1:
        return some(rng.randrange(2, 5), string.ascii_lowercase) + rng.choice("_-") + some(rng.randrange(24, 40))
    if make == 2:
        return some(rng.randrange(16, 30), string.ascii_uppercase + string.digits)
    if make == 3:
        return ".".join(some(rng.randrange(12, 30), letters + "_-") for _ in range(3))
    return some(rng.randrange(24, 60), letters + "+/") + "=" * rng.randrange(3)


def learn(docs: DataFrame) -> Field:
    """A field trained on a bounded sample: texts with a pattern match, and texts with other
    words that look as if they could be secrets."""

    def label(batches):
        for part in slices(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            w = Words(part.column("text"))
            may = _may_match(w)
            kinds = [2 if may[d] and patterns(t) else 0 for d, t in enumerate(texts)]
            for d in np.unique(w.doc[candidate_words(w)]):
                kinds[d] = kinds[d] or 1
            yield pa.RecordBatch.from_pydict({"kind": pa.array(kinds, pa.int32()), "text": pa.array(texts, pa.string())})

    marked = docs.select("text").filter("length(text) < 20000").mapInArrow(label, "kind int, text string")
    rows = least_hashed(marked, SAMPLE_TEXTS, 3)
    rng = random.Random(11)
    features, labels, plain = [], [], []
    for row in rows:
        versions = [row["text"]]
        for _ in range(3 if row["kind"] == 2 else 0):
            text = row["text"]
            for start, _, end, a, b in reversed(patterns(text)):
                if a >= start and (b - a) >= LEAST_VALUE:
                    lead = rng.choice([text[start:a], "", "auth ", "bearer ", "key: "])
                    key = _other_key(rng)
                    text = f"{text[:start]}{lead}\x01{key}\x02{text[end:]}" if "\x01" not in text[start:end] else text
            versions.append(text)
        for text in versions:
            marks = [(m.start(), m.end() - 2) for m in re.finditer("\x01[^\x02]*\x02", text)]
            marks = [(a - 2 * i, b - 2 * i) for i, (a, b) in enumerate(marks)]
            text = text.replace("\x01", "").replace("\x02", "")
            spans = marks + [b[3:5] for b in patterns(text)]
            w = Words(pa.array([text]))
            offset = _points(w)
            keylike = np.isin(np.arange(len(w.start)), candidate_words(w))
            for _, x, places in _runs(w, np.arange(len(w.start))):
                places = [(offset(0, s), offset(0, e)) for s, e in places] if spans else places
                inside = np.array([any(s < b and e > a for a, b in spans) for s, e in places], np.int64)
                for at in range(0, len(inside), PIECE):
                    piece = x[at : at + PIECE], inside[at : at + PIECE]
                    if keylike[at : at + PIECE].any() or piece[1].any():
                        features.append(piece[0])
                        labels.append(piece[1])
                    else:
                        plain.append(piece)
    some = rng.sample(plain, min(len(plain), PLAIN_PIECES))
    weights = [1.0] * len(labels) + [len(plain) / max(len(some), 1)] * len(some)
    features, labels = features + [x for x, _ in some], labels + [y for _, y in some]
    return Field().fit(features, labels, weights) if labels else Field()
