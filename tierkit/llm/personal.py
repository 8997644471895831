"""Personal data: fixed patterns, and a semi-Markov conditional random field over whole spans.

Four patterns always count: mail addresses, IP addresses, payment cards and phone numbers. A
semi-Markov field adds what they miss. It scores candidate segments of up to ``MOST_ATOMS``
atoms (runs of letters, runs of digits, single other characters) by features of the whole
segment, such as its number of digits, its check digit, its grouping and what stands beside
it; a dynamic programme over all segmentations chooses boundaries and types together.

A segment must hold an ``@`` or ``LEAST_DIGITS`` digits in all. So only runs of neighbouring words
that each hold a digit or an ``@``, and together enough of them, can have one; every other
word is outside by constraint, and the best segmentation of a text is that of its runs.

The field is trained where it is used, by maximum likelihood on at most ``SAMPLE_TEXTS`` texts
with a pattern match and as many without, those of least hash, and the first ``RUN_ATOMS`` atoms
of their runs; the matches are its labels.

Defined results: a null or empty text has no spans; offsets are code points, ends exclusive;
an added span never overlaps a pattern's span of any kind; without a text to learn from only
the patterns count; rows that repeat are scanned one by one; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.llm.shared import least_hashed
from tierkit.llm.words import Words, column, map_slices, slices

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

MOST_ATOMS = 24
LEAST_DIGITS = 7
RUN_ATOMS = 400
SAMPLE_TEXTS = 250
ROUNDS = 150
_ATOM = re.compile(r"[A-Za-z]+|[0-9]+|[\x20\x09-\x0D]+|.", re.S)


def luhn(digits: str) -> bool:
    """Whether the last digit is the check digit of the others."""
    values = [int(c) for c in digits[::-1]]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _is_byte(digits: str) -> bool:
    short = digits.lstrip("0")
    return len(short) <= 3 and int(short or 0) <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def patterns(text: str) -> list[tuple[int, int, int]]:
    """``start, kind, end`` of the pattern matches in order."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        domain = _DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            found.append((begin, 0, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    for m in _IP.finditer(text):
        if all(_is_byte(p) for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        number = _digits(m[0])
        if 14 <= len(number) <= 19 and luhn(number):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


# --- features of a whole segment ----------------------------------------------------------

_SHAPE = (
    ["bias", *(f"digits{i}" for i in range(7)), "luhn", "at", "two_at", "local", "domain", "dots3", "bytes"]
    + ["plus", "plus_inside", "brackets", "open_bracket", "spaces", "dashes", "dots", "letters", "other"]
    + ["plain_number", "fours", "uneven_marks", "touches_digit", "touches_letter", "touches_mark", "after_mail"]
    + ["after_phone", "after_card", "after_ip", "outer_mark", "space_in_mail", "short_groups"]
)
_INDEX = {name: i for i, name in enumerate(_SHAPE)}
_NEAR = (
    ("after_mail", re.compile(r"mail|contact|write", re.I)),
    ("after_phone", re.compile(r"tel|phone|call|fax|mobil", re.I)),
    ("after_card", re.compile(r"card|visa|pay|iban|konto", re.I)),
    ("after_ip", re.compile(r"\bip\b|host|server|addr", re.I)),
)


def features(text: str, start: int, end: int) -> list[int]:
    """Indices of the features that ``text[start:end]`` has, as a whole and by its surroundings."""
    span = text[start:end]
    digits = _digits(span)
    groups = re.findall(r"[0-9]+", span)
    marks = set(re.sub(r"[A-Za-z0-9]+", "", span))
    n = len(digits)
    number = 0 if n < 7 else 1 if n < 10 else 2 if n < 12 else 3 if n < 14 else 4 if n < 16 else 5 if n < 20 else 6
    before, after = text[start - 1 : start], text[end : end + 1]
    lead = text[max(0, start - 24) : start]
    letters = any(c.isalpha() for c in span)
    mail = span.count("@")
    local, _, domain = span.partition("@")
    on = [name for name, yes in (
        ("luhn", 14 <= n <= 19 and luhn(digits)), ("at", mail == 1), ("two_at", mail > 1),
        ("local", mail == 1 and local and all(c in _LOCAL for c in local)),
        ("domain", mail == 1 and _DOMAIN.fullmatch(domain)),
        ("dots3", re.fullmatch(r"[0-9]+(\.[0-9]+){3}", span)),
        ("bytes", len(groups) == 4 and all(_is_byte(g) for g in groups)),
        ("plus", span[0] == "+"), ("plus_inside", "+" in span[1:]), ("brackets", "(" in span and ")" in span),
        ("open_bracket", span.count("(") != span.count(")")), ("spaces", " " in marks), ("dashes", "-" in marks),
        ("dots", "." in marks), ("letters", letters), ("other", marks - set(" -.()+@_%")),
        ("plain_number", span.isdigit()), ("fours", len(groups) > 2 and {len(g) for g in groups[:-1]} == {4}),
        ("uneven_marks", len(marks) > 1), ("short_groups", sum(len(g) == 1 for g in groups) > 2),
        ("touches_digit", before.isdigit() or after.isdigit()), ("touches_letter", before.isalpha() or after.isalpha()),
        ("touches_mark", (before and before in "._%+-@") or (after and after in "@_%-")),
        ("outer_mark", not span[-1].isalnum() or not (span[0].isalnum() or span[0] in "+(")),
        ("space_in_mail", mail and " " in marks), *((name, near.search(lead)) for name, near in _NEAR),
    ) if yes]
    return [_INDEX["bias"], _INDEX[f"digits{number}"], *(_INDEX[name] for name in on)]


def segments(text: str, atoms: list[tuple[int, int]]) -> list[tuple[int, int, list[int]]]:
    """Candidate segments of a run as first atom, atom after the last, and features."""
    out = []
    for i, (start, _) in enumerate(atoms):
        if text[start].isspace():
            continue
        digits = mails = 0
        for j in range(i, min(i + MOST_ATOMS, len(atoms))):
            a, b = atoms[j]
            if "\n" in text[a:b]:
                break
            digits += b - a if text[a] in "0123456789" else 0
            mails += text[a] == "@"
            if (mails or digits >= LEAST_DIGITS) and text[b - 1].isalnum():
                out.append((i, j + 1, features(text, start, b)))
    return out


# --- the field ----------------------------------------------------------------------------


class Field:
    """Semi-Markov field of order 0 over segments; an atom outside every segment scores 0."""

    def __init__(self):
        self.weight = np.zeros((len(_SHAPE), len(KINDS)))
        self.trained = False

    def fit(self, runs: list[tuple[int, list, list]]) -> Field:
        """Maximum likelihood from runs of ``number of atoms, segments, (segment, kind) of the truth``."""
        runs = [r for r in runs if r[1]]
        if not any(r[2] for r in runs):
            return self
        rows = np.zeros((sum(len(r[1]) for r in runs), len(_SHAPE)), np.float32)
        told, at, spans = np.zeros_like(self.weight), 0, []
        for n, some, truth in runs:
            for k, (i, j, on) in enumerate(some):
                rows[at + k, on] = 1
            for k, kind in truth:
                told[:, kind] += rows[at + k]
            spans.append((n, at, [(i, j) for i, j, _ in some]))
            at += len(some)
        momentum, square = np.zeros_like(told), np.zeros_like(told)
        for t in range(1, ROUNDS + 1):
            score = rows @ self.weight
            folded = np.logaddexp.reduce(score, axis=1)
            chance = np.zeros(len(rows))
            for n, first, ends in spans:
                own = folded[first : first + len(ends)]
                ahead, behind = _lattice(n, ends, own)
                for k, (i, j) in enumerate(ends):
                    chance[first + k] = np.exp(min(ahead[i] + own[k] + behind[j] - ahead[n], 0))
            share = np.exp(score - folded[:, None]) * chance[:, None]
            slope = (told - rows.T @ share - 0.3 * self.weight) / len(runs)
            momentum = 0.9 * momentum + 0.1 * slope
            square = 0.99 * square + 0.01 * slope**2
            self.weight += 0.15 * (momentum / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-8)
        self.trained = True
        return self

    def decode(self, n: int, some: list) -> list[tuple[int, int, int]]:
        """Segments ``first atom, atom after, kind`` of the best segmentation of a run."""
        best, back = [0.0] * (n + 1), [None] * (n + 1)
        ending: dict[int, list] = {}
        for i, j, on in some:
            score = self.weight[on].sum(axis=0)
            kind = int(score.argmax())
            if score[kind] > 0:
                ending.setdefault(j, []).append((i, kind, float(score[kind])))
        for j in range(1, n + 1):
            best[j] = best[j - 1]
            for i, kind, score in ending.get(j, ()):
                if best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, (i, kind)
        out, j = [], n
        while j > 0:
            if back[j]:
                out.append((back[j][0], j, back[j][1]))
                j = back[j][0]
            else:
                j -= 1
        return out[::-1]


def _lattice(n: int, ends: list[tuple[int, int]], score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log sums over all segmentations before and after each boundary."""
    ahead, behind = np.zeros(n + 1), np.zeros(n + 1)
    into, out = {}, {}
    for k, (i, j) in enumerate(ends):
        into.setdefault(j, []).append((i, k))
        out.setdefault(i, []).append((j, k))
    for j in range(1, n + 1):
        ways = into.get(j)
        ahead[j] = ahead[j - 1]
        if ways:
            ahead[j] = np.logaddexp.reduce([ahead[j - 1], *(ahead[i] + score[k] for i, k in ways)])
    for i in range(n - 1, -1, -1):
        ways = out.get(i)
        behind[i] = behind[i + 1]
        if ways:
            behind[i] = np.logaddexp.reduce([behind[i + 1], *(behind[j] + score[k] for j, k in ways)])
    return ahead, behind


# --- scanning -----------------------------------------------------------------------------


def _runs(w: Words):
    """Text number and byte range of each run of words that can hold a segment."""
    mail = np.flatnonzero(w.data == 64)
    digit = np.flatnonzero((w.data >= 48) & (w.data <= 57))
    word_of = lambda at: np.searchsorted(w.start, at, "right") - 1
    some = np.unique(word_of(np.concatenate((mail, digit))))
    if not len(some):
        return
    cut = np.flatnonzero((np.diff(some) > 1) | (np.diff(w.doc[some]) > 0)) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut, [len(some)])) - 1
    begin, end = w.start[some[first]], w.end[some[last]]
    enough = np.searchsorted(digit, end) - np.searchsorted(digit, begin) >= LEAST_DIGITS
    enough |= np.searchsorted(mail, end) > np.searchsorted(mail, begin)
    for i in np.flatnonzero(enough):
        yield int(w.doc[some[first[i]]]), int(begin[i]), int(end[i])


def _may_match(w: Words) -> np.ndarray:
    flag = np.zeros(len(w.n), bool)
    hits = np.flatnonzero(((w.data >= 48) & (w.data <= 57)) | (w.data == 64))
    flag[np.searchsorted(w.bounds[1:], hits, "right")] = True
    return flag


def _points(w: Words):
    """Code point offset in its text of a byte offset in the slice."""
    tails = np.flatnonzero((w.data & 0xC0) == 0x80)

    def offset(d: int, byte: int) -> int:
        begin = int(w.bounds[d])
        low, high = np.searchsorted(tails, (begin, byte))
        return byte - begin - int(high - low)

    return offset


def _atoms(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in _ATOM.finditer(text, start, end)]


def scan(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id``, counts and spans of the patterns, and all spans; a span is ``kind:start:end``."""
    shipped = docs.sparkSession.sparkContext.broadcast(learn(docs) if field is None else field)

    def work(part: pa.RecordBatch) -> pa.RecordBatch:
        w = Words(part.column("text"))
        texts = part.column("text").to_pylist()
        base = [[] for _ in texts]
        for d in np.flatnonzero(_may_match(w)):
            base[d] = patterns(texts[d])
        added = [[] for _ in texts]
        field, offset = shipped.value, _points(w)
        for d, begin, end in _runs(w) if field.trained else ():
            start, stop = offset(d, begin), offset(d, end)
            taken = [b for b in base[d] if b[0] < stop and b[2] > start]
            atoms = _atoms(texts[d], start, stop)
            for i, j, kind in field.decode(len(atoms), segments(texts[d], atoms)):
                a, b = atoms[i][0], atoms[j - 1][1]
                if all(b <= t[0] or a >= t[2] for t in taken):
                    added[d].append((a, kind, b))
        text = lambda found: ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))
        count = lambda kind: column(np.array([sum(b[1] == kind for b in one) for one in base], np.int64))
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": part.column("doc_id"),
                **{f"n_{name}": count(kind) for kind, name in enumerate(KINDS)},
                "n_added": column(np.array([len(a) for a in added], np.int64)),
                "base": pa.array([text(b) for b in base], pa.string()),
                "spans": pa.array([text(b + a) for b, a in zip(base, added)], pa.string()),
            }
        )

    return map_slices(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        work,
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_added long, base string, spans string",
    )


def learn(docs: DataFrame) -> Field:
    """A field trained on a bounded sample: texts with a pattern match, and texts with other runs."""

    def label(batches):
        for part in slices(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            w = Words(part.column("text"))
            kinds = [0] * len(texts)
            for d, _, _ in _runs(w):
                kinds[d] = 1
            kinds = [2 if k and patterns(t) else k for k, t in zip(kinds, texts)]
            yield pa.RecordBatch.from_pydict({"kind": pa.array(kinds, pa.int32()), "text": pa.array(texts, pa.string())})

    marked = docs.select("text").filter("length(text) < 20000").mapInArrow(label, "kind int, text string")
    rows = least_hashed(marked, SAMPLE_TEXTS, 4)
    runs = []
    for row in rows:
        text = row["text"]
        w = Words(pa.array([text]))
        offset, base = _points(w), patterns(text)
        for d, begin, end in _runs(w):
            atoms = _atoms(text, offset(d, begin), offset(d, end))[:RUN_ATOMS]
            some = segments(text, atoms)
            place = {(atoms[i][0], atoms[j - 1][1]): k for k, (i, j, _) in enumerate(some)}
            truth, used = [], 0
            for a, kind, b in base:
                if (a, b) in place and a >= used:
                    truth.append((place[a, b], kind))
                    used = b
            runs.append((len(atoms), some, truth))
    return Field().fit(runs)
