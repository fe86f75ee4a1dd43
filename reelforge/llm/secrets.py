"""Secret scans: fixed patterns, and guess costs of values in a credential context.

A value after a credential name is cut into words, dates, repeats, keyboard walks, sequences and brute-force
characters; dynamic programming finds the cut of least cost in bits. Every such value is scored, also one inside a span of the
fixed patterns (assign, access, hex), and reported with its bits; those that cost THRESHOLD_BITS or more are spans of
kind 'guess', beside the base spans, which are never changed.

Defined cases: a null or empty text has no span and no value; every value is read whole, whatever its length: between quotes
with all white space and marks (a quote that its line does not close ends at white space, unless tripled), and its cost takes
time in proportion to the length; very long texts are scanned whole; of cuts that cost the same only the cost is told; equal
spans of several kinds are all listed, in the order of KINDS; repeated rows and rows with equal ids are rows of their own; an
empty table gives no row; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

THRESHOLD_BITS = 36.0
KINDS = ("assign", "access", "hex", "guess")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
# A maximal run is one match of the plain pattern, so the least length can stand in the pattern itself.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
_HEX = re.compile(r"[0-9a-f]{16,}")
# A value is what stands between quotes, or else runs up to white space; without an opening quote marks of lists and calls end it too.
_CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|credentials?|auth[_-]?key|private[_-]?key|access[_-]?key)["']?\s{0,3}(?:=>|:=|[:=])\s{0,3}(?:"""
    r"""\"{3}([^"\\]*(?:(?:\\[\s\S]|"(?!""))[^"\\]*)*)\"{3}|'{3}([^'\\]*(?:(?:\\[\s\S]|'(?!''))[^'\\]*)*)'{3}|"""
    r""""([^"\\\r\n]*(?:\\.[^"\\\r\n]*)*)"|'([^'\\\r\n]*(?:\\.[^'\\\r\n]*)*)'|"([^"\r\n]*)"|'([^'\r\n]*)'|"""
    r""""([^\s"]+)|'([^\s']+)|([^\s"'<>,;()]{6,}))""",
    re.IGNORECASE | re.ASCII,
)
LEAST_VALUE = 6

# Words that guessers try first, the likelier ones first.
COMMON_WORDS = (
    "password", "admin", "welcome", "letmein", "dragon", "monkey", "master", "login", "secret", "shadow", "hello", "test", "user", "root", "guest", "default", "changeme",
    "example", "sample", "none", "null", "true", "false", "your", "token", "key", "pass", "word", "super", "love", "princess", "sunshine", "football", "baseball", "summer",
    "winter", "spring", "autumn", "monday", "friday", "january", "december", "company", "server", "system", "manager", "public", "private", "access", "change", "please",
    "enter", "here", "insert", "value", "string", "placeholder", "dummy", "michael", "daniel", "jordan", "hunter", "soccer", "batman", "freedom", "computer", "internet",
    "service", "account", "data", "base", "home", "house", "black", "white", "green", "blue", "orange", "silver", "golden", "tiger", "lion", "eagle", "falcon", "star", "moon",
    "horse", "battery", "staple", "correct", "the", "and", "for", "with", "this", "that", "from", "not", "you", "are", "was", "new", "old", "one", "two", "three",
)
# Rows of a keyboard.
KEYBOARD = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")

_RANK = {w: k + 2 for k, w in enumerate(COMMON_WORDS)}
_PLACE = {c: (x + y * 0.5, y) for y, row in enumerate(KEYBOARD) for x, c in enumerate(row)}
_YEAR4, _YEAR2, _MONTH, _DAY = r"(?:19|20)\d\d", r"\d\d", r"(?:0[1-9]|1[0-2])", r"(?:0[1-9]|[12]\d|3[01])"
#: All forms of dates, each of one length: the order of its parts, with or without marks between them.
_DATES = [
    re.compile(a + x + b + y + c)
    for a, b, c in ((_YEAR4, _MONTH, _DAY), (_DAY, _MONTH, _YEAR4), (_DAY, _MONTH, _YEAR2))
    for x in ("", "[-/.]")
    for y in ("", "[-/.]")
]
_YEAR = re.compile(_YEAR4)
_LONGEST_WORD, _LONGEST_UNIT = 24, 6
#: Each part of a cut costs this much more, for the order in which a guesser must combine parts.
PART_BITS = 1.0
DATE_BITS, YEAR_BITS = math.log2(365 * 130), math.log2(150)
#: (bits of the start, bits of each further character) of keyboard walks, rising and falling sequences.
RUN_BITS = ((math.log2(47), 1.6), (math.log2(36), 0.1), (math.log2(36), 0.2))


def _char_bits(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    return math.log2(26) if c.isalpha() else math.log2(33)


def adjacent(a: str, b: str) -> bool:
    """Neighbours on a keyboard."""
    p, q = _PLACE.get(a), _PLACE.get(b)
    return p is not None and q is not None and a != b and abs(p[0] - q[0]) <= 1.0 and abs(p[1] - q[1]) <= 1


#: Which neighbouring characters a walk, a rising and a falling sequence may hold.
RUNS = (adjacent, lambda a, b: ord(b) - ord(a) == 1, lambda a, b: ord(a) - ord(b) == 1)


class _LeastBefore:
    """Least value pushed among the places at or after a moving start."""

    def __init__(self):
        self.held: deque[tuple[int, float]] = deque()

    def push(self, place: int, value: float) -> None:
        while self.held and self.held[-1][1] >= value:
            self.held.pop()
        self.held.append((place, value))

    def least(self, start: int) -> float:
        while self.held and self.held[0][0] < start:
            self.held.popleft()
        return self.held[0][1] if self.held else math.inf


def guess_bits(value: str, words: frozenset[str] = frozenset()) -> float:
    """Least cost in bits over all cuts of value; words are further words that a guesser would know.

    A part costs PART_BITS and
    - as a word of COMMON_WORDS (3 letters or more) or of words (4 to 24): the bits of its rank or of their number, and up
      to 2 for capitals;
    - as a date DATE_BITS, as a year YEAR_BITS;
    - as a walk or sequence of 3 characters or more: RUN_BITS;
    - as a repeat (a unit of up to 6 characters, twice at least, its last copy whole or not, 3 characters or more): the bits
      of the unit's characters and the length in bits of the number of whole copies;
    - as brute force: the bits of its characters.

    Costs of runs and brute force grow by the same amount a character, so their least cost is carried from end to end;
    repeats cost alike while the number of copies has the same length in bits, so the least cost before them is that of
    a window. Thus all cuts are weighed in time in proportion to the value.
    """
    lower, n, inf = value.lower(), len(value), math.inf
    if len(lower) != n:  # a few letters become two when lowered
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    best = [0.0] + [inf] * n  # least cost of value[:i]; what begins at i is offered when best[i] is final
    brute, runs, since = inf, [inf] * len(RUNS), [0] * len(RUNS)  # carried costs, and where each run began
    # by unit length: where the stretch with that period began, and windows by length in bits of the number of copies
    periods: list[tuple[int, list[_LeastBefore]]] = [(0, []) for _ in range(_LONGEST_UNIT)]
    for end in range(1, n + 1):
        for j, bits in _known_parts(value, lower, end - 1, words):
            best[j] = min(best[j], best[end - 1] + PART_BITS + bits)
        brute = min(brute, best[end - 1] + PART_BITS) + _char_bits(value[end - 1])
        least = min(best[end], brute)
        for k, (near, (start, turn)) in enumerate(zip(RUNS, RUN_BITS, strict=True)):
            if end == 1 or not near(lower[end - 2], lower[end - 1]):
                runs[k], since[k] = inf, end - 1
                continue
            runs[k] += turn
            if end - 3 >= since[k]:
                runs[k] = min(runs[k], best[end - 3] + PART_BITS + start + 2 * turn)
            least = min(least, runs[k])
        for k in range(1, min(_LONGEST_UNIT, end - 1) + 1):
            if lower[end - 1] != lower[end - 1 - k]:
                periods[k - 1] = (end - k, [])
                continue
            begun, windows = periods[k - 1]  # value[i:end] has this period for all i from begun on
            unit, b = sum(map(_char_bits, value[end - k : end])), 1
            while (at := end - max(k << b, 3)) >= begun:  # 2^b to 2^(b + 1) - 1 copies
                if len(windows) < b:
                    windows.append(_LeastBefore())
                windows[b - 1].push(at, best[at])
                least = min(least, windows[b - 1].least(end - (k << b + 1) + 1) + PART_BITS + unit + b + 1)
                b += 1
        best[end] = least
    return best[n]


def _known_parts(value: str, lower: str, at: int, words: frozenset[str]) -> Iterator[tuple[int, float]]:
    """(end, bits) of the words, dates and years that begin at a place."""
    capital, known = 0, math.log2(len(words) + len(_RANK) + 2)
    for j in range(at + 1, min(len(value), at + _LONGEST_WORD) + 1):
        if not lower[j - 1].isalpha():
            break
        capital += value[j - 1].isupper()
        if j - at >= 3 and (w := lower[at:j]) in _RANK:
            yield j, math.log2(_RANK[w]) + min(capital, 2)
        elif j - at >= 4 and w in words:
            yield j, known + min(capital, 2)
    if lower[at].isdigit():
        for form in _DATES:
            if m := form.match(lower, at):
                yield m.end(), DATE_BITS
        if m := _YEAR.match(lower, at):
            yield m.end(), YEAR_BITS


class Value(NamedTuple):
    """A value in a credential context: code points, end exclusive, and its least guess cost."""

    start: int
    end: int
    bits: float


def values(text: str) -> list[Value]:
    """All values of LEAST_VALUE characters or more in a credential context, scored whole."""
    found, words = [], None
    for m in _CONTEXT.finditer(text):
        a, b = m.span(m.lastindex)
        if b - a < LEAST_VALUE:
            continue
        if words is None:
            words = frozenset(re.findall(r"[^\W\d_]{4,24}", text.lower()))
        value = m[m.lastindex]
        found.append(Value(a, b, guess_bits(value, words - {value.lower()})))
    return found


def spans(text: str, threshold: float = THRESHOLD_BITS, scored: list[Value] | None = None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start and then kind; code points, end exclusive. scored: values(text), if they are known."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    found += [("guess", v.start, v.end) for v in (values(text) if scored is None else scored) if v.bits >= threshold]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def _scan(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            scored = [values(t) for t in texts]
            all_of = [spans(t, threshold, v) for t, v in zip(texts, scored, strict=True)]
            base = [[s for s in found if s[0] != "guess"] for found in all_of]
            counts = [pa.array([sum(s[0] == k for s in found) for found in all_of], pa.int64()) for k in KINDS]
            digests = [hashlib.sha256(_joined(found).encode()).hexdigest() for found in base]
            rows = pa.array([[v._asdict() for v in held] for held in scored], _VALUES)
            yield pa.RecordBatch.from_arrays([b.column(0), *counts, pa.array(digests, pa.string()), pa.array([_joined(f) for f in all_of], pa.string()), rows], _NAMES)

    return run


_NAMES = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "values"]
_VALUES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("bits", pa.float64())]))


def scan(docs: DataFrame, threshold: float = THRESHOLD_BITS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_guess, base_sha256, spans and scored values of every whole text."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return d.mapInArrow(
        _scan(threshold),
        "doc_id long, n_assign long, n_access long, n_hex long, n_guess long, base_sha256 string, spans string, values array<struct<start:long,end:long,bits:double>>",
    )


def redacted(text: str | None, threshold: float = THRESHOLD_BITS, mark: str = "[SECRET]") -> str | None:
    """The text with every found span, overlapping ones as one, replaced by mark."""
    if not text:
        return text
    out, at = [], 0
    end = -1
    for _, a, b in spans(text, threshold):
        if a >= end:
            out += [text[at:a], mark]
        end = at = max(end, b)
    return "".join(out) + text[at:] if out else text


def _redact(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [redacted(t, threshold) for t in b.column(1).to_pylist()]
            n = [None if t is None else len(t) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), b.column(2), b.column(3), pa.array(n, pa.int64())], ["doc_id", "text", "lang", "source", "n_chars"])

    return run


def redact(docs: DataFrame, threshold: float = THRESHOLD_BITS) -> DataFrame:
    """documents with secrets replaced in the text and n_chars counted anew; every row stays."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"))
    return d.mapInArrow(_redact(threshold), "doc_id long, text string, lang string, source string, n_chars long")
