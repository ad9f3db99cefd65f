"""Operator 6, secret scans: fixed patterns, and a battery of randomness tests on other tokens.

Base matches come from three patterns. Beside them, every run of token characters with letters and
digits is read in the encoding that its characters imply (hex, base32, base62 or base64). Three
tests ask whether its symbols look uniform and independent: chi-squared of the symbols over the
alphabet, runs about the alphabet's middle, and serial correlation; Fisher's method combines them.
A run that fits no alphabet, or fails, is tried again by its parts between signs (a key in a path).

A token passes if the battery doesn't reject it AND ordinary text of its length would hardly look
so. That has a p-value of its own, by Fisher's method from two tests: under the skewed symbol
frequencies of prose the chi-squared value is noncentral, with a noncentrality that grows with the
length, so a random token lies in its lower tail; and ordinary tokens seldom change between letters
and digits or from lower to upper case, so a random token has more runs of these classes than the
binomial of its length allows. False discoveries are controlled over the whole corpus, for each range
of lengths by itself (``LENGTHS``): a first pass counts the p-values of all tokens in eighths of a
decade, those that the battery rejects among them with a p-value of 1, and Benjamini and Hochberg's procedure on
the counts says how small one must be; a range without tokens keeps ``FALSE_SHARE`` itself. So what
``scan`` and ``redact`` find depends on all texts of the frame; a lone text is held against
``FALSE_SHARE`` itself.

Defined cases: a null text counts as empty (no spans); a null key stays null; repeated rows give
repeated rows, and count each in the control; a very long text is scanned whole; an empty table gives
an empty table of the same columns; other columns may have any names. Where a base span and a random
one would overlap the base span stays alone.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from math import comb, erfc, exp, log, log10, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandseek.llm._text import PART as TEXTS
from strandseek.llm._text import column, map_texts, picked, ranges, text_udf

KINDS = ("assign", "access", "hex", "random")
#: The base patterns; letters of the names in either case, ASCII only.
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs of a class: the same as [0-9a-f]+ filtered by length
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}")
DIGIT, LETTER = re.compile("[0-9]").search, re.compile("[A-Za-z]").search
#: Encodings in the order of their tests: name, alphabet in order, and the sum of squares of its symbols' frequencies in prose.
ALPHABETS = (
    ("hex", "0123456789abcdef", 0.095),
    ("HEX", "0123456789ABCDEF", 0.095),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 0.060),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 0.055),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 0.055),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", 0.055),
)
REJECT, FALSE_SHARE = 0.001, 0.01
#: How often neighbours in ordinary tokens differ in class, in one case and in both.
CHANGES = {1: 0.1, 2: 0.2}
LEAST = 20
PART = re.compile(f"[A-Za-z0-9]{{{LEAST},}}")
#: Where each range of token lengths begins, the bins of p-values in a decade, and the last bin.
LENGTHS, BINS, LAST_BIN = (LEAST, 24, 32, 40, 64), 8, 160


def normal_tail(z: float) -> float:
    return 0.5 * erfc(z / sqrt(2))


def chi_squared_tail(x: float, df: float) -> float:
    """Upper tail, by Wilson and Hilferty's approximation."""
    return normal_tail(((max(x, 0) / df) ** (1 / 3) - (1 - 2 / (9 * df))) / sqrt(2 / (9 * df)))


def fisher(ps: list[float]) -> float:
    """Fisher's combined p-value: the tail of chi-squared with 2 len(ps) degrees of freedom, in closed form."""
    half = -sum(log(max(p, 1e-300)) for p in ps)
    term = total = 1.0
    for k in range(1, len(ps)):
        term *= half / k
        total += term
    return min(1.0, exp(-half) * total)


def binomial_tail(k: int, n: int, p: float) -> float:
    """The probability of at least k of n; of many by the normal approximation."""
    if n > 500:
        return normal_tail((k - 0.5 - n * p) / sqrt(n * p * (1 - p)))
    return min(1.0, sum(comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k, n + 1)))


def changes(token: str) -> int:
    """Neighbours that differ in class; a capital before a small letter begins a word and is none."""
    kinds = "".join("d" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else "" for c in token)
    return sum(x != y and x + y != "Aa" for x, y in zip(kinds, kinds[1:], strict=False))


def battery(token: str) -> tuple[str, float, float] | None:
    """The encoding inferred, the battery's p-value (small: not random), and the p-value of ordinary text (small: not text)."""
    for name, alphabet, squares in ALPHABETS:
        if not token.strip(alphabet):
            break
    else:
        return None
    x = np.array([alphabet.index(c) for c in token])
    n, a = len(x), len(alphabet)
    chi = a / n * float((np.bincount(x, minlength=a).astype(float) ** 2).sum()) - n
    uniform = 2 * min(chi_squared_tail(chi, a - 1), 1 - chi_squared_tail(chi, a - 1))
    high = x >= a // 2
    up = int(high.sum())
    if 0 < up < n:
        mean = 1 + 2 * up * (n - up) / n
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        runs = erfc(abs(1 + int((high[1:] != high[:-1]).sum()) - mean) / sqrt(2 * var))
    else:
        runs = 2.0 ** (1 - n)
    y = x - x.mean()
    spread = float((y * y).sum())
    serial = erfc(abs(float((y[1:] * y[:-1]).sum()) / spread * n + 1) / sqrt(2 * n)) if spread else 0.0
    beyond = n * (a * squares - 1)
    even = normal_tail(-(chi - (a - 1) - beyond) / sqrt(2 * (a - 1 + 2 * beyond)))
    mixed = binomial_tail(changes(token), n - 1, CHANGES[2 if a > 32 else 1])
    return name, fisher([uniform, runs, serial]), fisher([even, mixed])


def merged(spans: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of spans, overlapping ones as one, in order."""
    starts, ends = [], []
    for a, b in sorted(spans):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def tested(text: str, taken: list[tuple[int, int]], reject: float = REJECT) -> list[tuple[float, int, int]]:
    """(p-value, start, end) of every token outside the taken spans that the battery tests.

    The p-value is that of ordinary text, or 1 if the battery rejects the token. Of ordinary text, so, no more than
    a share p has a p-value up to p, whatever the battery keeps: nothing is selected before it is counted.
    """
    out, (starts, ends) = [], merged(taken)

    def passes(a: int, token: str) -> bool:
        b = a + len(token)
        if len(token) < LEAST or not (DIGIT(token) and LETTER(token)):
            return False
        at = bisect.bisect_left(starts, b)  # the last span that begins before the token ends
        if (at and ends[at - 1] > a) or not (found := battery(token)):
            return False
        out.append((1.0 if found[1] < reject else found[2], a, b))
        return found[1] >= reject

    for m in CANDIDATE.finditer(text):
        token = m[0].strip("-_/+")
        at = m.start() + m[0].find(token) if token else 0
        if not passes(at, token) and not token.isalnum():
            for part in PART.finditer(token):
                passes(at + part.start(), part[0])
    return out


def bin_of(p: float) -> int:
    return min(LAST_BIN, int(-BINS * log10(max(p, 1e-30))))


def range_of(length: int) -> int:
    return sum(length >= x for x in LENGTHS) - 1


#: What a lone text is held against.
ALONE = tuple(-int(BINS * log10(FALSE_SHARE)) for _ in LENGTHS)


def random_spans(text: str, taken: list[tuple[int, int]], limits: tuple[int, ...] = ALONE, reject: float = REJECT) -> list[tuple[int, int]]:
    """Tokens outside the taken spans that pass the battery and whose p-values reach the bin that their length asks for."""
    return sorted((a, b) for p, a, b in tested(text, taken, reject) if bin_of(p) >= limits[range_of(b - a)])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the fixed patterns."""
    spans, low = [], text.lower()
    if any(x in low for x in NAMES):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    return spans + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


def secret_spans(text: str | None, limits: tuple[int, ...] = ALONE) -> list[tuple[int, str, int]]:
    """(start, kind, end) in code points, by start and then by kind as listed."""
    if not text:
        return []
    spans = base_spans(text)
    spans += [(a, 3, b) for a, b in random_spans(text, [(a, b) for a, _, b in spans], limits)]
    return [(a, KINDS[k], b) for a, k, b in sorted(spans)]


def limits_of(texts: DataFrame, false_share: float = FALSE_SHARE) -> tuple[int, ...]:
    """For each range of lengths the least bin whose tokens are discoveries, over all texts of a frame of one column.

    What reaches the driver is a count for each range and bin.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: Counter = Counter()
        for b in batches:
            for i, j in ranges(b.column(0), TEXTS):
                for x in b.column(0).slice(i, j - i).to_pylist():
                    if x and CANDIDATE.search(x):
                        count.update((range_of(e - s), bin_of(p)) for p, s, e in tested(x, [(s, e) for s, _, e in base_spans(x)]))
        rows = sorted(count.items())
        yield pa.RecordBatch.from_arrays([pa.array([x[0][0] for x in rows], pa.int32()), pa.array([x[0][1] for x in rows], pa.int32()), pa.array([x[1] for x in rows], pa.int64())], names=["range", "bin", "n"])

    counts = texts.mapInArrow(run, "range int, bin int, n long").groupBy("range", "bin").agg(F.sum("n").alias("n")).collect()
    out = []
    for k in range(len(LENGTHS)):
        mine = {r["bin"]: r["n"] for r in counts if r["range"] == k}
        total, least, up = sum(mine.values()), LAST_BIN + 1 if mine else ALONE[k], 0
        for b in sorted(mine, reverse=True):
            up += mine[b]
            if 10 ** (-b / BINS) <= false_share * up / total:
                least = b
        out.append(least)
    return tuple(out)


def said(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 (of the base spans as text) and spans (all of them as text)."""
    rows = picked(docs, key, text)
    limits = limits_of(rows.select("text"))

    def run(keys: list, texts: list) -> dict[str, list]:
        every = [secret_spans(x, limits) for x in texts]
        base = [[x for x in spans if x[1] != "random"] for spans in every]
        out = {f"n_{k}": [sum(x[1] == k for x in spans) for spans in base] for k in KINDS[:3]}
        return {"doc_id": keys, **out, "base_sha256": [hashlib.sha256(said(x).encode()).hexdigest() for x in base], "spans": [said(x) for x in every]}

    return map_texts(rows, run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def without_spans(text: str, mark: str, limits: tuple[int, ...] = ALONE) -> str:
    out, at = [], 0
    for a, _, b in secret_spans(text, limits):
        if a >= at:
            out += [text[at:a], mark]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]", size: str | None = None) -> DataFrame:
    """The same rows and columns, each secret span of the text replaced by a mark (``size``: a column of the text's length to renew)."""

    limits = limits_of(docs.select(column(text).cast("string").alias("text")))
    hidden = text_udf(lambda texts: [None if x is None else without_spans(x, mark, limits) for x in texts], "string", pa.string())
    now = {text: hidden(column(text).cast("string")).alias(text)}
    rows = docs.select(*[now.get(c, column(c)) for c in docs.columns])
    if size is None:
        return rows
    return rows.select(*[F.length(column(text)).cast(dict(docs.dtypes)[size]).alias(c) if c == size else column(c) for c in docs.columns])
