"""Operator 1, token counts: byte-level BPE by a heap of pairs over a linked list of symbols.

A text is cut into the added tokens that occur in it (one token each, as the library does by
default) and, between them, into the pre-tokens of the byte-level pattern. Of each pre-token the
adjacent pair of lowest rank is merged, again and again; its count is its bytes minus its merges.
No identifiers are produced. Counts of short pre-tokens are remembered in a bounded table, which
changes nothing but the time.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); a null key stays null; repeated
rows give repeated rows; a very long text is counted whole, a long pre-token in time n log n; of pairs
of one rank the leftmost is merged first; an empty table gives an empty table of the same columns;
other columns may have any names.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache
from heapq import heappop, heappush

import regex
from pyspark.sql import DataFrame

from strandseek.llm._text import map_texts, picked

#: Pre-token counts kept in memory by a worker; beyond that the table starts anew.
REMEMBERED = 400_000
SHORT = 64
#: The pattern of byte-level pre-tokens, its most common alternatives first (they begin with
#: other characters than the contractions do); the white space is spelt out as the library takes it.
SPACES = r"\t-\r\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
PATTERN = "[ ]?[{L}]+|[ ]?[{N}]+|'(?:s|t|re|ve|m|ll|d)|[ ]?[^{S}{L}{N}]+|[{S}]+(?![^{S}])|[{S}]+"
#: The letters and numbers below U+0250, for texts with no other characters.
LATIN_LETTERS, LATIN_NUMBERS = r"A-Za-z\xAA\xB5\xBA\xC0-\xD6\xD8-\xF6\xF8-\u024F", r"0-9\xB2\xB3\xB9\xBC-\xBE"


def pattern(letters: str, numbers: str) -> str:
    return PATTERN.replace("{L}", letters).replace("{N}", numbers).replace("{S}", SPACES)


def visible_bytes() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary, as character -> byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class MergeCounter:
    """Counts the tokens of whole texts under one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, self.known = spec["model"]["vocab"], {}
        self.of_byte = [0] * 256
        for c, b in visible_bytes().items():
            self.of_byte[b] = vocab[c]
        #: left symbol << 24 | right symbol -> rank << 24 | merged symbol
        self.merge: dict[int, int] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merge.setdefault(vocab[a] << 24 | vocab[b], rank << 24 | vocab[a + b])
        added = sorted((x["content"] for x in spec.get("added_tokens") or []), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.find = regex.compile(pattern(r"\p{L}", r"\p{N}")).findall
        self.find_latin = re.compile(pattern(LATIN_LETTERS, LATIN_NUMBERS)).findall
        self.beyond_latin = re.compile("[^\0-\u024F]").search

    def word(self, data: bytes) -> int:
        """Initial symbols minus merges. A heap entry is rank << 24 | merged symbol, << 40, | place."""
        n = len(data)
        if n < 2:
            return n
        get, of_byte = self.merge.get, self.of_byte
        symbol = [of_byte[b] for b in data]
        heap = []
        for k in range(n - 1):
            if (found := get(symbol[k] << 24 | symbol[k + 1])) is not None:
                heap.append(found << 40 | k)
        if not heap:
            return n
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        merges = 0
        while heap:
            entry = heappop(heap)
            k = entry & 0xFFFFFFFFFF
            right = after[k]
            if symbol[k] < 0 or right >= n or get(symbol[k] << 24 | symbol[right]) != entry >> 40:
                continue  # the pair has changed since it was pushed
            symbol[k] = merged = entry >> 40 & 0xFFFFFF
            symbol[right] = -1
            after[k] = follow = after[right]
            merges += 1
            if follow < n:
                before[follow] = k
                if (more := get(merged << 24 | symbol[follow])) is not None:
                    heappush(heap, more << 40 | k)
            left = before[k]
            if left >= 0 and (more := get(symbol[left] << 24 | merged)) is not None:
                heappush(heap, more << 40 | left)
        return n - merges

    def plain(self, text: str) -> int:
        known, total = self.known, 0
        for x in (self.find if self.beyond_latin(text) else self.find_latin)(text):
            count = known.get(x)
            if count is None:
                count = self.word(x.encode())
                if len(x) <= SHORT:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[x] = count
            total += count
        return total

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if self.added is None or not self.added.search(text):
            return self.plain(text)
        parts = self.added.split(text)
        return len(parts) - 1 + sum(self.plain(x) for x in parts if x)


@lru_cache(maxsize=4)
def counter(path: str) -> MergeCounter:
    """One counter a worker and file."""
    return MergeCounter(path)


def token_counts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens) of every row.

    ``vocabulary`` is the path, on every executor, of a byte-level BPE file in JSON.
    """

    def count(keys: list, texts: list) -> dict[str, list]:
        f = counter(vocabulary)
        n = [f(x) for x in texts]
        return {"doc_id": keys, "n_bytes": [len((x or "").encode()) for x in texts], "n_tokens": n, "over_limit": [k > limit for k in n]}

    return map_texts(picked(docs, key, text), count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
