"""Operator 9, quality rules: repetition coverage by rolling hashes of several n-gram lengths.

Word n-grams are hashed for a whole block of texts at a time in numpy (each text's own key keeps
texts apart); an n-gram that is found twice or more in its text marks its words, the first
occurrence included. A longer n-gram is only looked at where the shorter one is repeated, which
loses nothing. A text fails if it is too short, if its repeated 3-word windows cover too many
words, or if the characters inside repeated n-grams of some length, or inside lines that repeat an
earlier one, exceed their share of all word characters.

Defined cases: a null or empty text has no words and isn't kept; a null key stays null; repeated
rows give repeated rows; a very long text is measured whole, alone in its block; an empty table gives
an empty table of the same columns; other columns may have any names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from strandseek.llm._text import Packed, U, chunks, encode, map_texts, mix, picked, spread

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
SPACES = b" \t\n\v\f\r"
BASE = 3
#: Largest share of word characters inside repeated n-grams, by n, and inside lines that repeat an earlier one.
#: Usual rules allow 0.15, 0.13 and 0.10 where only later occurrences count; here all do, so twice as much.
COVERAGE = {5: 0.30, 7: 0.26, 10: 0.20}
LINE_COVERAGE = 0.20
MIN_WORDS, BASE_PERCENT = 50, 50
BLOCK = 1 << 20


def repeated(keys: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Of the places ``at``, those whose key occurs twice or more among them."""
    if len(at) < 2:
        return at[:0]
    mine = keys[at]
    order = np.argsort(mine, kind="stable")
    mine = mine[order]
    same = mine[1:] == mine[:-1]
    twice = np.zeros(len(at), bool)
    twice[1:] = same
    twice[:-1] |= same
    return np.sort(at[order[twice]])


def counted(per_place: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of per_place over [begin, end) ranges."""
    total = np.concatenate(([0], np.cumsum(per_place, dtype=np.int64)))
    return total[ends] - total[begins]


def line_repeats(data: bytes) -> tuple[int, int]:
    """Lines with a word that equal an earlier line, and the word characters in them."""
    if data.count(b"\n") == 0:
        return 0, 0
    seen, n, size = set(), 0, 0
    for line in data.split(b"\n"):
        if line in seen:
            n += 1
            size += len(line.decode(errors="replace")) - sum(map(line.count, (b" ", b"\t", b"\v", b"\f", b"\r")))
        elif line.strip(SPACES):
            seen.add(line)
    return n, size


def measure(texts: list[bytes], coverage: dict[int, float] = COVERAGE) -> dict[str, np.ndarray]:
    """The measures of each text of a block."""
    p = Packed(texts)
    letters = np.concatenate(([0], np.cumsum((p.buf & 0xC0) != 0x80)))
    size = letters[p.word_end] - letters[p.word_start]
    first, last = p.first_word[:-1], p.first_word[1:]
    out = {"n_words": p.n_words, "word_chars": counted(size, first, last)}
    out["n_symbols"] = counted(SYMBOLS[p.buf], p.begins, p.ends)
    lines = [line_repeats(x) for x in texts]
    out["n_dup_lines"], out["dup_line_chars"] = (np.array([x[k] for x in lines], np.int64).reshape(len(texts)) for k in (0, 1))
    words = p.word_hashes()
    own = mix(p.word_doc.astype(U) + U(1))
    at = np.arange(len(words))
    for n in (BASE, *sorted(coverage)):
        keys = p.window_hashes(words, n) ^ own
        at = repeated(keys, at[p.windows(n)[at]])
        mark = spread(at, n, len(words))
        if n == BASE:
            out["n_repeat_words"] = counted(mark, first, last)
        else:
            out[f"dup_{n}_chars"] = counted(np.where(mark, size, 0), first, last)
    return out


def verdict(m: dict[str, np.ndarray], coverage: dict[int, float] = COVERAGE, lines: float = LINE_COVERAGE) -> tuple[np.ndarray, np.ndarray]:
    """Whether the base rules fail, and whether the text is kept."""
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > BASE_PERCENT * m["n_words"])
    over = m["dup_line_chars"] > lines * m["word_chars"]
    for n, share in coverage.items():
        over |= m[f"dup_{n}_chars"] > share * m["word_chars"]
    return failed, ~failed & ~over


def quality(docs: DataFrame, key: str = "doc_id", text: str = "text", coverage: dict[int, float] = COVERAGE, lines: float = LINE_COVERAGE) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, and the characters inside repeated lines and n-grams of each length."""
    more = ["dup_line_chars", *(f"dup_{n}_chars" for n in coverage)]
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def run(keys: list, texts: list) -> dict[str, list]:
        data = encode(texts)
        parts = [measure(data[a:b], coverage) for a, b in chunks(data, BLOCK)]
        m = {k: np.concatenate([x[k] for x in parts]) for k in [*names, *more]}
        failed, kept = verdict(m, coverage, lines)
        return {"doc_id": keys} | m | {"base_failed": failed, "kept": kept}

    longs = ", ".join(f"{k} long" for k in names)
    return map_texts(picked(docs, key, text), run, f"doc_id long, {longs}, base_failed boolean, kept boolean, {', '.join(f'{k} long' for k in more)}")


def quality_sql(coverage: dict[int, float] = COVERAGE, lines: float = LINE_COVERAGE) -> str:
    """The same in SQL."""
    own = ", ".join(f"CAST(coalesce(sum(len(w[j + 1])) FILTER (n = {n}), 0) AS BIGINT) AS dup_{n}_chars" for n in coverage)
    zero = ", ".join(f"coalesce(s.dup_{n}_chars, 0) AS dup_{n}_chars" for n in coverage)
    over = " OR ".join([f"dup_line_chars > {lines}::DOUBLE * word_chars", *(f"dup_{n}_chars > {x}::DOUBLE * word_chars" for n, x in coverage.items())])
    return rf"""
WITH d AS (SELECT doc_id, text, row_number() OVER () AS r, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
    g AS (SELECT r, n, i, array_to_string(w[i + 1 : i + n], ' ') AS said
        FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, (VALUES ({BASE}), {", ".join(f"({n})" for n in coverage)}) v(n) WHERE len(w) >= n)),
    k AS (SELECT r, n, said FROM g GROUP BY r, n, said HAVING count(*) > 1),
    c AS (SELECT DISTINCT r, n, unnest(range(i, i + n)) AS j FROM g JOIN k USING (r, n, said)),
    s AS (SELECT r, count(*) FILTER (n = {BASE}) AS n_repeat_words, {own} FROM c JOIN d USING (r) GROUP BY r),
    l AS (SELECT r, said, count(*) - 1 AS again FROM (SELECT r, unnest(string_split(text, chr(10))) AS said FROM d) WHERE regexp_matches(said, '[^\x20\x09-\x0D]') GROUP BY r, said),
    t AS (SELECT r, CAST(sum(again) AS BIGINT) AS n_dup_lines, CAST(sum(again * len(regexp_replace(said, '[\x20\x09-\x0D]', '', 'g'))) AS BIGINT) AS dup_line_chars FROM l GROUP BY r),
    m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(t.n_dup_lines, 0) AS n_dup_lines,
        CAST(coalesce(s.n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(t.dup_line_chars, 0) AS dup_line_chars, {zero}
        FROM d LEFT JOIN s USING (r) LEFT JOIN t USING (r)),
    f AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {BASE_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT ({over}) AS kept, dup_line_chars, {", ".join(f"dup_{n}_chars" for n in coverage)} FROM f
"""
