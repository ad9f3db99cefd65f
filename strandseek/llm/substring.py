"""Operator 2, substring dedup: a count-min sketch before an exact count of word windows.

First pass: each group of documents is a partition with a sketch of its own, two rows of saturating
counters of the documents that a window starts in, sent as the cells that it has touched; the
sketches are merged by adding, block by block, and each group learns which of its cells reach two.
The least over the rows never underestimates, so windows below two are done with. Second pass: the
other windows, by 96 bits of hash, are grouped exactly; the smallest key of each tells the groups
which of theirs also start in a smaller document. The sketch grows with the corpus
(``CELLS_PER_WINDOW``), so the share of windows sent in vain doesn't; no window is lost.

Defined cases: a null or empty text has no words; a null key counts as greater than all others and
stays null; rows of one key are one document, which isn't smaller than itself; repeated rows give
repeated rows; a very long text is hashed whole, alone in its block; an empty table gives an empty
table of the same columns; other columns may have any names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strandseek.llm._exchange import Answers, Questions, Rows, answer, ask, bits_of, block_of, bools, cut, finish, grouped, pack_cells, planes, unpack_cells, unplanes
from strandseek.llm._text import Packed, U, chunks, mix, spread

WINDOW = 13
CELLS_PER_WINDOW, CELLS, ROWS = 5, 1 << 24, 2
#: Bytes of text for a word at least, in sizing the sketch, and windows of a block in the second pass.
WORD_BYTES, EXACT_BLOCK = 6, 1 << 21
BLOCK = 1 << 20
EXACT = 9


def hashes(rows: Rows, window: int, lanes: int = 1) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Window hashes (by lane), the row and the word of each window's start, over a group."""
    out: list[list[np.ndarray]] = [[] for _ in range(lanes)]
    doc, at, base = [], [], 0
    for a, b in chunks(rows.texts, BLOCK):
        p = Packed(rows.texts[a:b])
        ok = np.flatnonzero(p.windows(window))
        for lane in range(lanes):
            out[lane].append(p.window_hashes(p.word_hashes(lane), window, lane)[ok])
        doc.append(p.word_doc[ok] + a)
        at.append(ok + base)
        base += len(p.word_doc)
    join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
    return [join(x, U) for x in out], join(doc, np.int64), join(at, np.int64)


def row_hash(h: np.ndarray, row: int) -> np.ndarray:
    return h if row == 0 else mix(h ^ U(0xA24BAED4963EE407 * row & (1 << 64) - 1))


class Sketch:
    """A group's own sketch: the cells touched, row by row, and whether two documents touched them."""

    def __init__(self, h: np.ndarray, rank: np.ndarray, blocks: int):
        order = np.argsort(h, kind="stable")  # documents come by rank, so each run of a hash begins with its least
        h, rank = h[order], rank[order]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(h)), bool), h[1:] != h[:-1])))
        last = np.append(first[1:], len(h)) - 1 if len(h) else first
        self.hash, self.least, self.twice = h[first], rank[first], rank[first] != rank[last]
        self.of = np.empty(len(h), np.int64)
        self.of[order] = np.repeat(np.arange(len(first)), last - first + 1)
        self.blocks = blocks

    def cells(self, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct cells (block number * CELLS + cell), whether each counts two, and each window's place among them."""
        r = row_hash(self.hash, row)
        cell = block_of(r, self.blocks) * U(CELLS) + (r & U(CELLS - 1))
        cells, of, n = np.unique(cell, return_inverse=True, return_counts=True)
        twice = n > 1
        twice[of[self.twice]] = True
        return cells, twice, of

    def questions(self) -> Questions:
        out = []
        for row in range(ROWS):
            cells, twice, _ = self.cells(row)
            out += [(row, k, pack_cells(cells[a:b] - U(k * CELLS)) + bits_of(twice[a:b])) for k, a, b in cut(cells // U(CELLS))]
        return out

    def repeated(self, answers: Answers) -> np.ndarray:
        """The distinct windows that both rows estimate at two or more."""
        ok = np.ones(len(self.hash), bool)
        for row in range(ROWS):
            cells, _, of = self.cells(row)
            said = np.zeros(len(cells), bool)
            for k, a, b in cut(cells // U(CELLS)):
                said[a:b] = bools(answers[row, k], b - a)
            ok &= said[of]
        return ok


def merge_sketches(payloads: list[bytes]) -> list[bytes]:
    """Adds up the sketches of one block, up to two, and answers which of a group's cells reach two."""
    count, parts = np.zeros(CELLS, np.uint8), []
    for data in payloads:
        cells = unpack_cells(data).astype(np.int64)
        n = len(cells)
        twice = bools(data[-((n + 7) // 8) :], n) if n else np.zeros(0, bool)
        count[cells] = np.minimum(count[cells] + 1 + twice, 2)
        parts.append(cells)
    return [bits_of(count[cells] == 2) for cells in parts]


def merge_windows(payloads: list[bytes]) -> list[bytes]:
    """Groups the windows of one block exactly and answers which also start in a smaller document elsewhere."""
    sizes = [len(x) // 20 for x in payloads]
    h = np.concatenate([unplanes(x, U, n, 0) for x, n in zip(payloads, sizes, strict=True)])
    more = np.concatenate([unplanes(x, np.uint32, n, 8 * n) for x, n in zip(payloads, sizes, strict=True)])
    key = np.concatenate([unplanes(x, np.int64, n, 12 * n) for x, n in zip(payloads, sizes, strict=True)])
    order = np.lexsort((more, h))
    h, more = h[order], more[order]
    run = np.cumsum(np.concatenate(([0], (h[1:] != h[:-1]) | (more[1:] != more[:-1])))) if len(h) else np.zeros(0, np.int64)
    least = np.minimum.reduceat(key[order], np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))) if len(h) else key
    smaller = np.zeros(len(key), bool)
    smaller[order] = key[order] > least[run]
    ends = np.cumsum(sizes)
    return [bits_of(smaller[b - n : b]) for b, n in zip(ends, sizes, strict=True)]


def exact_order(s: Sketch, keep: np.ndarray, blocks: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """The windows of the second pass (sorted by hash, so by block) and the ranges of blocks."""
    at = np.flatnonzero(keep)
    return at, cut(block_of(s.hash[at], blocks))


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the words kept, joined by spaces) and kept (those words) of every row."""
    groups, total = grouped(docs, key, text)
    blocks = int(total / WORD_BYTES * CELLS_PER_WINDOW) // CELLS + 1
    exact_blocks = int(total / WORD_BYTES) // EXACT_BLOCK + 1

    def sketched(rows: Rows, lanes: int = 1) -> tuple[Sketch, list[np.ndarray], np.ndarray, np.ndarray]:
        h, doc, at = hashes(rows, window, lanes)
        return Sketch(h[0], rows.rank[doc], blocks), h, doc, at

    def first(rows: Rows, _: Answers) -> Questions:
        return sketched(rows)[0].questions()

    def second(rows: Rows, said: Answers) -> Questions:
        s, h, _, _ = sketched(rows, 2)
        more = np.zeros(len(s.hash), np.uint32)
        more[s.of] = (h[1] >> U(32)).astype(np.uint32)
        at, parts = exact_order(s, s.repeated(said), exact_blocks)
        return [(EXACT, k, planes(s.hash[at[a:b]]) + planes(more[at[a:b]]) + planes(s.least[at[a:b]])) for k, a, b in parts]

    def merge(kind: int, payloads: list[bytes]) -> list[bytes]:
        return merge_windows(payloads) if kind == EXACT else merge_sketches(payloads)

    def last(rows: Rows, said: Answers) -> pa.Table:
        s, _, doc, at = sketched(rows)
        elsewhere = np.zeros(len(s.hash), bool)
        where, parts = exact_order(s, s.repeated(said), exact_blocks)
        for k, a, b in parts:
            elsewhere[where[a:b]] = bools(said[EXACT, k], b - a)
        gone = at[elsewhere[s.of] | (rows.rank[doc] > s.least[s.of])]
        words = [x.split() for x in rows.texts]
        n = np.array([len(x) for x in words], np.int64)
        mark = spread(gone, window, int(n.sum()))
        out, begin = [], 0
        for x in words:
            out.append(b" ".join([w for w, m in zip(x, mark[begin : begin + len(x)].tolist(), strict=True) if not m]) if mark[begin : begin + len(x)].any() else b" ".join(x))
            begin += len(x)
        total = np.concatenate(([0], np.cumsum(mark)))
        removed = total[np.cumsum(n)] - total[np.cumsum(n) - n]
        return pa.table({
            "doc_id": pa.array(rows.keys, pa.int64()), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in out], pa.string()), "kept": pa.array([x.decode() for x in out], pa.string()),
        })

    estimated = answer(ask(groups, first), merge)
    counted = answer(ask(groups, second, estimated), merge)
    return finish(groups, estimated.unionByName(counted), last, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")


#: The same in SQL.
DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
    s AS (SELECT doc_id, r, i, array_to_string(w[i + 1 : i + 13], ' ') AS said FROM (SELECT doc_id, r, w, unnest(range(len(w) - 12)) AS i FROM d WHERE len(w) >= 13)),
    m AS (SELECT said, min(doc_id) AS least FROM s GROUP BY said),
    g AS (SELECT r, list_distinct(flatten(list(range(i + 1, i + 14)))) AS gone FROM s JOIN m USING (said) WHERE coalesce(s.doc_id > m.least, s.doc_id IS NULL AND m.least IS NOT NULL) GROUP BY r),
    k AS (SELECT d.r, unnest(range(1, len(w) + 1)) AS i FROM d),
    x AS (SELECT r, count(*) AS n, string_agg(w[i], ' ' ORDER BY i) AS kept FROM (SELECT d.r, d.w, k.i FROM d JOIN k USING (r) LEFT JOIN g USING (r)
        WHERE g.gone IS NULL OR NOT list_contains(g.gone, k.i)) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(x.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(x.kept, '')) AS kept_sha256
FROM d LEFT JOIN x USING (r)
"""
