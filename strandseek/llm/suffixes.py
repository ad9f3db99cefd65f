"""Operator 4, suffix-array dedup: removes every byte inside a 400-byte string that occurs twice.

Within a block of texts, suffixes are put in order by a mergesort that compares two of them in
logarithmic time: prefix polynomial hashes tell whether two extensions are equal (that over the whole
length is asked first), and a binary search finds the longest. Equal strings are a class because the
sort has made them neighbours with a common extension of the whole length; all neighbours taken as
equal are then compared byte by byte, so a collision can't join them. Classes of different blocks
meet by 96 bits of hash (see ``_exchange``), a class counting as repeated if all blocks together hold
two places of it; n different strings of the corpus hold a false pair with odds n^2 / 2^97.

Sorting every suffix of a corpus is not needed. Each 400-byte string has an anchor, the place of
its least 32-byte hash; equal strings have equal anchors at equal offsets. So: (1) strings whose
anchor occurs once are unique. The others' starts are cut, by their distance from the anchor, into
cells of 32. (2) Where the 431 bytes around a whole cell are repeated, all its strings are. (3) Of
the other cells, called open, none is where the 369 bytes common to its strings aren't repeated.
(4) The rest is sorted and counted string by string, together with the strings of closed cells that
have their common bytes from an open one elsewhere. No step loses or adds anything.

Defined cases: a null or empty text has no bytes; texts of under 400 bytes lose nothing; a null key
stays null; every row is a text of its own, repeated rows too; a text longer than a block is a block;
other columns may have any names; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame

from strandseek.llm._exchange import Answers, Questions, Rows, answer, ask, bits_of, block_of, bools, cut, finish, grouped, planes, unplanes
from strandseek.llm._text import BYTE_VALUES, U, chunks, mix, powers, spread

LENGTH, GRAM, CELL = 400, 32, 32
BLOCK = 1 << 20
#: A group keeps about 50 bytes for each byte of text.
GROUP_BYTES = 4 << 20
#: Bytes of the corpus for each block of the hash space.
SHARE = 32 << 20
ANCHOR, WHOLE, CORE, STRING = range(4)
HEAD = 16


class Block:
    """Texts joined into one buffer, with prefix hashes of both lanes."""

    def __init__(self, texts: list[bytes], length: int):
        self.length = length
        self.data = b"\n".join(texts) + b"\n"
        self.buf = np.frombuffer(self.data, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.ends = np.cumsum(sizes + 1) - 1
        self.begins = self.ends - sizes
        self.prefix: dict[int, np.ndarray] = {}
        count = np.maximum(sizes - length + 1, 0)
        self.text = np.repeat(np.arange(len(texts)), count)
        #: The starts of all strings, and the anchor of each.
        self.start = np.arange(len(self.text)) + np.repeat(self.begins - np.concatenate(([0], np.cumsum(count)[:-1])), count)
        self.anchor = self.anchors()

    def prefixes(self, lane: int) -> np.ndarray:
        """Hashes of all prefixes, made when they are first asked for."""
        if (h := self.prefix.get(lane)) is None:
            n = len(self.buf)
            h = self.prefix[lane] = np.zeros(n + 1, U)
            np.cumsum(BYTE_VALUES[lane][self.buf] * powers(lane, n), out=h[1:])
        return h

    def raw(self, at: np.ndarray, size: np.ndarray | int, lane: int = 0) -> np.ndarray:
        """Polynomial hashes of the strings of the given places and sizes."""
        h = self.prefixes(lane)
        return (h[at + size] - h[at]) * powers(lane, len(self.buf), True)[at]

    def digest(self, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """96 bits of each string; of grams, which only sift, 64."""
        if size == GRAM:
            return mix(self.raw(at, size)), np.zeros(len(at), np.uint32)
        return mix(self.raw(at, size)), (mix(self.raw(at, size, 1)) >> U(32)).astype(np.uint32)

    def anchors(self) -> np.ndarray:
        """For each start the last place of the least gram hash inside its string."""
        if not len(self.start):
            return self.start
        n = len(self.buf) - GRAM + 1
        w = self.length - GRAM + 1
        low = U((1 << n.bit_length()) - 1)
        h = self.prefixes(0)
        key = mix((h[GRAM:] - h[:-GRAM]) * powers(0, len(self.buf), True)[:n]) & ~low
        key |= np.arange(int(low), int(low) - n, -1, dtype=U)
        pad = np.full(-(-n // w) * w + w, np.iinfo(U).max, U)
        pad[:n] = key
        grid = pad.reshape(-1, w)
        before = np.minimum.accumulate(grid, axis=1).reshape(-1)
        behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        least = np.minimum(behind[: n - w + 1], before[w - 1 : n])
        return (low - (least & low)).astype(np.int64)[self.start]

    def common(self, p: np.ndarray, q: np.ndarray, limit: int) -> np.ndarray:
        """How far the suffixes at p and q agree, below the limit, by binary search; they agree over HEAD."""
        low, high = np.full(len(p), HEAD), np.full(len(p), limit - 1)
        for _ in range(int(limit - 1 - HEAD).bit_length()):
            mid = (low + high + 1) >> 1
            same = self.raw(p, mid) == self.raw(q, mid)
            low = np.where(same, mid, low)
            high = np.where(same, high, np.maximum(mid - 1, low))
        return low

    def before(self, p: np.ndarray, q: np.ndarray, limit: int, whole: np.ndarray, ties: np.ndarray | bool) -> np.ndarray:
        """Whether the suffix at p comes before that at q; of equal ones, what ``ties`` says. ``whole``: hashes over the limit, by place."""
        out = np.zeros(len(p), bool) | ties
        at = np.flatnonzero(whole[p] != whole[q])
        p, q = p[at], q[at]
        n = self.common(p, q, limit)
        out[at] = self.buf[p + n] < self.buf[q + n]
        return out

    def sort(self, places: np.ndarray, limit: int, whole: np.ndarray) -> np.ndarray:
        """The places in the order of their suffixes' first ``limit`` bytes.

        One sort of numbers makes runs of equal heads. Those already in order stay; the others go through
        a bottom-up mergesort, all pairs of runs at once: each suffix finds its rank in the other run of
        its pair.
        """
        head = np.ascontiguousarray(sliding_window_view(self.buf, HEAD)[places]).view(">u8").astype(U)
        order = np.lexsort((head[:, 1], head[:, 0]))
        places, head = places[order], head[order]
        new = np.concatenate(([True], (head[1:] != head[:-1]).any(axis=1)))
        inside = np.flatnonzero(~new)
        wrong = inside[self.before(places[inside], places[inside - 1], limit, whole, False)]
        bounds = np.append(np.flatnonzero(new), len(places))
        size = np.diff(bounds)
        open_ = np.zeros(len(size), bool)
        open_[np.cumsum(new)[wrong] - 1] = True
        if not open_.any():
            return places
        todo = np.flatnonzero(np.repeat(open_, size))
        begin = np.repeat(bounds[:-1], size)[todo]
        end = np.repeat(bounds[1:], size)[todo]
        at, width, most = todo.copy(), 1, int(size[open_].max())
        held = places[todo]  # the suffix that each entry stands for; ``at`` is its place in the order
        while width < most:
            run = (at - begin) // width
            low = np.minimum(begin + (run ^ 1) * width, end)
            other, high = low.copy(), np.minimum(low + width, end)
            right = (run & 1).astype(bool)
            live = np.flatnonzero(low < high)
            while len(live):
                mid = (low[live] + high[live]) >> 1
                goes = self.before(places[mid], held[live], limit, whole, right[live])
                low[live] = np.where(goes, mid + 1, low[live])
                high[live] = np.where(goes, high[live], mid)
                live = live[low[live] < high[live]]
            at = begin + (run >> 1) * 2 * width + (at - begin) % width + (low - other)
            places[at] = held
            width *= 2
        return places

    def classes(self, places: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(a place of each class of equal strings, how many places it has, the class of each given place)."""
        if not len(places):
            return places, places, places
        whole = np.empty(len(self.buf), U)
        whole[places] = self.raw(places, limit)
        order = self.sort(places, limit, whole)
        a, b = order[:-1], order[1:]
        same = whole[a] == whole[b]  # the common extension of neighbours reaches the limit
        view = sliding_window_view(self.buf, limit)
        for k in range(0, len(a), 4096):  # the collision check
            part = np.flatnonzero(same[k : k + 4096]) + k
            if len(part):
                same[part] = (view[a[part]] == view[b[part]]).all(axis=1)
        first = np.flatnonzero(np.concatenate(([True], ~same)))
        of = np.empty(len(self.buf), np.int64)
        of[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
        return order[first], np.diff(np.append(first, len(order))), of[places]


class Asked:
    """Distinct digests of a group, in the order of the questions, with whether the group has two of each, and a flag."""

    def __init__(self, h: list[np.ndarray], more: list[np.ndarray], count: list[np.ndarray], blocks: int, flag: list[np.ndarray] | None = None):
        h, more = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((h, U), (more, np.uint32)))
        count = np.concatenate(count) if count else np.zeros(0, np.int64)
        order = np.lexsort((more, h))
        h, more = h[order], more[order]
        new = np.concatenate((np.ones(min(1, len(h)), bool), (h[1:] != h[:-1]) | (more[1:] != more[:-1])))
        first = np.flatnonzero(new)
        self.h, self.more = h[first], more[first]
        none = np.zeros(len(first), bool)
        self.twice = np.add.reduceat(count[order], first) > 1 if len(first) else none
        self.flag = np.logical_or.reduceat(np.concatenate(flag)[order], first) if len(first) and flag else none
        self.of = np.empty(len(h), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.parts = cut(block_of(self.h, blocks))

    def questions(self, kind: int) -> Questions:
        head = lambda n: np.int64(n).tobytes()
        return [(kind, k, head(b - a) + planes(self.h[a:b]) + planes(self.more[a:b]) + bits_of(self.twice[a:b]) + bits_of(self.flag[a:b])) for k, a, b in self.parts]

    def said(self, kind: int, answers: Answers) -> tuple[np.ndarray, np.ndarray]:
        """For each digest as given, whether the corpus has two places of it, and whether any of them is flagged."""
        out = np.zeros((2, len(self.h)), bool)
        for k, a, b in self.parts:
            out[0, a:b] = bools(answers[kind, k], b - a)
            out[1, a:b] = bools(answers[kind, k], b - a, (b - a + 7) // 8)
        return out[0][self.of], out[1][self.of]


def merge(_: int, payloads: list[bytes]) -> list[bytes]:
    """Counts the digests of one block over all groups and answers which reach two, and which are flagged."""
    sizes = [int(np.frombuffer(x, np.int64, 1)[0]) for x in payloads]
    parts = list(zip(payloads, sizes, strict=True))
    h = np.concatenate([unplanes(x, U, n, 8) for x, n in parts])
    more = np.concatenate([unplanes(x, np.uint32, n, 8 + 8 * n) for x, n in parts])
    twice = np.concatenate([bools(x, n, 8 + 12 * n) for x, n in parts])
    flag = np.concatenate([bools(x, n, 8 + 12 * n + (n + 7) // 8) for x, n in parts])
    order = np.lexsort((more, h))
    h, more = h[order], more[order]
    new = np.concatenate((np.ones(min(1, len(h)), bool), (h[1:] != h[:-1]) | (more[1:] != more[:-1])))
    first, run = np.flatnonzero(new), np.cumsum(new) - 1
    out = np.zeros((2, len(h)), bool)
    if len(h):
        out[0, order] = (np.add.reduceat(1 + twice[order], first) > 1)[run]
        out[1, order] = np.logical_or.reduceat(flag[order], first)[run]
    ends = np.cumsum(sizes)
    return [bits_of(out[0, e - n : e]) + bits_of(out[1, e - n : e]) for e, n in zip(ends, sizes, strict=True)]


class Search:
    """What a group asks, step by step, over its blocks of texts."""

    def __init__(self, rows: Rows, length: int, blocks: int):
        self.rows, self.length, self.blocks = rows, length, blocks

    def each(self):
        for a, b in chunks(self.rows.texts, BLOCK):
            if max(map(len, self.rows.texts[a:b])) >= self.length:
                yield a, Block(self.rows.texts[a:b], self.length)

    def gather(self, blocks: list[Block], classes: list, size: int, flags: list | None = None) -> Asked:
        """The digests of all blocks' classes; a class is flagged if one of its places is."""
        parts = [(*b.digest(x[0], size), x[1]) for b, x in zip(blocks, classes, strict=True)]
        flag = None if flags is None else [np.bincount(x[2], f, len(x[0])) > 0 for x, f in zip(classes, flags, strict=True)]
        return Asked(*([x[k] for x in parts] for k in range(3)), self.blocks, flag)

    def told(self, asked: Asked, kind: int, classes: list, said: Answers) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each block's places, whether they are repeated, and whether any equal one is flagged."""
        ends = np.cumsum([len(x[0]) for x in classes])[:-1]
        return [(r[x[2]], f[x[2]]) for r, f, x in zip(*(np.split(y, ends) for y in asked.said(kind, said)), classes, strict=True)] if classes else []

    def run(self, said: Answers, last: int):
        """Goes through the steps up to ``last``, whose questions it returns; after STRING, the repeated starts by block."""
        length = self.length
        have = list(self.each())
        each = [b for _, b in have]
        anchors = [b.anchor[np.concatenate(([True], b.anchor[1:] != b.anchor[:-1]))] for b in each]  # they grow with the start
        single = [(x, np.ones(len(x), np.int64), np.arange(len(x))) for x in anchors]
        asked = self.gather(each, single, GRAM)
        if last == ANCHOR:
            return asked.questions(ANCHOR)
        cells, whole = [], []
        for b, x, (good, _) in zip(each, anchors, self.told(asked, ANCHOR, single, said), strict=True):
            on = np.zeros(len(b.buf), bool)
            on[x[good]] = True
            at = np.flatnonzero(on[b.anchor])  # strings whose anchor is repeated
            begin = b.anchor[at] - (b.anchor[at] - b.start[at]) // CELL * CELL - (CELL - 1)
            place, first, of = np.unique(begin, return_index=True, return_inverse=True)
            text = b.text[at][first]
            fits = (place >= b.begins[text]) & (place + length + CELL - 1 <= b.ends[text])
            cells.append((at, of, place, fits))
            whole.append(b.classes(place[fits], length + CELL - 1))
        asked = self.gather(each, whole, length + CELL - 1)
        if last == WHOLE:
            return asked.questions(WHOLE)
        core, opened = [], []
        for b, (_, _, place, fits), (good, _) in zip(each, cells, self.told(asked, WHOLE, whole, said), strict=True):
            is_open = np.ones(len(place), bool)
            is_open[fits] = ~good
            opened.append(is_open)
            core.append(b.classes(place + CELL - 1, length - CELL + 1))
        asked = self.gather(each, core, length - CELL + 1, opened)
        if last == CORE:
            return asked.questions(CORE)
        rest = []
        for b, (at, of, _, _), (good, near_open) in zip(each, cells, self.told(asked, CORE, core, said), strict=True):
            left = at[(good & near_open)[of]]
            rest.append((left, b.classes(b.start[left], length)))
        strings = [x for _, x in rest]
        asked = self.gather(each, strings, length)
        if last == STRING:
            return asked.questions(STRING)
        out = []
        for (a, b), (at, of, _, _), is_open, (left, _), (good, _) in zip(have, cells, opened, rest, self.told(asked, STRING, strings, said), strict=True):
            out.append((a, b, b.start[np.concatenate((at[~is_open[of]], left[good]))]))
        return out


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes) of every row."""
    if length < GRAM + CELL:
        raise ValueError(f"strings of {GRAM + CELL} bytes or more are supported")
    groups, total = grouped(docs, key, text, group_bytes)
    blocks = total // SHARE + 1

    def step(last: int):
        return lambda rows, said: Search(rows, length, blocks).run(said, last)

    def result(rows: Rows, said: Answers) -> pa.Table:
        removed, spans, kept = [0] * len(rows.texts), [0] * len(rows.texts), list(rows.texts)
        for a, block, starts in Search(rows, length, blocks).run(said, STRING + 1):
            gone = spread(starts, length, len(block.buf))
            total = np.concatenate(([0], np.cumsum(gone)))
            opens = np.concatenate(([0], np.cumsum(gone & ~np.concatenate(([False], gone[:-1])))))
            n, m = total[block.ends] - total[block.begins], opens[block.ends] - opens[block.begins]
            for k in np.flatnonzero(n).tolist():
                i, j = block.begins[k], block.ends[k]
                removed[a + k], spans[a + k] = int(n[k]), int(m[k])
                kept[a + k] = block.buf[i:j][~gone[i:j]].tobytes()
        return pa.table({
            "doc_id": pa.array(rows.keys, pa.int64()), "n_bytes": pa.array([len(x) for x in rows.texts], pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), "kept": pa.array(kept, pa.binary()),
        })

    answers = answer(ask(groups, step(ANCHOR)), merge)
    for last in (WHOLE, CORE, STRING):
        answers = answers.unionByName(answer(ask(groups, step(last), answers), merge))
    return finish(groups, answers, result, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
