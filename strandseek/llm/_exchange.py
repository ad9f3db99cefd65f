"""Questions that groups of documents ask about the whole corpus.

Documents are dealt into groups of a few MB by a hash of key and text. A group puts its questions
(hashes, sorted and packed) into blocks of the hash space; whoever holds a block joins what all
groups put into it and answers each group with a bit per question, in the order in which it asked.
So a hash costs a byte or a few on its way and a bit on its way back, no group of equal hashes
grows beyond one entry a group, and what a task holds is bounded by the sizes of groups and blocks,
which are parameters. A group computes its questions anew when the answers arrive; nothing depends
on the order of rows or on which executor does the work.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandseek.llm._text import U, picked

GROUP_BYTES = 8 << 20
Questions = list[tuple[int, int, bytes]]
Answers = dict[tuple[int, int], bytes]


def grouped(docs: DataFrame, key: str, text: str, group_bytes: int = GROUP_BYTES) -> tuple[DataFrame, int]:
    """(group, doc_id, text) of every row, and the bytes of all texts."""
    base = picked(docs, key, text)
    total = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = -(-total // group_bytes) or 1
    return base.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).alias("group"), "doc_id", "text"), total


class Rows:
    """A group's documents by key; null keys come last, as if greater than all others."""

    def __init__(self, table: pa.Table):
        keys = table.column("doc_id").to_pylist()
        texts = table.column("text").to_pylist()
        order = sorted(range(len(keys)), key=lambda k: (keys[k] is None, keys[k] or 0, texts[k] or ""))
        self.keys = [keys[k] for k in order]
        self.texts = [(texts[k] or "").encode() for k in order]
        self.rank = np.array([np.iinfo(np.int64).max if k is None else k for k in self.keys], np.int64)


QUESTIONS = "group long, kind int, block long, payload binary"
ANSWERS = "group long, kind int, block long, bits binary"


def _questions(group: int, asked: Questions) -> pa.Table:
    n = len(asked)
    return pa.table({
        "group": pa.array([group] * n, pa.int64()), "kind": pa.array([x[0] for x in asked], pa.int32()),
        "block": pa.array([x[1] for x in asked], pa.int64()), "payload": pa.array([x[2] for x in asked], pa.binary()),
    })


def answers_of(table: pa.Table) -> Answers:
    return {(k, b): x for k, b, x in zip(*(table.column(c).to_pylist() for c in ("kind", "block", "bits")), strict=True)}


def ask(groups: DataFrame, f: Callable[[Rows, Answers], Questions], answers: DataFrame | None = None, rows: Callable[[pa.Table], Rows] = Rows) -> DataFrame:
    """The questions of each group, given the answers so far; ``rows``: what a group's table is read as."""
    if answers is None:

        def first(table: pa.Table) -> pa.Table:
            return _questions(table.column("group")[0].as_py(), f(rows(table), {}))

        return groups.groupBy("group").applyInArrow(first, QUESTIONS)

    def then(table: pa.Table, said: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _questions(0, [])
        return _questions(table.column("group")[0].as_py(), f(rows(table), answers_of(said)))

    return groups.groupBy("group").cogroup(answers.groupBy("group")).applyInArrow(then, QUESTIONS)


def answer(questions: DataFrame, f: Callable[[int, list[bytes]], list[bytes]]) -> DataFrame:
    """f(kind, payloads of one block) -> the answer to each."""

    def run(table: pa.Table) -> pa.Table:
        bits = f(table.column("kind")[0].as_py(), table.column("payload").to_pylist())
        return table.select(["group", "kind", "block"]).append_column("bits", pa.array(bits, pa.binary()))

    return questions.groupBy("kind", "block").applyInArrow(run, ANSWERS)


def finish(groups: DataFrame, answers: DataFrame, f: Callable[[Rows, Answers], pa.Table], schema: str, rows: Callable[[pa.Table], Rows] = Rows) -> DataFrame:
    """The result rows of each group, given all answers."""

    def run(table: pa.Table, said: pa.Table) -> pa.Table:
        return f(rows(table), answers_of(said))

    return groups.groupBy("group").cogroup(answers.groupBy("group")).applyInArrow(run, schema)


def pack_cells(cells: np.ndarray) -> bytes:
    """Sorted distinct numbers below 2^32 as low bytes and a unary bitmap of the rest."""
    high = (cells >> U(8)).astype(np.int64)
    bits = np.zeros(int(high[-1]) + len(cells) + 1 if len(cells) else 0, bool)
    bits[high + np.arange(len(cells))] = True
    return np.uint64(len(cells)).tobytes() + (cells & U(255)).astype(np.uint8).tobytes() + np.packbits(bits).tobytes()


def unpack_cells(data: bytes) -> np.ndarray:
    n = int(np.frombuffer(data, np.uint64, 1)[0])
    low = np.frombuffer(data, np.uint8, n, 8)
    high = np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, offset=8 + n)))[:n] - np.arange(n)
    return high.astype(U) << U(8) | low.astype(U)


def planes(x: np.ndarray) -> bytes:
    """An array's bytes, the first bytes of all elements first: sorted or small numbers compress well so."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def unplanes(data: bytes, kind: type, n: int, offset: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size, offset).reshape(size, n).T).view(kind).reshape(n)


def bits_of(x: np.ndarray) -> bytes:
    return np.packbits(x).tobytes()


def bools(data: bytes, n: int, offset: int = 0) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8, offset=offset), count=n).astype(bool)


def block_of(h: np.ndarray, blocks: int) -> np.ndarray:
    """The block of each hash: its upper half scaled, so blocks are ranges of hashes."""
    return (h >> U(32)) * U(blocks) >> U(32)


def cut(sorted_blocks: np.ndarray) -> list[tuple[int, int, int]]:
    """(block, begin, end) of the runs of sorted block numbers."""
    if not len(sorted_blocks):
        return []
    at = np.flatnonzero(np.concatenate(([True], sorted_blocks[1:] != sorted_blocks[:-1])))
    return list(zip(sorted_blocks[at].astype(int).tolist(), at.tolist(), np.append(at[1:], len(sorted_blocks)).tolist(), strict=True))
