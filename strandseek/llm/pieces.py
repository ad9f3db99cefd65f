"""Operator 7, SentencePiece encoding and decoding by shared-prefix dynamic programming.

A text is marked as the library does it (a dummy prefix, spaces as U+2581) and cut before each
mark that follows another character; no piece of the model crosses such a cut, which is checked
when the model is loaded. The distinct marked words of a batch are sorted, which walks their trie
depth-first: the forward states of the common prefix with the word before are reused, and only the
new characters are worked on. Characters that are no piece become their byte pieces.

A unigram model takes the plain Viterbi recurrence: the best sum of scores of a segmentation of
each prefix. A BPE model's result isn't the best sum of its scores (they are merge ranks), so plain
Viterbi would give other pieces than the library. There the forward state of a prefix is the last
piece of that prefix's own encoding: a piece may end a prefix if the pair that it forms with the
last piece of the rest is stable, that is, if merging both together gives back just the two. One
and only one piece does. Words with runs of marks, whose pieces share one score, are merged plainly.

Defined cases: a null text gives null pieces (encode) or null text (decode); an empty text gives no
pieces; a null key stays null; repeated rows give repeated rows; a very long text is encoded whole (a
word's states are kept only while the words that share its beginning are worked on); of equal scores
the leftmost merge comes first; an empty table stays empty; other columns may have any names.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandseek.llm._text import PART, column, fresh, map_texts, picked, ranges, remember

MARK = "▁"
CUT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Words and pairs of pieces that a worker remembers; beyond that the tables start anew.
REMEMBERED, REMEMBERED_PAIRS = 300_000, 600_000
UNIGRAM, BPE = 1, 2
#: Columns that ``with_pieces`` adds.
NEW = ("pieces", "n_pieces", "round_trip")


class Model:
    """The pieces of a SentencePiece file."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if proto.trainer_spec.model_type not in (UNIGRAM, BPE) or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.add_dummy_prefix:
            raise ValueError("only unigram and BPE models with a dummy prefix and no normalisation are supported")
        self.kind = proto.trainer_spec.model_type
        p = sentencepiece.SentencePieceProcessor(model_file=path)
        self.text_of = [p.id_to_piece(k) for k in range(p.get_piece_size())]
        special = [p.is_control(k) or p.is_unknown(k) or p.is_unused(k) or p.is_byte(k) for k in range(len(self.text_of))]
        self.ids = {x: k for k, x in enumerate(self.text_of) if not special[k]}
        self.score = [p.get_score(k) for k in range(len(self.text_of))]
        self.of_byte = {int(x[3:5], 16): k for k, x in enumerate(self.text_of) if p.is_byte(k)}
        self.unknown = p.unk_id()
        #: The pieces as a trie from their last characters; "" leads to the id.
        self.backward: dict = {}
        for x in self.ids:
            level = self.backward
            for c in reversed(x):
                level = level.setdefault(c, {})
            level[""] = self.ids[x]
        self.spelling = [b"" if p.is_control(k) else " ⁇ ".encode() if p.is_unknown(k) else bytes([int(x[3:5], 16)]) if p.is_byte(k) else x.encode() for k, x in enumerate(self.text_of)]
        if any(MARK in x.lstrip(MARK) for x in self.ids):
            raise ValueError("a piece has a mark inside it")
        self.stable: dict[int, bool] = {}
        #: marked word -> its ids as bytes of int32
        self.words: dict[str, bytes] = {}

    def merged(self, word: str) -> list[str]:
        """BPE by its definition: the adjacent pair whose joint piece scores best is merged first, the leftmost of ties."""
        ids, score = self.ids, self.score
        part, n = list(word), len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[float, int, int]] = []

        def push(left: int, right: int) -> None:
            if left >= 0 and right < n and (k := ids.get(part[left] + part[right])) is not None:
                heapq.heappush(heap, (-score[k], left, len(part[left]) + len(part[right])))

        for k in range(n - 1):
            push(k, k + 1)
        while heap:
            _, k, size = heapq.heappop(heap)
            right = after[k]
            if not part[k] or right >= n or len(part[k]) + len(part[right]) != size:
                continue
            part[k] += part[right]
            part[right] = ""
            after[k] = after[right]
            if after[k] < n:
                before[after[k]] = k
            push(before[k], k)
            push(k, after[k])
        return [x for x in part if x]

    def pair(self, left: int, right: int) -> bool:
        """Whether the two pieces stay as they are when merged together; works it out and remembers it."""
        if len(self.stable) >= REMEMBERED_PAIRS:
            self.stable.clear()
        x, y = self.text_of[left], self.text_of[right]
        have = self.stable[left << 24 | right] = self.merged(x + y) == [x, y]
        return have

    def endings(self, word: str, end: int) -> list[tuple[int, int]]:
        """(start, id) of pieces that end there, the shortest first; an unknown last character has -1."""
        out, level = [], self.backward
        for start in range(end - 1, -1, -1):
            level = level.get(word[start])
            if level is None:
                break
            if (k := level.get("")) is not None:
                out.append((start, k))
        if not out or out[0][0] != end - 1:
            out.insert(0, (end - 1, -1))
        return out

    def extend(self, word: str, end: int, states: list) -> None:
        """Adds the forward state of word[:end]: (start of the last piece, its id). An unknown character joins nothing."""
        found, stable = self.endings(word, end), self.stable
        for start, k in reversed(found):
            if start == 0:
                if k < 0 or self.whole(k):
                    break
                continue
            left = states[start][1]
            if left < 0 or k < 0:
                break
            ok = stable.get(left << 24 | k)
            if self.pair(left, k) if ok is None else ok:
                break
        states.append((start, k))

    @lru_cache(maxsize=100_000)  # noqa: B019  a model lives as long as its worker
    def whole(self, k: int) -> bool:
        return self.merged(self.text_of[k]) == [self.text_of[k]]

    def extend_unigram(self, word: str, end: int, states: list) -> None:
        best = None
        for start, k in reversed(self.endings(word, end)):
            score = states[start][1] + (self.score[k] if k >= 0 else self.floor)
            if best is None or score > best[1]:
                best = (start, score)
        states.append(best)

    @property
    def floor(self) -> float:
        """The score of an unknown character: 10 below the lowest, as the library has it."""
        return min(self.score[k] for k in self.ids.values()) - 10

    def spelt(self, pieces: list[str]) -> bytes:
        out: list[int] = []
        for x in pieces:
            if (k := self.ids.get(x)) is not None:
                out.append(k)
            elif self.of_byte:
                out += [self.of_byte[b] for b in x.encode()]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return array("i", out).tobytes()

    def learn_words(self, words: list[str]) -> dict[str, bytes]:
        """Encodes sorted distinct words, each from the states of its common prefix with the one before."""
        out, extend = {}, self.extend if self.kind == BPE else self.extend_unigram
        last, states = "", [(0, -1 if self.kind == BPE else 0.0)]
        for word in words:
            if self.kind == BPE and word.startswith(MARK * 2):
                out[word] = self.spelt(self.merged(word))
                continue
            n, most = 0, min(len(last), len(word))
            while n < most and last[n] == word[n]:
                n += 1
            del states[n + 1 :]
            for end in range(n + 1, len(word) + 1):
                extend(word, end, states)
            pieces, end = [], len(word)
            while end:
                pieces.append(word[states[end][0] : end])
                end = states[end][0]
            out[word] = self.spelt(pieces[::-1])
            last = word
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        cut = [None if x is None else CUT.findall(MARK + x.replace(" ", MARK)) if x else [] for x in texts]
        known = self.words
        new = sorted({w for x in cut if x for w in x if w not in known})
        if len(known) + len(new) > REMEMBERED:
            known = {w: known[w] for x in cut if x for w in x if w in known}
            self.words = {}
        found = self.learn_words(new)
        known = known | found if len(found) > len(known) else (known.update(found) or known)
        if len(known) <= REMEMBERED:
            self.words = known
        return [None if x is None else np.frombuffer(b"".join(map(known.__getitem__, x)), np.int32) for x in cut]

    def decode(self, ids: list[int] | None) -> str | None:
        if ids is None:
            return None
        text = b"".join(map(self.spelling.__getitem__, ids)).decode(errors="replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


OWNER = "pieces"


@lru_cache(maxsize=2)
def held(path: str) -> Model:
    return Model(path)


def forget() -> None:
    held.cache_clear()
    Model.whole.cache_clear()


def model(path: str) -> Model:
    """One model a worker and file, until the worker works for another operator."""
    remember(OWNER, forget)
    return held(path)


#: Texts of about so many characters share one trie.
BLOCK = 1 << 23


def encode_pieces(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and pieces (array of int) of every row, as the library's encode gives them."""

    def run(keys: list, texts: list) -> dict[str, list]:
        return {"doc_id": keys, "pieces": [y for part in blocks(texts) for y in model(path).encode(part)]}

    return map_texts(picked(docs, key, text), run, "doc_id long, pieces array<int>", OWNER)


def blocks(texts: list) -> list[list]:
    out, used = [[]], 0
    for x in texts:
        if used > BLOCK:
            out.append([])
            used = 0
        out[-1].append(x)
        used += len(x or "")
    return out


def with_pieces(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """docs with all their columns and pieces, n_pieces (both null for a null text) and round_trip (decoding gives the text back).

    Where docs has a column of such a name the new one gets underscores behind it.
    """

    @F.arrow_udf("struct<pieces:array<int>,n_pieces:int,round_trip:boolean>")
    def run(texts: pa.Array) -> pa.Array:
        parts = []
        for i, j in ranges(texts, PART):
            m, some = model(path), texts.slice(i, j - i).to_pylist()
            ids = m.encode(some)
            null = np.array([x is None for x in some])
            n = np.array([0 if x is None else len(x) for x in ids], np.int32)
            ends = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
            flat = np.concatenate([x for x in ids if x is not None]) if len(ends) and ends[-1] else np.zeros(0, np.int32)
            back = [m.decode(None if x is None else x.tolist()) == (None if t is None else t.replace(MARK, " ")) for t, x in zip(some, ids, strict=True)]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()), mask=pa.array(null))
            parts.append(pa.StructArray.from_arrays([lists, pa.array(n, mask=null), pa.array(back)], names=list(NEW)))
        kind = pa.struct([("pieces", pa.list_(pa.int32())), ("n_pieces", pa.int32()), ("round_trip", pa.bool_())])
        return pa.concat_arrays(parts).cast(kind) if parts else pa.array([], kind)

    own = [column(c) for c in docs.columns]
    made, *names = fresh(docs, names=("made", *NEW))
    rows = docs.select(*own, run(column(text).cast("string")).alias(made))
    return rows.select(*own, *[F.col(made)[c].alias(name) for c, name in zip(NEW, names, strict=True)])


def decode_pieces(pieces: Column, path: str) -> Column:
    """The text of an array of piece ids."""

    @F.arrow_udf("string")
    def decoded(ids: pa.Array) -> pa.Array:
        return pa.array([model(path).decode(x) for x in ids.to_pylist()], pa.string())

    return decoded(pieces)


def round_trips(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_pieces, pieces_sha256 (of the ids as 32-bit little-endian integers), round_trip (decoding gives the text back).

    The mark itself is written as a space when it is decoded, and counts as one here.
    """

    def run(keys: list, texts: list) -> dict[str, list]:
        m, out = model(path), {"doc_id": keys, "n_pieces": [], "pieces_sha256": [], "round_trip": []}
        for part in blocks(texts):
            for x, ids in zip(part, m.encode(part), strict=True):
                ids = np.zeros(0, np.int32) if ids is None else ids
                out["n_pieces"].append(len(ids))
                out["pieces_sha256"].append(hashlib.sha256(ids.tobytes()).hexdigest())
                out["round_trip"].append(m.decode(ids.tolist()) == (x or "").replace(MARK, " "))
        return out

    return map_texts(picked(docs, key, text), run, "doc_id long, n_pieces long, pieces_sha256 string, round_trip boolean", OWNER)
