"""Operator 12, quality by compression: what is compressed better by a dictionary of good texts than by one of bad ones is good.

Two zstandard dictionaries are trained from blocks of labelled texts. A text is compressed block by
block, each block with either dictionary, so that a dictionary counts as much at a text's end as at its
beginning. The difference of the two sums over the whole text, divided by both together, is calibrated by a
logistic curve over labelled rows that gave no blocks.

Learning takes a bounded sample of the labelled rows: keys are drawn by hash, with a rate that makes
``sample`` rows of each label expected, then rows by a hash of key and text where many share a key; rows
that repeat key and text count once. Of the blocks of the rows drawn, those of the ``blocks`` least hashes
train a dictionary. All else covers all rows. A key's label counts if all its labelled rows agree.

Defined cases: a null or empty text has no difference and gets the curve's value at 0; a null text teaches
nothing, nor does a null or other label, a null key or one held out; if rows of only one label are there, or of none, every
score is that label's share, or a half; a sample too small to train a dictionary of is the dictionary
itself; a null key stays null and is held out of nothing; repeated rows give repeated rows; a very long text is
compressed whole; an empty table gives an empty table of the same columns; other columns are never looked at.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandseek.llm._text import PART, Shelf, column, map_texts, picked, ranges, utf8
from strandseek.llm.language import held_out

#: Rows of each label that learning expects to draw, and blocks of each label that a dictionary is trained of.
SAMPLE, BLOCKS = 10_000, 12_000
#: Bytes of a block and of a dictionary, and the level of compression.
BLOCK, DICTIONARY, LEVEL = 1024, 112_000, 3
#: How finely rates are drawn.
FINE = 1_000_000


def trained(blocks: list[bytes], size: int) -> bytes:
    """A trained dictionary; of too little text the text itself."""
    try:
        return zstandard.train_dictionary(size, blocks).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(blocks)[:size]


@functools.lru_cache(maxsize=8)
def compressor(data: bytes, level: int) -> zstandard.ZstdCompressor:
    """Prepared once in each worker."""
    held = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_AUTO)
    held.precompute_compress(level=level)
    return zstandard.ZstdCompressor(level=level, dict_data=held, write_content_size=False, write_dict_id=False, write_checksum=False)


@dataclass
class Model:
    """Both dictionaries and the curve: the score is 1 / (1 + exp(-(bias + slope * difference)))."""

    good: bytes = b""
    bad: bytes = b""
    bias: float = 0.0
    slope: float = 0.0
    block: int = BLOCK
    level: int = LEVEL

    def difference(self, text: bytes) -> float:
        """The normalised difference of the sizes by the bad and by the good dictionary, over the whole text."""
        if not self.good or not self.bad or not text:
            return 0.0
        parts = [text[k : k + self.block] for k in range(0, len(text), self.block)]
        good, bad = (sum(len(c.compress(x)) for x in parts) for c in (compressor(self.good, self.level), compressor(self.bad, self.level)))
        return (bad - good) / (bad + good)

    def score(self, difference: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + self.slope * difference, -500, 500)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Bias and slope of a weighted logistic curve by Newton's method, slightly drawn to 0 so that they stay finite."""
    scale = max(float(np.abs(x).max(initial=0)), 1e-9)
    design, at = np.stack([np.ones(len(x)), x / scale], axis=1), np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        slope = design.T @ (weight * (y - p)) - 1e-3 * at
        bend = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        move = np.linalg.solve(bend, slope)
        at += move * min(1.0, 5.0 / max(float(np.abs(move).max()), 1e-12))
        if np.abs(move).max() < 1e-9:
            break
    return float(at[0]), float(at[1] / scale)


def drawn(*columns: str, seed: int):
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(FINE))


def labelled_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, sample: int) -> tuple[DataFrame, dict[int, int]]:
    """doc_id, text and label of the rows drawn, and how many keys have each label."""
    of = labels.select(column(key).cast("long").alias("doc_id"), column(label).cast("int").alias("label")).where("label in (0, 1)")
    of = of.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    n = {r["label"]: r["n"] for r in of.groupBy("label").agg(F.count("*").alias("n")).collect()}
    rate = lambda have: F.when(F.col("label") == 1, F.lit(int(FINE * sample / max(have.get(1, 0), 1)) + 1)).otherwise(F.lit(int(FINE * sample / max(have.get(0, 0), 1)) + 1))
    keys = F.broadcast(of.where(drawn("doc_id", seed=1) < rate(n)))  # about 2 * sample rows
    rows = picked(docs, key, text)
    there = {r["label"]: r["n"] for r in rows.select("doc_id").join(keys, "doc_id").groupBy("label").agg(F.count("*").alias("n")).collect()}
    rows = rows.where(F.col("text").isNotNull()).join(keys, "doc_id").where(drawn("doc_id", "text", seed=2) < rate(there))
    return rows.groupBy("doc_id", "text", "label").agg(F.count("*").alias("rows")).drop("rows"), n


def blocks_of(rows: DataFrame, block: int, most: int) -> list[bytes]:
    """The blocks of the least hashes of some rows' texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in ranges(b.column(0), PART):
                cut = [x[k : k + block] for x in utf8(b.column(0).slice(i, j - i)) for k in range(0, len(x), block)]
                yield pa.RecordBatch.from_arrays([pa.array(cut, pa.binary())], names=["block"])

    cut = rows.select("text").mapInArrow(run, "block binary")
    return [bytes(r["block"]) for r in cut.orderBy(F.xxhash64("block"), "block").limit(most).collect()]


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE, blocks: int = BLOCKS, block: int = BLOCK, dictionary: int = DICTIONARY, level: int = LEVEL) -> Model:
    """Learns from rows that aren't held out; what reaches the driver is bounded by ``blocks`` and ``sample``."""
    shelf = Shelf(docs.sparkSession, "compression")
    try:
        rows, n = labelled_sample(docs, labels, key, text, label, sample)
        rows = shelf.put(rows)
        half = F.pmod(F.xxhash64(F.lit(3), "text"), F.lit(2)) == 0  # equal texts go to one side
        good, bad = (trained(x, dictionary) if (x := blocks_of(rows.where(half & (F.col("label") == k)), block, blocks)) else b"" for k in (1, 0))
        model = Model(good, bad, block=block, level=level)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([model.difference(x) for x in utf8(b.column(0))], pa.float64()), b.column(1)], names=["x", "label"])

        got = rows.where(~half).select("text", "label").mapInArrow(run, "x double, label int").toPandas()
        got = got.sort_values(["x", "label"])
    finally:
        shelf.clear()
    y, total = got["label"].to_numpy(np.float64), sum(n.values())
    if good and bad and len(set(y.tolist())) == 2:
        mine = np.where(y == 1, n[1] / (y == 1).sum(), n[0] / (y == 0).sum())  # so each label weighs as much as it has keys
        model.bias, model.slope = logistic(got["x"].to_numpy(), y, mine * len(y) / mine.sum())
    elif total:
        share = min(max(n.get(1, 0) / total, 1e-6), 1 - 1e-6)
        model.bias = float(np.log(share / (1 - share)))
    return model


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted and the normalised difference of every row, from its text alone."""

    def run(keys: list, texts: list) -> dict[str, list]:
        x = np.array([model.difference(b"" if t is None else t.encode()) for t in texts], np.float64)
        s = model.score(x)
        return {"doc_id": keys, "score": s, "predicted": (s >= 0.5).astype(np.int32), "difference": x}

    out = map_texts(picked(docs, key, text), run, "doc_id long, score double, predicted int, difference double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "difference")
