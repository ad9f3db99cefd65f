"""Byte-level helpers shared by the text operators: packing texts into one buffer, words, hashes.

Hashes are sums of random byte values times powers of an odd base, modulo 2^64, and are mixed
before use. Two independent lanes give 128 bits where equality must be certain.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240607))
#: Random value of each byte, and the odd bases, for the two lanes.
BYTE_VALUES = _rng.integers(1, 2**64, (2, 256), dtype=U) | U(1)
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[tuple[int, int], np.ndarray] = {}


def powers(lane: int, n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the lane's base (or of its inverse) modulo 2^64."""
    have = _powers.get((lane, inverse))
    if have is None or len(have) < n:
        base = pow(BASES[lane], -1, 2**64) if inverse else BASES[lane]
        steps = np.full(max(n, 1024) + 1, base, U)
        steps[0] = 1
        have = _powers[lane, inverse] = np.multiply.accumulate(steps)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes (splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Packed:
    """Texts joined into one byte buffer with a line feed behind each, and their words' places."""

    def __init__(self, texts: list[bytes], is_space: np.ndarray = IS_SPACE):
        self.n = len(texts)
        self.data = b"\n".join(texts) + b"\n" if texts else b""
        self.buf = np.frombuffer(self.data, np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, self.n)
        self.ends = np.cumsum(sizes + 1) - 1
        self.begins = self.ends - sizes
        inside = np.empty(len(self.buf) + 1, np.int8)
        inside[0] = 0
        np.logical_not(is_space[self.buf], out=inside[1:].view(bool))
        edge = np.diff(inside)
        self.word_start = np.flatnonzero(edge == 1)
        self.word_end = np.flatnonzero(edge == -1)
        self.word_doc = np.searchsorted(self.ends, self.word_start, side="right").astype(np.int64)
        self.first_word = np.searchsorted(self.word_doc, np.arange(self.n + 1))

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.first_word)

    def word_hashes(self, lane: int = 0) -> np.ndarray:
        """A hash of each word's bytes, before mixing."""
        if not len(self.word_start):
            return np.zeros(0, U)
        size = self.word_end - self.word_start
        keep = np.repeat(self.word_start - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        at = np.arange(len(keep))
        keep += at
        first = np.concatenate(([0], np.cumsum(size)[:-1]))
        at -= np.repeat(first, size)
        values = BYTE_VALUES[lane][self.buf[keep]] * powers(lane, int(size.max()))[at]
        return mix(np.add.reduceat(values, first))

    def window_hashes(self, words: np.ndarray, n: int, lane: int = 0) -> np.ndarray:
        """For each word that begins n words of one text, a hash of those; 0 elsewhere (see ``windows``)."""
        out = np.zeros(len(words), U)
        m = len(words) - n + 1
        if m <= 0:
            return out
        by = powers(lane, n)
        total = words[:m].copy()
        for k in range(1, n):
            total += words[k : k + m] * by[k]
        out[:m] = mix(total)
        return out

    def windows(self, n: int) -> np.ndarray:
        """Whether each word begins n consecutive words of its text."""
        ok = np.zeros(len(self.word_doc), bool)
        m = len(ok) - n + 1
        if m > 0:
            ok[:m] = self.word_doc[:m] == self.word_doc[n - 1 :]
        return ok


def spread(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """A mask of size places, true where some start covers them with its length."""
    step = np.zeros(size + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + length, size), -1)
    return np.cumsum(step[:-1]) > 0


def chunks(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about limit bytes; a longer text is alone."""
    at, used = 0, 0
    for k, x in enumerate(texts):
        if used and used + len(x) > limit:
            yield at, k
            at, used = k, 0
        used += len(x)
    if at < len(texts):
        yield at, len(texts)


def encode(texts: list[str | None]) -> list[bytes]:
    """UTF-8 of each text, of a null none."""
    return [b"" if x is None else x.encode() for x in texts]


def ranges(texts: pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of an Arrow column of about limit bytes, found without converting it; a longer text is alone."""
    at, used = 0, 0
    for k, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if used and used + n > limit:
            yield at, k
            at, used = k, 0
        used += n
    if at < len(texts):
        yield at, len(texts)


def utf8(texts: pa.Array) -> list[bytes]:
    """UTF-8 of each text of an Arrow column, of a null none."""
    return [x or b"" for x in texts.cast(pa.binary()).to_pylist()]


def picked(df: DataFrame, key: str, text: str) -> DataFrame:
    """Only the key and the text, as (doc_id long, text string); other columns can't clash."""
    return df.select(column(key).cast("long").alias("doc_id"), column(text).cast("string").alias("text"))


#: What operators remember in this worker, by name, and how they forget it.
_remembered: dict[str, Callable[[], object]] = {}


def remember(owner: str, forget: Callable[[], object]) -> None:
    """A worker serves many operators: what one has remembered in it goes when it starts to work for another."""
    _remembered[owner] = forget


def only(owner: str | None) -> None:
    for name in [x for x in _remembered if x != owner]:
        _remembered.pop(name)()


#: Texts of about so many bytes are converted and worked on at a time; a batch from Spark may hold far more.
PART = 4 << 20


def map_texts(df: DataFrame, f: Callable[[list, list], dict[str, list]], schema: str, owner: str | None = None) -> DataFrame:
    """Applies f(keys, texts) -> columns to a frame from ``picked``, part by part of its Arrow batches; ``owner``: see ``remember``."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(owner)
        for b in batches:
            for i, j in ranges(b.column(1), PART):
                out = f(b.column(0).slice(i, j - i).to_pylist(), b.column(1).slice(i, j - i).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(out[x.name], x.type) for x in arrow], schema=arrow)
            pa.default_memory_pool().release_unused()  # a worker serves many tasks

    return df.mapInArrow(run, schema)


def text_udf(f: Callable[[list[str | None]], list], kind: str, arrow: pa.DataType, owner: str | None = None) -> Callable[[Column], Column]:
    """A column function of texts that works part by part of its Arrow batches; ``owner``: see ``remember``."""

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        only(owner)
        parts = [pa.array(f(texts.slice(i, j - i).to_pylist()), arrow) for i, j in ranges(texts, PART)]
        pa.default_memory_pool().release_unused()
        return pa.concat_arrays(parts) if parts else pa.array([], arrow)

    return run


def fresh(*frames: DataFrame, names: tuple[str, ...]) -> list[str]:
    """Column names that no frame has, in any case."""
    taken, out = {c.lower() for df in frames for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share. Only a session on one machine, as in tests, may leave it unset: it gets the warehouse."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def opened(uri: str):
    """(file system, path) of a URI or a plain path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class Shelf:
    """Tables written to a folder of the shared one, to cut lineages; the folder goes when the work is done.

    Written tables rather than checkpoints: a checkpoint keeps the size that the optimiser has guessed for
    it, a join's guess is the product of its sides', and over some rounds of joins that number alone would
    fill the driver's memory. A table has the size of its files.
    """

    ROWS = 100_000

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.n = spark, f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}", 0
        #: How many rows the next tables have at most, if that is known: a file holds ``ROWS`` then.
        self.most: int | None = None

    def put(self, df: DataFrame, tasks: int | None = None) -> DataFrame:
        """The written table; ``tasks``: how many write it at most."""
        if tasks is None and self.most is not None:
            tasks = self.most // self.ROWS + 1
        self.n += 1
        (df if tasks is None else df.coalesce(tasks)).write.parquet(path := f"{self.folder}/{self.n}")
        return self.spark.read.schema(df.schema).parquet(path)

    def counted(self, df: DataFrame, tasks: int | None = None) -> tuple[DataFrame, int]:
        """The written table and its rows, counted as they are written."""
        seen = Observation()
        out = self.put(df.observe(seen, F.count(F.lit(1)).alias("n")), tasks)
        return out, seen.get["n"]

    def clear(self) -> None:
        files, path = opened(self.folder)
        files.delete_dir(path)


def column(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col(f"`{name.replace('`', '``')}`")
