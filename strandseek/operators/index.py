"""What an approximate search learns: centres of lists, codebooks of residuals, a rotation, how far to look.

All of it is learned on executors from a sample of the database whose expected size is a parameter:
centres by k-means|| and Lloyd's steps as aggregates, codebooks part by part in parallel, a rotation in
one task, from fewer rows. What comes back is what has been learned.
"""

from __future__ import annotations

import io
import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandseek.functions.vectors import norm
from strandseek.params import SearchParams

#: Expected rows of the training sample, of those that codebooks and a rotation are learned from, and of those whose neighbours say how far to look.
TRAINING_ROWS, CODE_ROWS, ROTATION_ROWS, DEPTH_QUERIES = 250_000, 65_536, 16_384, 256
#: Numbers of one work array.
SCORES = 4 << 20
#: Rounds of rotation and codebooks in turn.
ROUNDS = 10
FINE = 1 << 30


def matrix(column: pa.Array | pa.ChunkedArray, kind: type = np.float64) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(n, -1) if n else np.zeros((0, 0), kind)


def near_centres(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row; the work array is bounded."""
    squares, step = (centres**2).sum(1)[None, :], max(1, SCORES // len(centres))
    return np.concatenate([(squares - 2 * x[k : k + step] @ centres.T).argmin(1) for k in range(0, len(x), step)] or [np.zeros(0, np.int64)])


def k_means(x: np.ndarray, k: int, steps: int = 10, seed: int = 0, centres: np.ndarray | None = None) -> np.ndarray:
    """Lloyd's algorithm on rows that one task holds; empty clusters keep their centres."""
    if centres is None:
        centres = x[np.sort(np.random.default_rng(seed).choice(len(x), min(k, len(x)), replace=False))]
    centres = centres.copy()
    for _ in range(steps):
        of = near_centres(x, centres)
        order = np.argsort(of, kind="stable")
        there, first = np.unique(of[order], return_index=True)
        centres[there] = np.add.reduceat(x[order], first, axis=0) / np.diff(np.append(first, len(of)))[:, None]
    return centres


def allocated(variances: np.ndarray, parts: int) -> np.ndarray:
    """The order of principal axes that gives each of so many parts about the same product of variances: the greatest left goes to the least part."""
    size = -(-len(variances) // parts)
    held: list[list[int]] = [[] for _ in range(parts)]
    weight = np.zeros(parts)
    for k in np.argsort(-variances, kind="stable").tolist():
        part = min((j for j in range(parts) if len(held[j]) < size), key=lambda j: (weight[j], j))
        held[part].append(k)
        weight[part] += np.log(max(variances[k], 1e-12))
    return np.array([k for x in held for k in x])


def cuts_of(d: int, parts: int) -> np.ndarray:
    return np.linspace(0, d, min(parts, d) + 1).astype(int)


def pieces(y: np.ndarray, books: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """Each codebook's number and its columns of some vectors."""
    at = 0
    for k, book in enumerate(books):
        yield k, y[:, at : at + book.shape[1]]
        at += book.shape[1]


def rotated_books(x: np.ndarray, parts: int, codes: int, first_parts: int, rounds: int = ROUNDS) -> tuple[np.ndarray, list[np.ndarray]]:
    """A rotation and codebooks, in turn: codebooks of the rotated rows, then the rotation that brings the rows nearest to their codes (orthogonal Procrustes)."""
    d = x.shape[1]
    variances, axes = np.linalg.eigh(np.atleast_2d(np.cov(x, rowvar=False)))
    rotation = axes[:, allocated(variances, max(1, min(first_parts, d)))]
    cuts = cuts_of(d, parts)
    books = [k_means(x @ rotation[:, a:b], codes, seed=int(a)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    for _ in range(rounds):
        coded = np.concatenate([books[k][near_centres(y, books[k])] for k, y in pieces(x @ rotation, books)], axis=1)
        left, _, right = np.linalg.svd(x.T @ coded)
        rotation = left @ right
        books = [k_means(y, codes, 3, centres=books[k]) for k, y in pieces(x @ rotation, books)]
    return rotation, books


@dataclass
class Index:
    """What a search needs beside the rows: all of it bounded by the parameters, not by the data."""

    kind: str
    by_l2: bool
    centres: np.ndarray | None = None
    rotation: np.ndarray | None = None
    codebooks: list[np.ndarray] | None = None
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    #: Links of a node and candidates of its insertion, of a graph.
    links: int = 0
    ef_construction: int = 0
    #: How many lists, and how many candidates of each shard of a graph, hold the neighbours that are aimed at; 0 where that isn't learned.
    lists_needed: int = 0
    candidates_needed: int = 0
    #: How far a code's score may fall below the exact one; all rows of the probed lists are candidates where that isn't learned.
    slack: float = np.inf

    @property
    def graph(self) -> bool:
        return self.kind.startswith("hnsw")

    @property
    def coded(self) -> bool:
        return self.codebooks is not None or self.low is not None

    def lists(self, x: np.ndarray) -> np.ndarray:
        return near_centres(x, self.centres) if self.centres is not None else np.zeros(len(x), np.int64)

    def order(self, q: np.ndarray) -> np.ndarray:
        """The lists of each query, the nearest centre first."""
        return np.argsort((self.centres**2).sum(1)[None, :] - 2 * q @ self.centres.T, axis=1, kind="stable")

    def probes(self, q: np.ndarray, n: int) -> np.ndarray:
        """Whether each query looks into each list: its n nearest centres."""
        if self.centres is None:
            return np.ones((len(q), 1), bool)
        out = np.zeros((len(q), len(self.centres)), bool)
        np.put_along_axis(out, self.order(q)[:, :n], True, 1)
        return out

    def rotate(self, x: np.ndarray) -> np.ndarray:
        return x if self.rotation is None else x @ self.rotation

    def residuals(self, x: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """What codes describe: the rows less the centres of their lists, rotated."""
        return self.rotate(x if self.centres is None else x - self.centres[lists])

    @property
    def step(self) -> np.ndarray:
        return np.maximum(self.high - self.low, 1e-12) / 255

    @property
    def code_type(self) -> np.dtype:
        return np.dtype("<u1" if self.low is not None or max(map(len, self.codebooks)) <= 256 else "<u2")

    def code(self, x: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """The vectors' codes, a row each."""
        if self.low is not None:
            return np.clip(np.rint((x - self.low) / self.step), 0, 255).astype(self.code_type)
        return np.stack([near_centres(y, self.codebooks[k]) for k, y in pieces(self.residuals(x, lists), self.codebooks)], axis=1).astype(self.code_type)

    def coded_residuals(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([book[codes[:, k]] for k, book in enumerate(self.codebooks)], axis=1)

    def decoded(self, codes: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """The vectors as their codes describe them: graphs of coded vectors are built over these, searches never make them."""
        if self.low is not None:
            return self.low + codes * self.step
        z = self.coded_residuals(codes)
        z = z if self.rotation is None else z @ self.rotation.T
        return z if self.centres is None else z + self.centres[lists]

    def tables(self, q: np.ndarray) -> list[np.ndarray]:
        """For each part its codes' inner products with each query: what a search adds up instead of vectors."""
        return [np.ascontiguousarray((y @ self.codebooks[k].T).T.astype(np.float32)) for k, y in pieces(self.rotate(q), self.codebooks)]

    def offsets(self, codes: np.ndarray, lists: np.ndarray) -> np.ndarray:
        """The part of a squared distance that depends on the row alone: its residual's square and twice its product with the centre."""
        z = self.coded_residuals(codes)
        out = (z**2).sum(1)
        if self.centres is not None:
            out += 2 * (self.rotate(self.centres)[lists] * z).sum(1)
        return out.astype(np.float32)

    def dump(self) -> bytes:
        out = io.BytesIO()
        arrays = {f.name: getattr(self, f.name) for f in fields(self) if f.name != "codebooks" and getattr(self, f.name) is not None}
        np.savez(out, **arrays, **{f"book{k}": x for k, x in enumerate(self.codebooks or [])})
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Index:
        got = dict(np.load(io.BytesIO(data)))
        books = [got.pop(f"book{k}") for k in range(sum(n.startswith("book") for n in got))]
        plain = {k: v.item() if v.ndim == 0 else v for k, v in got.items()}
        return Index(codebooks=books or None, **plain)


def table_scores(index: Index, tables: list[np.ndarray], codes: np.ndarray, mine: np.ndarray) -> np.ndarray:
    """Rows by queries: the sums of the tables' entries that the codes name, for the queries ``mine``."""
    out = np.zeros((len(codes), len(mine)), np.float32)
    for k, t in enumerate(tables):
        out += t[:, mine][codes[:, k]] if len(codes) * 4 > len(t) else t[codes[:, k][:, None], mine[None, :]]
    return out


def sampled(database: DataFrame, have: int, rows: int, seed: int = 0) -> DataFrame:
    """The vectors of about so many rows, drawn by a hash of their place; all where there are no more."""
    if have <= rows:
        return database.select("vector")
    drawn = F.pmod(F.xxhash64(F.lit(seed), "transcript_id", "window_start"), F.lit(FINE))
    return database.where(drawn < int(FINE * rows / have)).select("vector")


def gathered(rows: DataFrame, f: Callable[[np.ndarray], bytes]) -> bytes:
    """f of all vectors of a bounded sample, in one task."""

    def run(table: pa.Table) -> pa.Table:
        return pa.table({"learned": pa.array([f(matrix(table.column("vector")))], pa.binary())})

    return bytes(rows.select(F.lit(0).alias("all"), "vector").groupBy("all").applyInArrow(run, "learned binary").first()[0])


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(data)))


def trained_centres(rows: DataFrame, k: int, seed: int = 0) -> np.ndarray:
    """Centres by k-means|| and Lloyd's steps; each step is an aggregate over the rows."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    model = KMeans(k=k, initMode="k-means||", maxIter=10, seed=seed).fit(rows.select(array_to_vector(F.col("vector").cast("array<double>")).alias("features")))
    return np.stack(model.clusterCenters())


def trained_books(rows: DataFrame, index: Index, parts: int, codes: int) -> list[np.ndarray]:
    """Codebooks of the residuals' parts, each part learned by a task of its own."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column(0))
            y = index.residuals(x, index.lists(x)).astype(np.float32)
            cuts = cuts_of(y.shape[1], parts)
            each = [(k, np.ascontiguousarray(y[:, i:j]).tobytes(), j - i) for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in each], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.int32()))], names=["part", "rows", "d"])

    def learn(table: pa.Table) -> pa.Table:
        part, d = table.column("part")[0].as_py(), table.column("d")[0].as_py()
        held = sorted(table.column("rows").to_pylist())  # the same whatever order the rows came in
        x = np.frombuffer(b"".join(held), np.float32).reshape(-1, d).astype(np.float64)
        return pa.table({"part": pa.array([part], pa.int32()), "book": pa.array([packed(book=k_means(x, codes, seed=part))], pa.binary())})

    got = rows.mapInArrow(cut, "part int, rows binary, d int").groupBy("part").applyInArrow(learn, "part int, book binary").orderBy("part").collect()
    return [unpacked(bytes(r["book"]))["book"] for r in got]


def aim_of(recall: float) -> float:
    """What lists and codes aim at each, so that both together reach the recall."""
    return 1 - (1 - recall) / 3


def drawn_places(database: DataFrame, have: int, rows: int, seed: int) -> DataFrame:
    """About so many whole rows of the database, drawn by a hash of their place."""
    drawn = F.pmod(F.xxhash64(F.lit(seed), "transcript_id", "window_start"), F.lit(FINE))
    return database.where(drawn < max(1, int(FINE * min(1.0, rows / max(have, 1)))))


def mean_norm(database: DataFrame, rows: int = 1000) -> float | None:
    """The mean norm of the first rows, nothing of no rows."""
    return database.limit(rows).agg(F.avg(norm("vector"))).first()[0]


def warn_of_norms(mean: float, p: SearchParams, within: float = 0.01) -> None:
    if not p.by_l2 and abs(mean - 1) > within:
        warnings.warn("the vectors' mean norm isn't about 1: inner products aren't cosines", stacklevel=3)


def trained_index(database: DataFrame, p: SearchParams) -> Index:
    """Learns what the index type needs; warns if vectors taken for unit vectors aren't."""
    kind, mean = p.index_type, mean_norm(database)
    if mean is None:
        raise ValueError("No database windows")
    warn_of_norms(mean, p)
    index = Index(kind, p.by_l2)
    if index.graph:
        index.links, index.ef_construction = p.hnsw_m, p.ef_construction
    if kind in ("flat_ip", "flat_l2", "hnsw"):
        return index
    have = database.count()
    few = lambda n: sampled(database, have, n)
    if not index.graph:
        rows = few(TRAINING_ROWS).persist()
        index.centres = trained_centres(rows, p.nlist)
        rows.unpersist()
    if kind in ("ivfpq", "hnswpq"):
        index.codebooks = trained_books(few(CODE_ROWS), index, p.pq_m, 2**p.pq_bits)
    elif kind == "opq_ivfpq":
        got = unpacked(gathered(few(ROTATION_ROWS), lambda x: (lambda r, books: packed(rotation=r, **{f"book{k}": b for k, b in enumerate(books)}))(*rotated_books(index.residuals(x, index.lists(x)), p.pq_m, 2**p.pq_bits, p.opq_m))))
        index.rotation, index.codebooks = got["rotation"], [got[f"book{k}"] for k in range(len(got) - 1)]
    elif kind == "hnswsq8":
        ends = database.select(F.posexplode("vector").alias("k", "v")).groupBy("k").agg(F.min("v").alias("low"), F.max("v").alias("high")).orderBy("k").collect()
        index.low, index.high = (np.array([r[c] for r in ends], np.float64) for c in ("low", "high"))
    return index
