"""Nearest neighbours: exact, inverted lists with or without codes, and proximity graphs.

The query windows are a stated set and far fewer than the database's: they are broadcast, a block of
bounded size at a time, and the database streams past them in Arrow batches as matrix products of
bounded size. Each task keeps the k best of each query, a block of queries at a time, so what is shuffled is k rows a query and
task, never the database; a window's rank then settles the k best.

An index is a table made of the database's rows. Inverted lists add the list of the nearest centre and,
for product codes, the code of the vector's residual; a search adds up the codes' entries in a query's tables
and makes no vectors of them. Graphs put a shard of rows with all its links into one row (``graph.py``).
``write_index`` stores such a table, ``read_index`` reads it back. A search reads only lists that some query
probes and scores a row only for the queries that probe its list; exact scores are worked out for what it keeps.

Ranks are those of the index's own scores. With ``recall`` set, candidates are ranked by exact scores where they are
found, and how far to look is learned from exact neighbours in the whole database: how many lists to probe, how far a
code's score may fall below the exact one (a row is a candidate while its code doesn't leave it further than that
behind the k-th best so far, however many there are), and how wide a graph's beam must be.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandseek.functions.vectors import clip, cosine_of_distance
from strandseek.operators import graph
from strandseek.operators.index import DEPTH_QUERIES, SCORES, Index, aim_of, drawn_places, matrix, table_scores, trained_index
from strandseek.params import SearchParams

#: Bytes of query vectors held at once; more queries are searched in more passes over the database.
QUERY_BYTES = 64 << 20
#: Pairs of a query and a row that a task holds at once beside the best so far.
PAIRS = 1 << 18
#: Exact scores that a task works out at once where no codes come before: a few arrays of so many stay in a core's cache.
WORKED = 1 << 19
#: A beam of more than one in so many of a shard's rows compares nearly all of them (measured on unrelated vectors): they are scored at once instead.
SCANNED = 16
#: Beams that compare more than one in so many of all pairs cost more than exact scores of all: a pair of a beam costs some 40 times one of a product (192 components).
WALKED = 8
#: The width of a beam that stands for a scan of all rows.
WHOLE = 2**31 - 1
#: Rows and bytes of vectors of a graph's shard at most.
SHARD_ROWS, SHARD_BYTES = 10_000, 64 << 20
PLACE = ("transcript_id", "window_index", "window_start", "window_end")
HITS = (
    "query_transcript string, query_window_index int, query_window_start int, query_window_end int, "
    "target_transcript string, target_window_index int, target_window_start int, target_window_end int, score double, exact double"
)
SHARD = "shard int, transcript_id array<string>, window_index array<int>, window_start array<int>, window_end array<int>, vectors binary, codes binary, links array<binary>"


def build_index(database: DataFrame, p: SearchParams) -> Index:
    """Learns what the index type needs, and for a recall how many lists hold it; warns if vectors taken for unit vectors aren't."""
    index = trained_index(database, p)
    if p.recall is not None and index.centres is not None:
        index.lists_needed, index.slack = depth_needed(database, index, p.k, p.recall)
    return index


def depth_needed(database: DataFrame, index: Index, k: int, recall: float) -> tuple[int, float]:
    """What holds the k nearest rows of the whole database to some drawn ones of it, but for a small share: how many lists must be probed, and how far a code's score falls below the exact one.

    The neighbours are found by an exact search for ``DEPTH_QUERIES`` expected rows; only the places of their lists and
    the differences of their scores come back.
    """
    asked = drawn_places(database, database.count(), DEPTH_QUERIES, 1).select(*PLACE, "vector")
    flat = Index("flat_l2" if index.by_l2 else "flat_ip", index.by_l2)
    near = neighbours(asked, database, SearchParams(k=k + 1, index_type=flat.kind, metric="l2" if index.by_l2 else "ip"), flat)
    near = near.where((F.col("query_transcript") != F.col("target_transcript")) | (F.col("query_window_start") != F.col("target_window_start")))
    to = near.select(F.col("target_transcript").alias("transcript_id"), F.col("target_window_start").alias("window_start"), F.col("query_transcript").alias("of"), F.col("query_window_start").alias("of_start"))
    theirs = database.select("transcript_id", "window_start", F.col("vector").alias("theirs")).join(F.broadcast(to), ["transcript_id", "window_start"])  # k + 1 rows a query
    mine = asked.select(F.col("transcript_id").alias("of"), F.col("window_start").alias("of_start"), F.col("vector").alias("mine"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                q, x = matrix(b.column(0)), matrix(b.column(1))
                lists = index.lists(x)
                place = np.argsort(index.order(q), axis=1)  # the place of each list among a query's
                found = np.take_along_axis(place, lists[:, None], 1)[:, 0]
                below = np.zeros(len(x))
                if index.coded:
                    z = index.decoded(index.code(x, lists), lists)
                    below = ((q - z) ** 2 - (q - x) ** 2).sum(1) if index.by_l2 else (q * (x - z)).sum(1)
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array(below)], names=["place", "below"])

    found = theirs.join(F.broadcast(mine), ["of", "of_start"]).select("mine", "theirs").mapInArrow(run, "place int, below double").toArrow()
    if not found.num_rows:
        return 1, 0.0
    lists, below = (np.quantile(c.to_numpy(), aim_of(recall), method="higher") for c in found.columns)
    return int(lists) + 1, float(below)


def beam_needed(queries: DataFrame, shards: DataFrame, index: Index, p: SearchParams) -> int:
    """How many candidates of each shard hold the k nearest rows of all shards to some drawn query windows, but for a small share.

    The neighbours are found by an exact search of the shards; beams double until enough of them are found, or until they
    compare more pairs than pays: ``WHOLE`` then, and all rows are scored exactly.
    """
    asked = drawn_places(queries, queries.count(), DEPTH_QUERIES, 1).select("vector").toArrow().column(0)
    q, k = matrix(asked), p.k
    if not len(q):
        return 0
    shared = shards.sparkSession.sparkContext.broadcast(q)

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for b in batches:
            for n in range(b.num_rows):
                shard = Shard(b, n, index)
                score = shard.exact(q)
                query, row = np.nonzero(best_of(score, k))
                yield pa.RecordBatch.from_arrays([pa.array(query), pa.array([b.column("shard")[n].as_py()] * len(query), pa.int32()), pa.array(row), pa.array(score[query, row])], names=["query", "shard", "row", "score"])

    by = Window.partitionBy("query").orderBy(F.desc("score"), "shard", "row")
    near = shards.mapInArrow(exact, "query long, shard int, row long, score double").withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    near = near.select("shard", "query", "row").toArrow().combine_chunks()  # k rows a drawn query
    true = shards.sparkSession.sparkContext.broadcast(tuple(near.column(c).to_numpy() for c in ("shard", "query", "row")))

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, (of, query, row) = shared.value, true.value
        for b in batches:
            for n in range(b.num_rows):
                mine, shard, ef, tries = of == b.column("shard")[n].as_py(), Shard(b, n, index), max(2 * k, 64), []
                pairs = len(q) * len(shard.x)
                while mine.any():
                    got = shard.search(q, ef)
                    tries.append((ef, int((got.nodes[query[mine]] == row[mine, None]).any(1).sum()), got.compared, pairs))
                    if got.compared * WALKED > pairs:  # a wider one compares more
                        break
                    ef *= 2
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*tries)] if tries else [pa.array([], pa.int64())] * 4, names=["ef", "found", "compared", "pairs"])

    got = shards.mapInArrow(tried, "ef long, found long, compared long, pairs long")
    each = got.groupBy("ef").agg(*[F.sum(c).alias(c) for c in ("found", "compared", "pairs")], F.count("*").alias("shards")).orderBy("ef").collect()
    for r in each:
        if r["shards"] < each[0]["shards"] or r["compared"] * WALKED > r["pairs"]:
            return WHOLE
        if r["found"] >= aim_of(p.recall) * near.num_rows:
            return r["ef"]
    return 0


def walked(queries: DataFrame, shards: DataFrame, index: Index, p: SearchParams) -> bool:
    """Whether the narrowest beams compare few enough pairs of some drawn query windows to be worth their graphs."""
    asked = drawn_places(queries, queries.count(), DEPTH_QUERIES, 1).select("vector").toArrow().column(0)
    shared = shards.sparkSession.sparkContext.broadcast(matrix(asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for b in batches:
            held = [Shard(b, n, index) for n in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([pa.array([x.search(q, max(2 * p.k, 64)).compared for x in held], pa.int64()), pa.array([len(q) * len(x.x) for x in held], pa.int64())], names=["compared", "pairs"])

    got = shards.mapInArrow(run, "compared long, pairs long").collect() if len(asked) else []
    return sum(r["compared"] for r in got) * WALKED <= sum(r["pairs"] for r in got)


def indexed(database: DataFrame, index: Index) -> DataFrame:
    """The table that a search of the index reads: shards of a graph, or places and vectors with ``list`` and, for product codes, ``code``."""
    if index.graph:
        return graphed(database, index)
    ddl = f"transcript_id string, window_index int, window_start int, window_end int, vector array<{dict(database.dtypes)['vector'][6:-1]}>, list int" + (", code binary, offset float" if index.coded else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = matrix(b.column("vector"))
            lists = index.lists(x)
            arrays = [*b.columns, pa.array(lists, pa.int32())]
            if index.coded:
                codes = index.code(x, lists)
                arrays += [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(index.offsets(codes, lists) if index.by_l2 else np.zeros(len(x), np.float32), pa.float32())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*b.schema.names, "list", "code", "offset"][: len(arrays)])

    return database.select(*PLACE, "vector").mapInArrow(run, ddl).sortWithinPartitions("list")


def shards_of(database: DataFrame) -> int:
    size = database.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("d")).first()
    return -(-size["n"] // max(1, min(SHARD_ROWS, SHARD_BYTES // (4 * (size["d"] or 1))))) or 1


def graphed(database: DataFrame, index: Index, shards: int | None = None, first: bool = False, linked: bool = True) -> DataFrame:
    """The graph of each shard of rows, or of the first one alone. Shards are drawn by a hash of the place, so each has rows from everywhere; shards that are scanned need no links."""
    shards = shards or shards_of(database)
    place = [F.col(c) for c in PLACE]

    def build(table: pa.Table) -> pa.Table:
        level = graph.levels(table.column("drawn").to_numpy().astype(np.uint64), index.links)
        order = pa.array(np.lexsort((table.column("drawn").to_numpy(), -level)))
        table, level = table.take(order).combine_chunks(), np.sort(level)[::-1]
        x, none = matrix(table.column("vector"), np.float32), np.zeros(table.num_rows, np.int64)
        codes = index.code(x, none) if index.coded else np.zeros((0, 0), np.uint8)
        links = graph.build(graph.Space(index.decoded(codes, none) if index.coded else x, index.by_l2), level, index.links, index.ef_construction) if linked else []
        one = lambda c, kind: pa.array([table.column(c).to_pylist()], pa.list_(kind))
        places = {c: one(c, pa.string() if k == 0 else pa.int32()) for k, c in enumerate(PLACE)}
        return pa.table({
            "shard": table.column("shard").slice(0, 1), **places, "vectors": pa.array([x.tobytes()], pa.binary()), "codes": pa.array([codes.tobytes()], pa.binary()),
            "links": pa.array([[x.astype(np.int32).tobytes() for x in links]], pa.list_(pa.binary())),
        })

    drawn = F.xxhash64("transcript_id", "window_start")
    rows = database.select(*place, "vector", drawn.alias("drawn"), F.pmod(F.xxhash64(F.lit(7), "transcript_id", "window_start"), F.lit(shards)).cast("int").alias("shard"))
    rows = rows.where(F.col("shard") == 0) if first else rows
    return rows.groupBy("shard").applyInArrow(build, SHARD)


def write_index(database: DataFrame, index: Index, path: str) -> None:
    """Stores the rows by list, large lists over several files, or the shards, and what the index has learned beside them."""
    rows = indexed(database, index)
    (rows.write if index.graph else rows.hint("rebalance", "list").write.partitionBy("list")).parquet(f"{path}/rows")
    database.sparkSession.createDataFrame([(index.dump(),)], "learned binary").write.parquet(f"{path}/learned")


def is_stored(spark: SparkSession, path: str) -> bool:
    """Whether an index is stored whole; what it has learned is written last."""
    from pyspark.errors import AnalysisException

    try:
        return not spark.read.parquet(f"{path}/learned").isEmpty()
    except AnalysisException:
        return False


def read_index(spark: SparkSession, path: str) -> tuple[Index, DataFrame]:
    """A stored index: what it has learned and its rows, for ``neighbours(..., index=...)``."""
    return Index.load(bytes(spark.read.parquet(f"{path}/learned").first()[0])), spark.read.parquet(f"{path}/rows")


def index_stats(database: DataFrame, p: SearchParams) -> DataFrame:
    return database.agg(F.count("*").alias("vectors"), F.max(F.size("vector")).alias("dimension")).select(F.lit(p.index_type).alias("index_type"), F.lit(p.metric).alias("metric"), "vectors", "dimension")


def best_of(score: np.ndarray, k: int) -> np.ndarray:
    """A mask of the k greatest finite scores of each row, the first ones of ties."""
    if score.shape[1] <= k:
        return np.isfinite(score)
    kth = -np.partition(-score, k - 1, axis=1)[:, k - 1 : k]
    more, ties = score > kth, score == kth
    return (more | (ties & (ties.cumsum(1) <= k - more.sum(1, keepdims=True)))) & np.isfinite(score)


class Best:
    """The k best rows of each query that a task has seen, as pairs (query, row of ``places``)."""

    def __init__(self, n: int, k: int):
        self.n, self.k = n, k
        self.places: pa.Table | None = None
        self.query = self.row = np.zeros(0, np.int64)
        self.score = self.exact = np.zeros(0)

    def floor(self) -> np.ndarray:
        """What a new row must reach to matter to each query."""
        out = np.full(self.n, -np.inf)
        full = np.bincount(self.query, minlength=self.n) >= self.k
        low = np.full(self.n, np.inf)
        np.minimum.at(low, self.query, self.score)
        out[full] = low[full]
        return out

    def add(self, places: pa.Table, query: np.ndarray, row: np.ndarray, score: np.ndarray, exact: np.ndarray) -> None:
        base = 0 if self.places is None else self.places.num_rows
        places = places if self.places is None else pa.concat_tables([self.places, places])
        query, row = np.concatenate((self.query, query)), np.concatenate((self.row, row + base))
        score, exact = np.concatenate((self.score, score)), np.concatenate((self.exact, exact))
        used, row = np.unique(row, return_inverse=True)
        places = places.take(pa.array(used)).combine_chunks()
        rank = np.empty(len(used), np.int64)
        rank[pc.sort_indices(places, [("transcript_id", "ascending"), ("window_start", "ascending")]).to_numpy()] = np.arange(len(used))  # ties in target order
        order = np.lexsort((rank[row], -score, query))
        place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        keep = order[place < self.k]
        self.places, self.query, self.row, self.score, self.exact = places, query[keep], row[keep], score[keep], exact[keep]


def hits_of(places: pa.Table, best: Best) -> Iterator[pa.RecordBatch]:
    """The rows of ``HITS`` that a task has kept."""
    if best.places is not None:
        own, theirs = places.take(pa.array(best.query)).combine_chunks(), best.places.take(pa.array(best.row)).combine_chunks()
        out = pa.table([*own.columns, *theirs.columns, pa.array(best.score), pa.array(best.exact)], names=[f.split()[0] for f in HITS.split(", ")])
        yield from out.to_batches(max_chunksize=10_000)


def exact_scores(q: np.ndarray, x: np.ndarray, query: np.ndarray, row: np.ndarray, by_l2: bool) -> np.ndarray:
    """Inner products or squared distances of pairs."""
    step = max(1, SCORES // max(1, q.shape[1]))
    product = np.concatenate([(q[query[j : j + step]] * x[row[j : j + step]]).sum(1) for j in range(0, len(query), step)] or [np.zeros(0)])
    return np.round((q**2).sum(1)[query] + (x**2).sum(1)[row] - 2 * product if by_l2 else product, 12)


def query_blocks(n: int, k: int) -> list[slice]:
    """Ranges of n queries of which a task works on one at a time, with ``PAIRS`` pairs of k rows a query at most."""
    step = max(1, PAIRS // max(1, k))
    return [slice(j, min(n, j + step)) for j in range(0, n, step)]


def candidates(places: pa.Table, q: np.ndarray, rows: DataFrame, index: Index, k: int, nprobe: int, by_exact: bool) -> DataFrame:
    """Each task's best k rows of each query, with the index's score (greater is nearer) and the exact one; ``by_exact`` keeps the best by exact scores of those whose codes don't rule them out."""
    probes = index.probes(q, min(len(index.centres) if index.centres is not None else 1, nprobe))
    asked = [np.flatnonzero(x) for x in probes.T]  # the queries of each list
    if index.centres is not None:
        rows = rows.where(F.col("list").isin([k for k, x in enumerate(asked) if len(x)]))
    shared = rows.sparkSession.sparkContext.broadcast((places, q, asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, q, asked = shared.value
        squares = (q**2).sum(1) if index.by_l2 or index.coded else np.zeros(len(q))
        blocks = [(s, Best(s.stop - s.start, k)) for s in query_blocks(len(q), k)]
        tables = index.tables(q) if index.coded and len(q) else []
        for b in batches:
            if not b.num_rows or not len(q):
                continue
            x = matrix(b.column("vector"))
            if x.shape[1] != q.shape[1]:
                raise ValueError(f"dimensions differ: {q.shape[1]} and {x.shape[1]}")
            theirs = pa.table({c: b.column(c) for c in PLACE})
            by_target = pc.sort_indices(theirs, [("transcript_id", "ascending"), ("window_start", "ascending")]).to_numpy().astype(np.int64)
            lists = b.column("list").to_numpy()[by_target] if "list" in b.schema.names else np.zeros(b.num_rows, np.int64)
            parts, x_squares = [(part, by_target[lists == part]) for part in np.unique(lists).tolist()], (x**2).sum(1) if index.by_l2 else np.zeros(len(x))
            coded = {}
            for part, at in parts if index.coded else ():
                codes = np.frombuffer(b"".join(b.column("code").take(pa.array(at)).to_pylist()), index.code_type).reshape(len(at), -1)
                coded[part] = codes, b.column("offset").to_numpy()[at], index.centres[part]

            def exactly(mine: np.ndarray, near: np.ndarray, near_squares: np.ndarray) -> np.ndarray:
                out = q[mine] @ near.T
                if index.by_l2:
                    out *= -2
                    out += squares[mine, None] + near_squares[None, :]
                np.round(out, 12, out=out)
                return np.negative(out, out=out) if index.by_l2 else out

            for s, best in blocks:
                floor, found, held = best.floor(), [], 0

                def kept(s=s, best=best, found=found, x=x, theirs=theirs) -> np.ndarray:
                    if found:
                        query, row, score = (np.concatenate([f[c] for f in found]) for c in range(3))
                        found.clear()
                        exact = exact_scores(q, x, query, row, index.by_l2) if index.coded and not by_exact else -score if index.by_l2 else score  # only what is kept is scored exactly
                        best.add(theirs, query - s.start, row, score, exact)
                    return best.floor()

                for part, at in parts:
                    own = asked[part][np.searchsorted(asked[part], s.start) : np.searchsorted(asked[part], s.stop)]
                    near, near_squares = (x[at], x_squares[at]) if by_exact or not index.coded else (None, None)
                    for j in range(0, len(own), step := max(1, (SCORES if index.coded else WORKED) // len(at))):
                        mine = own[j : j + step]
                        least = floor[mine - s.start, None]
                        if index.coded:  # the centre's part and the tables' entries
                            codes, offset, centre = coded[part]
                            score = table_scores(index, tables, codes, mine).T.astype(np.float64) + (q[mine] @ centre)[:, None]
                            if index.by_l2:
                                score = 2 * score - offset[None, :] - (squares[mine] + centre @ centre)[:, None]
                            if by_exact:
                                likely = score >= least - index.slack
                                score = np.where(likely, exactly(mine, near, near_squares), -np.inf)  # one product costs less than the pairs one by one
                        else:
                            score = exactly(mine, near, near_squares)
                        good = score >= least
                        good &= np.isfinite(score)
                        if np.count_nonzero(good) > k * len(mine):
                            good = best_of(np.where(good, score, -np.inf), k)
                        i, col = np.nonzero(good)
                        found.append((mine[i], at[col], score[i, col]))
                        held += len(i)
                        if held > PAIRS:
                            floor, held = kept(), 0
                kept()
        for s, best in blocks:
            yield from hits_of(places.slice(s.start, s.stop - s.start), best)

    columns = [*PLACE, "vector", *(["list"] if index.centres is not None else []), *(["code", "offset"] if index.coded else [])]
    return rows.select(*columns).mapInArrow(run, HITS)


class Shard:
    """A row of a graph's table, ready to be searched."""

    def __init__(self, rows: pa.RecordBatch, number: int, index: Index):
        row = {c: rows.column(c)[number] for c in rows.schema.names}
        self.places = pa.table({c: row[c].values for c in PLACE})
        n = self.places.num_rows
        self.x = np.frombuffer(row["vectors"].as_buffer(), np.float32).reshape(n, -1)
        self.links = [np.frombuffer(x.as_buffer(), np.int32).reshape(-1, index.links * (1 if k else 2)) for k, x in enumerate(row["links"].values)]
        self.index = index
        if index.codebooks is not None:
            self.codes = np.frombuffer(row["codes"].as_buffer(), index.code_type).reshape(n, -1)
        elif index.low is not None:
            self.codes = np.frombuffer(row["codes"].as_buffer(), np.uint8).reshape(n, -1)

    @functools.cached_property
    def space(self) -> graph.Space:
        return graph.Space(self.x if self.index.low is None else self.index.decoded(self.codes, np.zeros(len(self.x), np.int64)), self.index.by_l2)

    @functools.cached_property
    def offset(self) -> np.ndarray | None:
        return self.index.offsets(self.codes, np.zeros(len(self.x), np.int64)) if self.index.by_l2 else None

    def near(self, q: np.ndarray):
        """How near the shard's rows are by their codes, product codes by the queries' tables."""
        if self.index.codebooks is None:
            return self.space.to(q)
        tables, squares = self.index.tables(q), (q**2).sum(1)

        def score(rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
            out, codes = np.zeros(len(rows), np.float32), self.codes[nodes]
            for k, t in enumerate(tables):
                out += t[codes[:, k], rows]
            return (2 * out - self.offset[nodes] - squares[rows]).astype(np.float32) if self.index.by_l2 else out

        return score

    def exact(self, q: np.ndarray) -> np.ndarray:
        """How near all rows are, exactly."""
        x = self.x.astype(np.float64)
        dots = q @ x.T
        return np.round(2 * dots - (q**2).sum(1)[:, None] - (x**2).sum(1)[None, :] if self.index.by_l2 else dots, 12)

    def scan(self, q: np.ndarray, ef: int) -> graph.Found:
        """The ``ef`` best of all rows by their codes; product codes by the queries' tables."""
        if self.index.codebooks is not None:
            score = table_scores(self.index, self.index.tables(q), self.codes, np.arange(len(q))).T
            score = 2 * score - self.offset[None, :] if self.index.by_l2 else score
        else:
            score = q.astype(np.float32) @ self.space.x.T
            score = 2 * score - self.space.squares[None, :] if self.index.by_l2 else score
        if self.index.by_l2:
            score = score - (q**2).sum(1).astype(np.float32)[:, None]
        nodes = np.argpartition(-score, ef - 1, axis=1)[:, :ef] if ef < len(self.x) else np.broadcast_to(np.arange(len(self.x)), score.shape)
        near = np.take_along_axis(score, nodes, 1)
        order = np.argsort(-near, axis=1, kind="stable")
        return graph.Found(np.take_along_axis(nodes, order, 1), np.take_along_axis(near, order, 1), score.size)

    def search(self, q: np.ndarray, ef: int) -> graph.Found:
        """The beam's nodes of each query; a beam that would compare nearly all rows is replaced by their scores."""
        n = len(self.x)
        if ef * SCANNED >= n:
            step = max(1, SCORES // n)
            parts = [self.scan(q[j : j + step], min(ef, n)) for j in range(0, len(q), step)]
        else:
            parts = [graph.search(self.near(q[s]), self.links, s.stop - s.start, ef) for s in graph.blocks(len(q), n, ef)]
        return graph.Found(np.concatenate([p.nodes for p in parts]), np.concatenate([p.score for p in parts]), sum(p.compared for p in parts))


def scan_exactly(shard: Shard, q: np.ndarray, blocks: list[tuple[slice, Best]], k: int) -> None:
    """Adds the k best of all rows of a shard by exact scores, a block of queries and ``WORKED`` scores at a time; ties in target order."""
    by_target = pc.sort_indices(shard.places, [("transcript_id", "ascending"), ("window_start", "ascending")])
    places, x, by_l2 = shard.places.take(by_target), shard.x[by_target.to_numpy()].astype(np.float64), shard.index.by_l2
    squares = (x**2).sum(1) if by_l2 else None
    for s, best in blocks:
        floor, found, held = best.floor(), [], 0

        def kept(s=s, best=best, found=found) -> np.ndarray:
            if found:
                query, row, score = (np.concatenate([f[c] for f in found]) for c in range(3))
                found.clear()
                best.add(places, query - s.start, row, score, -score if by_l2 else score)
            return best.floor()

        for j in range(s.start, s.stop, step := max(1, WORKED // max(1, len(x)))):
            some = q[j : min(s.stop, j + step)]
            score = some @ x.T
            if by_l2:
                score *= 2
                score -= (some**2).sum(1)[:, None] + squares[None, :]
            np.round(score, 12, out=score)
            good = score >= floor[j - s.start : j - s.start + len(some), None]
            good &= np.isfinite(score)
            if np.count_nonzero(good) > k * len(some):
                good = best_of(np.where(good, score, -np.inf), k)
            query, row = np.nonzero(good)
            found.append((query + j, row, score[query, row]))
            held += len(query)
            if held > PAIRS:
                floor, held = kept(), 0
        kept()


def graph_candidates(places: pa.Table, q: np.ndarray, shards: DataFrame, index: Index, ef: int, k: int, by_exact: bool) -> DataFrame:
    """Each task's best k rows of each query of what beams of ``ef`` find in its shards; shards of no more rows are scanned exactly where exact scores rank."""
    shared = shards.sparkSession.sparkContext.broadcast((places, q))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, q = shared.value
        blocks = [(s, Best(s.stop - s.start, k)) for s in query_blocks(len(q), k)]
        plain = by_exact or not index.coded
        for b in batches:
            for n in range(b.num_rows if len(q) else 0):
                shard = Shard(b, n, index)
                if shard.x.shape[1] != q.shape[1]:
                    raise ValueError(f"dimensions differ: {q.shape[1]} and {shard.x.shape[1]}")
                if plain and ef >= len(shard.x):
                    scan_exactly(shard, q, blocks, k)
                    continue
                wide = min(ef, len(shard.x))
                dense = wide * SCANNED >= len(shard.x)  # then one product costs less than the pairs one by one
                step = max(1, min(PAIRS // wide, SCORES // len(shard.x) if dense else PAIRS))
                x = shard.x.astype(np.float64)
                for s, best in blocks:
                    for j in range(s.start, s.stop, step):
                        some = q[j : min(s.stop, j + step)]
                        found = shard.search(some, ef)
                        query, column = np.nonzero(found.nodes >= 0)
                        row, score = found.nodes[query, column], found.score[query, column].astype(np.float64)
                        exact = shard.exact(some)[query, row] * (-1 if index.by_l2 else 1) if dense else exact_scores(some, x, query, row, index.by_l2)
                        score = (-exact if index.by_l2 else exact) if plain else score
                        good = score >= best.floor()[query + (j - s.start)]
                        best.add(shard.places, (query + (j - s.start))[good], row[good], score[good], exact[good])
        for s, best in blocks:
            yield from hits_of(places.slice(s.start, s.stop - s.start), best)

    return shards.mapInArrow(run, HITS)


def ranked(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each query window with their rank; ties by target."""
    by = Window.partitionBy("query_transcript", "query_window_start").orderBy(F.desc("score"), "target_transcript", "target_window_start")
    return hits.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def similarity(score: Column, by_l2: bool) -> Column:
    """The cosine that an inner product or a squared distance stands for."""
    return cosine_of_distance(score) if by_l2 else clip(score, -1, 1)


def neighbours(queries: DataFrame, database: DataFrame, p: SearchParams, index: Index | None = None) -> DataFrame:
    """The k nearest database windows of each query window: places of both, rank and similarity.

    With an approximate index the rank is that of its own order; if scores are exact anew, only the similarity is,
    but for ``recall``, with which candidates are ranked by exact scores. A database that ``indexed`` or
    ``read_index`` has made needs its index and isn't indexed again.
    """
    known = bool({"list", "links"} & set(database.columns))
    lent = not queries.storageLevel.useMemory
    queries = queries.persist() if lent else queries  # counted, drawn from and held, block by block, all of it here
    if index is None and p.index_type not in ("flat_ip", "flat_l2"):
        database = database.persist()  # learned from, indexed and searched
    index = index or build_index(database, p)
    learns = index.graph and p.recall is not None and not p.ef_search
    if index.graph and not known:
        shards = shards_of(database)
        if learns and not index.candidates_needed and shards > 1 and not walked(queries, graphed(database, index, shards, first=True), index, p):
            index.candidates_needed = WHOLE  # told by one shard, before the others are linked
        rows = graphed(database, index, shards, linked=not (learns and index.candidates_needed == WHOLE)).persist()  # built once, however often it is searched
    else:
        rows = database if known or index.centres is None else indexed(database, index)
    nprobe = p.nprobe or (index.lists_needed if p.recall is not None else 0) or 1
    if learns and not index.candidates_needed:
        index.candidates_needed = beam_needed(queries, rows, index, p)
    ef = max(p.k, p.ef_search or max(2 * p.k, 64, index.candidates_needed if p.recall is not None else 0))
    by_exact = p.recall is not None and index.coded
    size = queries.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("d")).first()
    blocks = max(1, -(-(size["n"] * (size["d"] or 0) * 8) // QUERY_BYTES))
    out = None
    for block in range(blocks):
        part = queries.where(F.pmod(F.xxhash64("transcript_id", "window_start"), F.lit(blocks)) == block) if blocks > 1 else queries
        held = part.select(*PLACE, "vector").orderBy("transcript_id", "window_start").toArrow()
        q = matrix(held.column("vector")) if held.num_rows else np.zeros((0, size["d"] or 0))
        places, some = held.select(list(PLACE)), rows if held.num_rows else rows.limit(0)
        hits = graph_candidates(places, q, some, index, ef, p.k, by_exact) if index.graph else candidates(places, q, some, index, p.k, nprobe, by_exact)
        out = hits if out is None else out.unionByName(hits)
    if lent:
        queries.unpersist()
    shown = F.col("exact") if p.rescored or by_exact or index.kind in ("flat_ip", "flat_l2", "ivf") else (-F.col("score") if index.by_l2 else F.col("score"))
    return ranked(out, p.k).withColumn("similarity", similarity(shown, index.by_l2)).drop("exact")


def rows_scored(queries: DataFrame, database: DataFrame, index: Index, nprobe: int = 1, ef: int = 64) -> DataFrame:
    """One row: pairs that a search scores (in a graph: compares), and those of an exact one."""
    rows = database if {"list", "links"} & set(database.columns) else indexed(database, index)
    q = matrix(queries.select("vector").toArrow().column(0))
    if index.graph:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                held = [Shard(b, n, index) for n in range(b.num_rows)]
                yield pa.RecordBatch.from_arrays([pa.array([x.search(q, ef).compared for x in held], pa.int64()), pa.array([len(x.x) for x in held], pa.int64())], names=["scored", "rows"])

        return rows.mapInArrow(run, "scored long, rows long").agg(F.coalesce(F.sum("scored"), F.lit(0)).alias("scored"), (F.coalesce(F.sum("rows"), F.lit(0)) * len(q)).alias("pairs"))
    asked = index.probes(q, nprobe).sum(0).tolist()
    per = F.get(F.array(*[F.lit(int(x)) for x in asked]), F.col("list"))
    return rows.agg(F.coalesce(F.sum(per), F.lit(0)).cast("long").alias("scored"), (F.count("*") * len(q)).alias("pairs"))


def neighbours_sql(queries: DataFrame, database: DataFrame, k: int) -> DataFrame:
    """The same for inner products, with column expressions only: the score of each pair is a sum of products of columns.

    A vector is a column a component, as the sum is compiled then, which a fold over arrays is not. The k-th best score among drawn rows
    of the database bounds a query's k-th best from below, and pairs below it go where they are scored; so what is sorted of a
    query's pairs grows with the root of the database's rows. Only what is left is rounded, which costs as much as a sum: the bound is lowered by more than rounding adds. Queries are broadcast in blocks of at most ``QUERY_BYTES``. A vector with
    null components scores null, and comes last.
    """
    measured = [F.count("*").alias("n"), F.min(F.size("vector")).alias("least"), F.max(F.size("vector")).alias("most")]
    size, held = queries.agg(*measured).first(), database.agg(*measured).first()
    if len(dimension := {r[c] for r in (size, held) if r["n"] for c in ("least", "most")}) > 1:
        raise ValueError(f"dimensions differ: {' and '.join(map(str, sorted(dimension)))}")
    n, d, by = held["n"], max(dimension, default=0), ["query_transcript", "query_window_start"]

    def side(df: DataFrame, name: str) -> DataFrame:
        parts = [F.coalesce(F.get("vector", F.lit(i)).cast("double"), F.lit(0.0)).alias(f"{name}_{i}") for i in range(d)]  # never null, which is told once a row
        parts.append(F.forall("vector", lambda x: x.isNotNull()).alias(f"{name}_whole"))
        return df.select(*[F.col(c).alias(f"{name}_{c.removeprefix('transcript_') if c != 'transcript_id' else 'transcript'}") for c in PLACE], *parts)

    def total(terms: list[Column]) -> Column:
        return total(terms[: len(terms) // 2]) + total(terms[len(terms) // 2 :]) if len(terms) > 1 else terms[0] if terms else F.lit(0.0)

    raw, whole = total([F.col(f"query_{i}") * F.col(f"target_{i}") for i in range(d)]), F.col("query_whole") & F.col("target_whole")
    score, none = F.when(whole, F.round(raw, 12)), F.lit(float("-inf"))
    columns = [f"{s}_{c}" for s in ("query", "target") for c in ("transcript", "window_index", "window_start", "window_end")]
    blocks, every = max(1, -(-(size["n"] * d * 8) // QUERY_BYTES)), max(1, round(math.sqrt(n / k))) if k else 1
    dealt = database.repartition(database.sparkSession.sparkContext.defaultParallelism * 4, "transcript_id", "window_start")  # a few transcripts may hold all windows
    wide, drawn = (side(x, "target") for x in (dealt, dealt.where(F.pmod(F.xxhash64("transcript_id", "window_start"), F.lit(every)) == 0)))
    out = None
    for block in range(blocks):
        asked = side(queries.where(F.pmod(F.xxhash64("transcript_id", "window_start"), F.lit(blocks)) == block), "query")
        first = ranked(drawn.join(F.broadcast(asked), F.lit(True)).select(*columns, score.alias("score")), k)
        bounds = first.groupBy(*by).agg(F.when(F.count("score") == k, F.min("score")).alias("bound"))  # fewer than k bound nothing
        asked = asked.join(bounds, by, "left").withColumn("bound", F.coalesce(F.when(F.col("bound") == -none, -none).otherwise(F.col("bound") - 1e-12 - F.abs("bound") * 1e-15), none))
        near = wide.join(F.broadcast(asked), (raw >= F.col("bound")) & (whole | (F.col("bound") == none))).select(*columns, score.alias("score"))
        out = near if out is None else out.unionByName(near)
    return ranked(out, k).withColumn("similarity", clip(F.col("score"), -1, 1))
