"""Operator 8, near-dedup by order MinHash, with candidates verified by banded alignment.

A text is its sequence of 5-word shingles, each labelled with how often it occurred before. Each of
``ENTRIES`` hash functions takes the ``SAMPLED`` least of them and keeps them in text order, so an
entry agrees for texts of small edit distance, not just of equal content. Adjacent entries make a
band; texts that agree in one are candidates. Equal texts, told by 128 bits of SHA-256, are one node
throughout: a number that stands for a distinct text.

Documents are read twice: once for digests and sketches, once for the shingles of those nodes that
are candidates at all, which are stored by node and serve all rounds. A candidate is verified by
aligning both shingle sequences inside the band that a similarity of 0.8 leaves; matches over all
shingles of both must reach it. There shingles are told apart by 32 bits: of n and m shingles n m /
2^32 agree by chance, which moves a similarity by less than max(n, m) / 2^32.

Nodes linked so far, directly or not, are a group. The buckets of a few bands come first (``EARLY``): where
they link copies, the others need fewer comparisons. In each bucket of a band the node that shares most
with others leads, is compared with all members of other groups, and leaves, having met all. Passed members
stay and may lead, so failed ones still meet them. A bucket is done when one group is left. Further leaders
follow while these join enough members (``JOINING``). Then a bucket with few pairs between groups (``FEW``)
has all of them compared, and another, a large one of unlike texts, is put aside, passed members and all.
What is put aside meets by rare shingles in the end, and no link is lost: of two texts of the similarity each has
so much of the other's that, in any common order of all labelled shingles, a fifth of either (``least``'s rest, and
one) holds one of the other's fifth. Ordered by how frequent they are, rarest first, unlike texts share few of
those. Their buckets are worked on in the same way, but none is put aside again: all pairs between its groups are compared,
but for those that have too few shingles left behind this one, in the common order, to share enough from it on (``meets``).
Classes are the connected components of the verified links.

Hot keys: rows of a node that holds more than one in ``HEAVY`` of all rows (at most ``HEAVY`` such nodes
can be) learn their class from a broadcast, all others by a join in which no key is that frequent.

Defined cases: a null text, or one without words, is alone in its class; a text of under five words
is one shingle; a very long text is sketched and aligned whole; a null key is never a class id while
its class has another; repeated rows share a class, of which one row is kept; an empty table gives an
empty table of the same columns; other columns may have any names.
"""

from __future__ import annotations

import bisect
import contextlib
import functools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandseek.llm._text import Packed, Shelf, U, chunks, column, fresh, mix, ranges, shared_folder, utf8

SHINGLE, SIMILARITY = 5, 0.8
ENTRIES, SAMPLED = 24, 2
#: Ids that are broadcast at most (60 bytes each); more are joined by a shuffle.
BROADCAST_IDS = 200_000
#: Buckets of n nodes with at most FEW * n / 2 pairs between groups have all of them compared, once leaders join few.
FEW = 16
#: So few edges (16 bytes each) are joined into components by one task; more by rounds of the whole cluster.
TASK_EDGES = 500_000
#: Pairs of a task that verifies.
PAIRS = 4000
#: Leaders join few when fewer than one in so many of the members apart from its leader joined the leader's group.
JOINING = 8
#: After so many rounds all pairs between groups of what is left are compared.
ROUNDS = 2 * ENTRIES
#: Cells that count shingles. They only decide an order: with too few of them rare shingles are told from frequent ones less well.
CELLS = 1 << 20
#: Bands whose buckets are worked on before all others, so that copies are groups when the others' turn comes.
EARLY = 4
#: A node is heavy with more than one in so many of all rows.
HEAVY = 1000
BLOCK = 1 << 19
#: Rows of an Arrow batch.
BATCH = 1000
_seeds = mix(np.arange(1, ENTRIES + 1, dtype=U) * U(0x9E3779B97F4A7C15))


def labelled(shingles: np.ndarray) -> np.ndarray:
    """Shingle hashes joined with the number of earlier occurrences."""
    order = np.argsort(shingles, kind="stable")
    s = shingles[order]
    first = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1])))
    if len(first) == len(s):
        return mix(shingles)  # what the last line gives for first occurrences, as mix(0) is 0
    nth = np.empty(len(s), np.int64)
    nth[order] = np.arange(len(s)) - np.repeat(first, np.diff(np.append(first, len(s))))
    return mix(shingles ^ mix(nth.astype(U)))


def least_places(value: np.ndarray, k: int) -> np.ndarray:
    """The columns of the k least numbers of each row, which it spends."""
    rows, out = np.arange(len(value)), np.empty((len(value), k), np.int64)
    for j in range(k):
        out[:, j] = value.argmin(axis=1)
        value[rows, out[:, j]] = np.iinfo(U).max
    return out


def order_min_hash(shingles: np.ndarray, entries: int = ENTRIES, sampled: int = SAMPLED) -> np.ndarray:
    """One hash an entry: of the sampled labelled shingles, in text order.

    Labels are mixed already, so an odd factor for each entry deals them out anew.
    """
    x = labelled(shingles)
    k = min(sampled, len(x))
    factor = _seeds[:entries, None] | U(1)
    at = np.zeros((entries, 0), np.int64)
    for a in range(0, len(x), 8192):
        at = np.concatenate((at, a + least_places(x[None, a : a + 8192] * factor, min(k, len(x) - a))), axis=1)
    if at.shape[1] > k:
        at = np.take_along_axis(at, least_places(x[at] * factor, k), axis=1)
    at.sort(axis=1)
    out = np.zeros(entries, U)
    for j in range(k):
        out = mix(out * U(3) ^ x[at[:, j]])
    return mix(out ^ _seeds[:entries])


def shingles_of(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The shingle hashes of each text, in order."""
    for a, b in chunks(texts, BLOCK):
        p = Packed(texts[a:b])
        words = p.word_hashes()
        grams = p.window_hashes(words, SHINGLE)
        for i, j in zip(p.first_word[:-1].tolist(), p.first_word[1:].tolist(), strict=True):
            if j - i >= SHINGLE:
                yield grams[i : j - SHINGLE + 1]
            else:
                yield mix(words[i:j] + np.arange(j - i, dtype=U)).sum(keepdims=True) if j > i else np.zeros(0, U)


def occurrence(x: np.ndarray) -> np.ndarray:
    """How often each element occurred before."""
    order = np.argsort(x, kind="stable")
    s = x[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(s)), bool), s[1:] != s[:-1])))
    out = np.empty(len(x), np.int64)
    out[order] = np.arange(len(x)) - np.repeat(first, np.diff(np.append(first, len(x))))
    return out


def labelled_matches(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """The same as ``banded_matches`` if equal elements match only with equal numbers of earlier occurrences; time grows with n log n.

    Each element has one partner at most, so the longest common subsequence is a longest increasing one.
    """
    wide = int(max(a.max(initial=0), b.max(initial=0))) + 1
    x, y = occurrence(a) * wide + a, occurrence(b) * wide + b
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    order = np.argsort(i)
    i, j = i[order], j[order]
    ends: list[int] = []
    for k in j[np.abs(i - j) <= band].tolist():
        at = bisect.bisect_left(ends, k)
        if at == len(ends):
            ends.append(k)
        else:
            ends[at] = k
    return len(ends)


def banded_matches(a: np.ndarray, b: np.ndarray, band: int, need: int = 0) -> int:
    """The longest common subsequence of both within a band about the diagonal, row by row; any less than ``need`` where that can't be reached."""
    n = len(b)
    row = np.zeros(n + 1, np.int32)
    for i, x in enumerate(a):
        low, high = max(0, i - band), min(n, i + band + 1)
        if low >= high:
            continue
        if row[n] + len(a) - i < need:  # rows only grow to the right
            return int(row[n])
        part = np.maximum(row[low + 1 : high + 1], np.where(b[low:high] == x, row[low:high] + 1, 0))
        part = np.maximum.accumulate(np.maximum(part, row[low]))
        row[low + 1 : high + 1] = part
        row[high + 1 :] = np.maximum(row[high + 1 :], part[-1])
    return int(row[-1])


def similar(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether the aligned shingles, over all of both, reach the similarity."""
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < least * max(n, m):
        return False
    values, of = np.unique(np.concatenate((a, b)), return_inverse=True)
    x, y = of[:n], of[n:]
    in_a, in_b = np.bincount(x, minlength=len(values)), np.bincount(y, minlength=len(values))
    most = int(np.minimum(in_a, in_b).sum())
    if most < least * (n + m - most):
        return False  # not even without regard to order
    both_x, both_y = x[in_b[x] > 0], y[in_a[y] > 0]
    if len(both_x) == len(both_y) == most and (both_x == both_y).all():
        return True  # all that is common is in the same order
    need = int(np.ceil(least * (n + m) / (1 + least)))
    band = max(n, m) - need + 1
    enough = lambda got: got >= least * (n + m - got)
    if enough(labelled_matches(x, y, band)):
        return True
    common = (in_a > 0) & (in_b > 0)
    if in_a[common].max() == in_b[common].max() == 1:
        return False  # each has one partner, so that was all
    return enough(banded_matches(x, y, band, need))


def digest(text: Column) -> Column:
    """128 bits that tell a text from all others, null where it has no words."""
    return F.when(text.rlike(r"[^\x20\x09-\x0D]"), F.unhex(F.substring(F.sha2(text, 256), 1, 32)))


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow`` by a worker that gives back what it doesn't use: it stays for other tasks."""

    def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(lean, schema)


def sketches(rows: DataFrame) -> DataFrame:
    """doc_id, digest and sketch of rows (doc_id, digest, text); of equal texts read together only the first gets a sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in ranges(b.column(2), BLOCK):
                keys, marks, texts = (c.slice(i, j - i) for c in b.columns)
                first: dict[bytes, int] = {}
                for k, d in enumerate(marks.to_pylist()):
                    if d is not None:
                        first.setdefault(d, k)
                at = list(first.values())
                made = [order_min_hash(x).view(np.int64) for x in shingles_of(utf8(texts.take(pa.array(at, pa.int64()))))]
                here = np.zeros(j - i, bool)
                here[at] = True
                ends = np.concatenate(([0], np.cumsum(here * ENTRIES))).astype(np.int32)
                flat = pa.array(np.concatenate(made) if made else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays([keys, marks, pa.ListArray.from_arrays(pa.array(ends), flat, mask=pa.array(~here))], names=["doc_id", "digest", "sketch"])

    return mapped(rows, run, "doc_id long, digest binary, sketch array<long>")


def stored_shingles(rows: DataFrame) -> DataFrame:
    """node and shingles (32 bits each, in text order) of rows (node, text), once a node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j in ranges(b.column(1), BLOCK):
                made = [(x >> U(32)).astype(np.uint32).view(np.int32) for x in shingles_of(utf8(b.column(1).slice(i, j - i)))]
                ends = np.concatenate(([0], np.cumsum([len(x) for x in made]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(made)))], names=["node", "shingles"])

    return mapped(rows, run, "node long, shingles array<int>").groupBy("node").agg(F.first("shingles").alias("shingles"))


def verified(pairs: DataFrame, least: float) -> DataFrame:
    """leader, node, ok of pairs with the shingles of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = b.column(2), b.column(3)
            p, q, at, to = (c.to_numpy() for c in (x.values, y.values, x.offsets, y.offsets))
            ok = [similar(p[i:j], q[k:n], least) for i, j, k, n in zip(at[:-1].tolist(), at[1:].tolist(), to[:-1].tolist(), to[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ok, pa.bool_())], names=["leader", "node", "ok"])

    return mapped(pairs.select("leader", "node", "leader_shingles", "node_shingles"), run, "leader long, node long, ok boolean")


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, label of all nodes of a partition's edges: the least node that they connect it with."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([top(x) for x in nodes], pa.int64())], names=["node", "label"])


def components(edges: DataFrame, shelf: Shelf) -> DataFrame:
    """node, label (the least node of its component) of all nodes of edges (a, b).

    Few edges are one task's work. Of many, least labels spread, with jumps, until none moves.
    """
    edges, n = shelf.counted(edges.select("a", "b"))
    if n <= TASK_EDGES:
        return shelf.put(mapped(edges.coalesce(1), forest, "node long, label long"))
    both = shelf.put(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = shelf.put(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label")))
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        step = shelf.put(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("to")))
        jump = labels.select(F.col("node").alias("to"), F.col("label").alias("beyond"))
        moved = shelf.put(step.join(jump, "to").select("node", F.least("to", "beyond").alias("label"), (F.least("to", "beyond") != F.col("label")).alias("moved")))
        labels = moved.select("node", "label")
        if moved.where("moved").isEmpty():
            return labels


def joined(labels: DataFrame | None, edges: DataFrame, shelf: Shelf) -> DataFrame:
    """node, label of all nodes linked so far: the labels before, joined by more edges (a, b)."""
    if labels is None:
        return components(edges, shelf)
    ends = edges.join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left").join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left")
    ends = ends.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).where("a != b").distinct()
    more = components(ends, shelf).select(F.col("node").alias("at"), F.col("label").alias("to"))
    # a label is itself a node of labels, so only nodes without one are new
    new = more.join(labels.select(F.col("node").alias("at")), "at", "left_anti").select(F.col("at").alias("node"), F.col("to").alias("label"))
    out = labels.join(more, F.col("label") == F.col("at"), "left").select("node", F.coalesce("to", "label").alias("label"))
    return shelf.put(out.unionByName(new))


def candidates(nodes: DataFrame, shelf: Shelf) -> tuple[DataFrame, int]:
    """bucket, node, band, fame (how many a node meets in all) of buckets of two or more nodes."""
    pair = lambda i: F.xxhash64(F.lit(i), F.get("sketch", F.lit(i)), F.get("sketch", F.lit((i + 1) % ENTRIES)))
    bands = nodes.select("node", F.posexplode(F.array(*[pair(i) for i in range(ENTRIES)])).alias("band", "bucket"))
    return shared_buckets(bands, shelf)


def shared_buckets(rows: DataFrame, shelf: Shelf) -> tuple[DataFrame, int]:
    """The rows (bucket, node ...) of buckets of two or more nodes, with fame."""
    sizes = shelf.put(rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    fame = F.sum("n").over(Window.partitionBy("node"))  # a node has a row a band, or a rare shingle, at most
    return shelf.counted(rows.join(sizes, "bucket").withColumn("fame", fame).drop("n"))


def cells_of(shingles: np.ndarray) -> np.ndarray:
    return (mix(shingles) % U(CELLS)).astype(np.int64)


def rarest(shingles: np.ndarray, counts: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The labelled shingles by which a text meets all that are similar to it, but for those that no other has, and their places in the common order.

    A text of n shingles shares ``least`` times n with each of them, so in an order of all labelled shingles one of those
    is among its first n less so many, and one.
    """
    x, seen = labelled(shingles), counts[cells_of(shingles)]
    need = int(np.ceil(least * len(x) - 1e-9))
    first = np.lexsort((x, seen))[: len(x) - need + 1]
    at = np.flatnonzero(seen[first] > 1)
    return x[first[at]], at


def parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Nodes and their shingles of batches (node, shingles), about ``BLOCK`` bytes of these at a time, however many a batch holds."""
    for b in batches:
        each = np.split(b.column(1).flatten().to_numpy().view(np.uint32), np.cumsum(b.column(1).value_lengths().to_numpy())[:-1]) if b.num_rows else []
        for i, j in chunks(each, BLOCK // 4):
            yield b.column(0).slice(i, j - i).to_numpy(), [x.astype(U) for x in each[i:j]]


def rare_buckets(nodes: DataFrame, store: DataFrame, least: float, shelf: Shelf) -> tuple[DataFrame, int]:
    """bucket, node, size, at, fame of nodes (node) by their rare shingles: all pairs of the similarity share a bucket in which they meet."""
    held = shelf.put(store.join(nodes.distinct(), "node", "left_semi"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, each in parts(batches):
            cell, n = np.unique(cells_of(np.concatenate(each)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(n, pa.int64())], names=["cell", "n"])

    found = mapped(held.select("node", "shingles"), counted, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # a row a cell
    counts = np.zeros(CELLS, np.int64)
    counts[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    shared = held.sparkSession.sparkContext.broadcast(counts)

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, each in parts(batches):
            rare = [rarest(x, shared.value, least) for x in each]
            n = [len(x) for x, _ in rare]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([x for x, _ in rare]).view(np.int64)), pa.array(np.repeat(keys, n), pa.int64()),
                    pa.array(np.repeat([len(x) for x in each], n), pa.int32()), pa.array(np.concatenate([at for _, at in rare]), pa.int32()),
                ],
                names=["bucket", "node", "size", "at"],
            )

    return shared_buckets(shelf.put(mapped(held.select("node", "shingles"), met, "bucket long, node long, size int, at int")), shelf)


def meets(size: Column, at: Column, other_size: Column, other_at: Column, least: float) -> Column:
    """Whether two texts can be similar if what their bucket stands for is the first that both have, in the common order.

    They do share a bucket of which that is so. Buckets of bands, of size and place 0, exclude none.
    """
    return 1 + F.least(size - 1 - at, other_size - 1 - other_at) >= least / (1 + least) * (size + other_size) - 1e-6


def leaders(members: DataFrame, last: bool, rare: bool, shelf: Shelf) -> tuple[DataFrame, int]:
    """Of each bucket with several groups: its size, whether all its pairs are to be compared, its largest group, its leader and that one's group."""
    sizes = members.groupBy("bucket", "group").agg(F.count("*").alias("n"), F.max(F.struct("fame", "node", "group", "size", "at")).alias("lead"), F.max("slow").alias("slow"))
    lead = sizes.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("within"), F.max(F.struct("n", "group")).alias("most"), F.max("lead").alias("lead"), F.max("slow").alias("slow")).where("most.n < n")
    few = F.lit(True) if last else F.col("slow") & (F.lit(rare) | (F.col("n") * F.col("n") - F.col("within") <= FEW * F.col("n")))
    return shelf.counted(lead.select("bucket", few.alias("few"), F.col("most.group").alias("most"), F.col("lead.node").alias("leader"), F.col("lead.group").alias("led"), F.col("lead.size").alias("lead_size"), F.col("lead.at").alias("lead_at")))


def to_compare(members: DataFrame, tried: DataFrame | None, least: float, shelf: Shelf) -> tuple[DataFrame, int]:
    """The pairs (leader, node) of a round, each tried once, whichever leads."""
    can = meets(*(F.col(c) for c in ("size", "at", "lead_size", "lead_at")), least)
    pairs = members.where(~F.col("few") & (F.col("group") != F.col("led")) & can).select("leader", "node")
    some = members.where("few")
    other = some.where(F.col("group") != F.col("most")).select("bucket", *[F.col(c).alias(n) for c, n in (("node", "leader"), ("group", "led"), ("size", "lead_size"), ("at", "lead_at"))])
    if tried is not None:
        pairs = pairs.unionByName(some.select("bucket", "node", "group", "size", "at").join(other, "bucket").where((F.col("group") != F.col("led")) & can).select("leader", "node"))
    pairs = pairs.select(F.greatest("leader", "node").alias("leader"), F.least("leader", "node").alias("node")).distinct()
    return shelf.counted(pairs if tried is None else pairs.join(tried, ["leader", "node"], "left_anti"))


def linked(pairs: DataFrame, n: int, store: DataFrame, least: float, shelf: Shelf) -> tuple[DataFrame, int]:
    """Those of the pairs that are similar, as links (a, b)."""
    asked = pairs.select("node").unionByName(pairs.select(F.col("leader").alias("node"))).distinct()
    held = store.join(F.broadcast(asked) if 2 * n <= BROADCAST_IDS else asked, "node", "left_semi")
    full = pairs.join(held.withColumnRenamed("shingles", "node_shingles"), "node").join(held.select(F.col("node").alias("leader"), F.col("shingles").alias("leader_shingles")), "leader")
    tasks = n // PAIRS + 1
    full = full.coalesce(tasks)  # before Python, so that a task starts it once, not once for each of the joins' partitions
    return shelf.counted(verified(full, least).where("ok").select(F.col("leader").alias("a"), F.col("node").alias("b")), tasks)


def regrouped(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members with the groups that nodes have come into meanwhile."""
    return members if labels is None else members.drop("group").join(labels, "node", "left").withColumn("group", F.coalesce("label", "node")).drop("label")


def links(rows: DataFrame, nodes: DataFrame, shelf: Shelf, least: float = SIMILARITY) -> DataFrame:
    """Verified links (a, b) between nodes (node, digest, least, sketch) of rows (doc_id, digest, text); each is between two members of a bucket."""
    members, n_members = candidates(nodes, shelf)
    wanted, n = shelf.counted(nodes.join(members.select("node").distinct(), "node", "left_semi").select("node", F.col("digest").alias("of"), "least"))
    same = (rows["digest"] == F.col("of")) & rows["doc_id"].eqNullSafe(F.col("least"))
    store = shelf.put(stored_shingles(rows.join(F.broadcast(wanted) if n <= BROADCAST_IDS else wanted, same).select("node", "text")))
    members = members.withColumns({"group": F.col("node"), "slow": F.lit(False), "size": F.lit(0), "at": F.lit(0)})
    shelf.most = n_members  # which never grow
    edges, tried, labels, turn, aside, rare = None, None, None, 0, [], False
    members, waiting = (members.where(some).drop("band") for some in (F.col("band") < EARLY, F.col("band") >= EARLY))
    while True:
        turn += 1
        lead, live = leaders(members, turn > ROUNDS, rare, shelf)
        if not live and waiting is not None:
            members, waiting = shelf.put(regrouped(waiting, labels)), None
            continue
        if not live and aside:
            met, shelf.most = functools.reduce(DataFrame.unionByName, aside), None
            members, shelf.most = rare_buckets(met, store, least, shelf)
            members, aside, rare, turn = shelf.put(regrouped(members.withColumn("group", F.col("node")), labels).withColumn("slow", F.lit(False))), [], True, 0
            continue
        if not live:
            break
        members = shelf.put(members.drop("slow").join(lead, "bucket"))
        pairs, n = to_compare(members, tried, least, shelf)
        members = members.where(~F.col("few")).drop("few", "most", "lead_size", "lead_at").withColumn("now", F.col("group"))
        if n:
            tried = pairs if tried is None else tried.unionByName(pairs)
            good, n = linked(pairs, n, store, least, shelf)
        if n:
            edges = good if edges is None else edges.unionByName(good)
            labels = joined(labels, good, shelf)
            members = members.join(labels, "node", "left").withColumn("now", F.coalesce("label", "node")).drop("label")
        # how many of each bucket met its leader in this round, and how many are still apart from it
        met = members.groupBy("bucket", "now").agg(F.count("*").alias("n"), F.count_if(F.col("group") != F.col("led")).alias("met"), F.max(F.col("node") == F.col("leader")).alias("leads"))
        met = met.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("met").alias("met"), F.sum(F.when(~F.col("leads"), F.col("n")).otherwise(0)).alias("apart")).where("apart > 0")
        still = met.select("bucket", "n", ((F.col("met") - F.col("apart")) * JOINING < F.col("met")).alias("slow"))
        still = shelf.put(still.select("bucket", "slow", (F.col("slow") & (F.col("n") > FEW) & F.lit(not rare)).alias("large")))
        rest = members.where(F.col("leader") != F.col("node")).select("bucket", "node", "fame", "size", "at", F.col("now").alias("group")).join(still, "bucket")
        if not rare:
            large, n = shelf.counted(rest.where("large").select("node").distinct())
            aside += [large] if n else []
        rest = rest.where("NOT large").drop("large")
        members, waiting = shelf.put(rest if waiting is None else rest.unionByName(regrouped(waiting, labels))), None
    return edges if edges is not None else rows.sparkSession.createDataFrame([], "a long, b long")


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Meanwhile an Arrow batch has ``BATCH`` rows at most: executors and workers hold several copies of each."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= BATCH:
        spark.conf.set(name, BATCH)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def named(docs: DataFrame, key: str, text: str, least: float) -> DataFrame:
    """doc_id, digest, class (null: alone), n_links and best (the least key of the class) of every row."""
    shelf = Shelf(docs.sparkSession, "near-dup")
    try:
        with small_batches(docs.sparkSession):
            return named_on(shelf, docs, key, text, least)  # checkpointed, so all that runs Python has run
    finally:
        shelf.clear()


def named_on(shelf: Shelf, docs: DataFrame, key: str, text: str, least: float) -> DataFrame:
    spark = docs.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark) + "/checkpoints")
    rows = docs.select(column(key).cast("long").alias("doc_id"), column(text).cast("string").alias("text")).withColumn("digest", digest(F.col("text"))).select("doc_id", "digest", "text")
    base, total = shelf.counted(sketches(rows))
    nodes = base.where(F.col("digest").isNotNull()).groupBy("digest").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"), F.first("sketch", ignorenulls=True).alias("sketch"))
    nodes, n_nodes = shelf.counted(nodes.withColumn("node", F.monotonically_increasing_id()))
    edges = links(rows, nodes, shelf, least)
    shelf.most = n_nodes
    edges = shelf.put(edges)
    ends = shelf.put(edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("n_links")))
    labels = shelf.put(components(edges, shelf).join(ends, "node"))
    every = nodes.select("node", "digest", "n", "least").join(labels, "node", "left").where(F.col("label").isNotNull() | (F.col("n") > 1))
    every = shelf.put(every.withColumn("class", F.coalesce("label", "node")).drop("node", "label"))
    best = shelf.put(every.groupBy("class").agg(F.min("least").alias("best")))
    known = shelf.put(every.join(best, "class").select("digest", "n", "class", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), "best"))
    base = base.select("doc_id", "digest")
    heavy = F.broadcast(known.where(F.col("n") * HEAVY > total).drop("n"))
    light = known.where(F.col("n") * HEAVY <= total).drop("n")
    with_words = base.where(F.col("digest").isNotNull())
    alone = base.where(F.col("digest").isNull()).select("doc_id", "digest", *[F.lit(None).cast("long").alias(c) for c in ("class", "n_links", "best")])
    rest = with_words.join(heavy.select("digest"), "digest", "left_anti").join(light, "digest", "left")
    out = with_words.join(heavy, "digest").unionByName(rest).unionByName(alone)
    return out.withColumn("n_links", F.coalesce("n_links", F.lit(0).cast("long"))).coalesce(total // shelf.ROWS + 1).checkpoint()


def stays() -> Column:
    return F.col("class").isNull() | F.col("doc_id").eqNullSafe(F.col("best"))


def near_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (the least key of the class), n_links (verified, of its text to different texts), kept of every row."""
    rows = named(docs, key, text, least)
    return rows.select("doc_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("best")).alias("class_id"), "n_links", stays().alias("kept"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The rows of docs, with all columns, but only the row of the least key of each class."""
    rows = named(docs, key, text, least)
    its_key, its_digest, its_class = fresh(docs, names=("its_key", "its_digest", "its_class"))
    mine = digest(column(text).cast("string"))
    gone = rows.where(~stays()).select(F.col("doc_id").alias(its_key), F.col("digest").alias(its_digest)).distinct().checkpoint()
    out = docs.join(gone.hint("shuffle_hash"), (mine == F.col(its_digest)) & column(key).cast("long").eqNullSafe(F.col(its_key)), "left_anti")
    again = rows.where(stays() & F.col("class").isNotNull()).groupBy("class").agg(F.count("*").alias("n")).where("n > 1")
    if again.isEmpty():
        return out
    # rows of one key in one class: rare, so only they are dealt with anew
    kept = rows.where(stays()).join(again.select("class"), "class", "left_semi").select(F.col("digest").alias(its_digest), F.col("class").alias(its_class)).distinct().checkpoint()
    some = out.join(kept.select(its_digest), mine == F.col(its_digest), "left_semi")
    one = some.withColumn(its_digest, mine).join(kept, its_digest).dropDuplicates([its_class]).select(*[column(c) for c in docs.columns])
    return out.join(kept.select(its_digest), mine == F.col(its_digest), "left_anti").unionByName(one)
