"""Substring, suffix and near-dedup against brute force on small corpora."""

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa

from strandseek.llm import near_dup, substring, suffixes
from strandseek.llm._text import Shelf

SCHEMA = "doc_id long, text string, class string, n_words long"


def frame(spark, rows):
    return spark.createDataFrame([(k, t, "c", 7) for k, t in rows], SCHEMA)


def corpus(seed, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["é", "日本"]
    stock = [[rng.choice(words) for _ in range(60)] for _ in range(4)]
    rows = [(None, None), (None, " ".join(stock[0])), (1, ""), (2, " \n\t "), (3, "same " * 80)]
    for i in range(4, n):
        text = []
        for _ in range(rng.randrange(1, 4)):
            s, a = rng.choice(stock), rng.randrange(40)
            text += s[a : a + rng.randrange(1, 60)] + [rng.choice(words) for _ in range(rng.randrange(12))]
        rows.append((i, rng.choice([" ", "\n", "  "]).join(text)))
    return [*rows, rows[10], (10, "other text of the same key " + " ".join(stock[1]))]


def brute_substring(rows, n=13):
    docs = [(k, (t or "").encode().split()) for k, t in rows]
    rank = lambda k: float("inf") if k is None else k
    least = {}
    for k, w in docs:
        for i in range(len(w) - n + 1):
            g = tuple(w[i : i + n])
            least[g] = min(least.get(g, float("inf")), rank(k))
    out = []
    for k, w in docs:
        gone = {j for i in range(len(w) - n + 1) if least[tuple(w[i : i + n])] < rank(k) for j in range(i, i + n)}
        out.append((k, len(w), len(gone), hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest()))
    return sorted(out, key=str)


def test_substring(spark, monkeypatch):
    monkeypatch.setattr(substring, "CELLS", 1 << 10)
    monkeypatch.setattr(substring, "EXACT_BLOCK", 200)
    monkeypatch.setattr(substring, "grouped", lambda d, k, t, f=substring.grouped: f(d, k, t, 3000))
    for seed in (1, 2):
        rows = corpus(seed)
        got = substring.dedup(frame(spark, rows)).drop("kept").collect()
        assert sorted(map(tuple, got), key=str) == brute_substring(rows)
    assert substring.dedup(frame(spark, rows).limit(0)).count() == 0


def test_substring_short_sketch(spark, monkeypatch):
    """A sketch that overestimates everything costs time, not results."""
    monkeypatch.setattr(substring, "CELLS", 4)
    rows = corpus(3, 20)
    got = substring.dedup(frame(spark, rows), window=4).drop("kept").collect()
    assert sorted(map(tuple, got), key=str) == brute_substring(rows, 4)


def brute_suffix(rows, n):
    data = [(k, (t or "").encode()) for k, t in rows]
    count = collections.Counter(b[i : i + n] for _, b in data for i in range(len(b) - n + 1))
    out = []
    for k, b in data:
        gone = [False] * len(b)
        for i in range(len(b) - n + 1):
            if count[b[i : i + n]] > 1:
                gone[i : i + n] = [True] * n
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((k, len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return sorted(out, key=str)


def test_suffixes(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 1500)
    rows = [*corpus(4, 30), (900, "a" * 700), (901, "b" * 70)]
    for n in (64, 150):
        got = suffixes.dedup(frame(spark, rows), length=n, group_bytes=4000).drop("kept").collect()
        assert sorted(map(tuple, got), key=str) == brute_suffix(rows, n)
    assert suffixes.dedup(frame(spark, rows).limit(0)).count() == 0


def places_of(texts, n):
    block = suffixes.Block([x.encode() for x in texts], n)
    return block, block.start


def test_sorted_suffixes(monkeypatch):
    """The mergesort gives the order of the strings, and the classes hang on it: wrong comparisons lose them."""
    rng = random.Random(9)
    stem = "".join(rng.choice("abc") for _ in range(90))
    texts = [stem + "".join(rng.choice("xy") for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    block, places = places_of(texts, 64)
    order = block.sort(places, 64, (whole := np.zeros(len(block.buf), np.uint64)))
    assert sorted(order) == sorted(places)
    whole[places] = block.raw(places, 64)
    strings = [block.data[p : p + 64] for p in block.sort(places, 64, whole)]
    assert strings == sorted(strings)
    at, n, of = block.classes(places, 64)
    count = collections.Counter(block.data[p : p + 64] for p in places)
    assert {block.data[p : p + 64]: k for p, k in zip(at.tolist(), n.tolist(), strict=True)} == count and len(of) == len(places)
    monkeypatch.setattr(suffixes.Block, "before", lambda self, p, q, limit, whole, ties: np.zeros(len(p), bool) | ties)
    assert len(block.classes(places, 64)[0]) > len(count)


def test_equal_hashes_are_not_enough(monkeypatch):
    """Of neighbours whose hashes agree only those of equal bytes share a class."""
    block, places = places_of(["a" * 80, "b" * 80, "a" * 80], 64)
    monkeypatch.setattr(suffixes.Block, "raw", lambda self, at, size, lane=0: np.zeros(len(at), np.uint64))
    at, n, _ = block.classes(places, 64)
    assert {block.data[p : p + 64] for p in at.tolist()} == {b"a" * 64, b"b" * 64} and n.sum() == len(places)


def near_corpus(seed):
    rng = random.Random(seed)
    new = lambda n: [f"t{rng.randrange(5000)}" for _ in range(n)]
    rows, k = [], 0
    for _ in range(8):
        base = new(rng.randrange(150, 400))
        for _ in range(rng.randrange(1, 7)):
            copy = list(base)
            for _ in range(rng.randrange(0, max(1, len(base) // 60))):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(999)}"
            rows.append((k, " ".join(copy)))
            k += 1
        for share in (2, 3):  # unlike texts with a common part
            rows.append((k, " ".join(base[: len(base) // share] + new(200))))
            k += 1
    shared = new(60)
    rows += [(k + i, " ".join(shared + new(90))) for i in range(30)]
    return [*rows, (None, None), (1000, ""), (1001, " \n"), (1002, "one two"), (1003, "one two"), (None, rows[0][1]), rows[3]]


def shingles(text):
    w = (text or "").encode().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_near_dup(spark):
    rows = near_corpus(5)
    docs = frame(spark, rows)
    got = near_dup.near_classes(docs).collect()
    by_text = collections.defaultdict(set)
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 1000:
            by_text[r["class_id"]].add(r["doc_id"])
    parent = {k: k for k, _ in rows if k is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(k, shingles(t)) for k, t in rows if k is not None]
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and len(x & y) >= 0.8 * len(x | y):
                a_, b_ = find(a), find(b)
                parent[max(a_, b_)] = min(a_, b_)
    for r in got:
        if r["doc_id"] is not None:
            assert r["class_id"] == find(r["doc_id"])
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert ids == sorted({find(k) for k in parent})
    assert near_dup.near_classes(docs.limit(0)).count() == 0


def test_labels_of_repeats():
    """A near copy of which only one side repeats a phrase shares labels and entries with the other."""
    rng = random.Random(1)
    words = [f"t{rng.randrange(5000)}" for _ in range(300)]
    a, b = near_dup.shingles_of([" ".join(words).encode(), " ".join(words + words[:7]).encode()])
    assert near_dup.similar(a, b)
    assert set(near_dup.labelled(a).tolist()) <= set(near_dup.labelled(b).tolist())
    assert (near_dup.order_min_hash(a) == near_dup.order_min_hash(b)).sum() >= 12


def star(seed, n, changes=4):
    """An original of 200 words and its copies with up to so many changed words: one class, through the original."""
    rng = random.Random(seed)
    base = [f"t{rng.randrange(10**6)}" for _ in range(200)]
    rows = [(n, " ".join(base))]
    for k in range(n):
        copy = list(base)
        for i in rng.sample(range(200), rng.randrange(changes + 1)):
            copy[i] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy)))
    return rows


def test_near_dup_star(spark):
    """Failed members meet passed ones: no link is lost because a leader that isn't the original took its copies."""
    rows = star(1, 1000)
    sets = {k: shingles(t) for k, t in rows}
    assert all(len(sets[k] & sets[1000]) >= 0.8 * len(sets[k] | sets[1000]) for k in range(1000))
    assert {r["class_id"] for r in near_dup.near_classes(frame(spark, rows)).collect()} == {0}


def test_components(spark, monkeypatch):
    """The components that one task finds are those of the cluster's rounds."""
    edges = spark.createDataFrame([(5, 9), (9, 2), (2, 5), (-3, 7), (11, 12), (12, 13), (13, 14)], "a long, b long")
    shelf = Shelf(spark, "test")
    few = sorted(near_dup.components(edges, shelf).collect())
    monkeypatch.setattr(near_dup, "TASK_EDGES", 0)
    assert few == sorted(near_dup.components(edges, shelf).collect())
    assert dict(few) == {2: 2, 5: 2, 9: 2, -3: -3, 7: -3, 11: 11, 12: 11, 13: 11, 14: 11}


def test_alignment():
    a = np.arange(100, dtype=np.uint64)
    assert near_dup.similar(a, a) and not near_dup.similar(a, a[::-1].copy())
    assert near_dup.similar(a, np.delete(a, [3, 50])) and not near_dup.similar(a, a[:70])
    rng = np.random.default_rng(2)
    for _ in range(50):
        x, y = rng.integers(0, 6, rng.integers(1, 30)), rng.integers(0, 6, rng.integers(1, 30))
        table = np.zeros((len(x) + 1, len(y) + 1), int)
        for i, p in enumerate(x):
            for j, q in enumerate(y):
                table[i + 1, j + 1] = table[i, j] + 1 if p == q else max(table[i, j + 1], table[i + 1, j])
        assert near_dup.banded_matches(x, y, 40) == table[-1, -1]


def test_no_link_is_split(spark):
    """Two near copies in a bucket of many unlike texts, whose sketches agree in that bucket alone, are linked."""
    rng = random.Random(4)
    new = lambda n: [f"t{rng.randrange(10**6)}" for _ in range(n)]
    common, base = new(40), new(160)
    rows = [(k, " ".join(common + new(160))) for k in range(2, 60)]
    rows += [(k, " ".join([*common, *base[:100], *new(1), *base[101:]])) for k in range(2)]
    rows += [(60, "same " * 60 + " ".join(base[:40])), (61, "same " * 66 + " ".join(base[:40]))]  # repeats count
    docs = spark.createDataFrame([(k, k.to_bytes(16, "big"), t) for k, t in rows], "doc_id long, digest binary, text string")
    nodes = spark.createDataFrame([(k, k.to_bytes(16, "big"), k, [1, 1, *(rng.randrange(2**60) for _ in range(near_dup.ENTRIES - 2))]) for k, _ in rows], "node long, digest binary, least long, sketch array<long>")
    shelf = Shelf(spark, "test")
    assert {frozenset(e) for e in near_dup.links(docs, nodes, shelf).collect()} == {frozenset((0, 1)), frozenset((60, 61))}
    shelf.clear()


def test_rare_shingles():
    """Texts of the similarity share one of their rare shingles, however these are counted."""
    rng = np.random.default_rng(6)
    for _ in range(300):
        n = int(rng.integers(1, 80))
        x = rng.integers(0, 50, n).astype(np.uint64)
        y = np.delete(x, rng.choice(n, int(rng.integers(0, n // 5 + 1)), replace=False))
        counts = rng.integers(2, 9, near_dup.CELLS)
        if near_dup.similar(x, y):
            (p, i), (q, j) = near_dup.rarest(x, counts, 0.8), near_dup.rarest(y, counts, 0.8)
            both = set(p.tolist()) & set(q.tolist())
            assert both
            a, b = min(i[p.tolist().index(v)] for v in both), min(j[q.tolist().index(v)] for v in both)
            assert 1 + min(len(x) - 1 - a, len(y) - 1 - b) >= 0.8 / 1.8 * (len(x) + len(y)) - 1e-6  # what ``meets`` asks for


def test_linked_starts_python_once_a_task(spark, monkeypatch):
    """A few pairs of many partitions are verified in one run of Python, not in one for each partition."""
    shelf, seen = Shelf(spark, "test"), []
    store = shelf.put(spark.createDataFrame([(k, [1, 2, 3, 4, k // 2]) for k in range(40)], "node long, shingles array<int>"))
    pairs = spark.createDataFrame([(k, k - 1) for k in range(1, 40)], "leader long, node long").repartition(13)
    whole = near_dup.verified
    monkeypatch.setattr(near_dup, "verified", lambda full, least: seen.append(full.rdd.getNumPartitions()) or whole(full, least))
    good, n = near_dup.linked(pairs, 39, store, 0.8, shelf)
    assert seen == [1]
    assert n == 20 and {(r["a"], r["b"]) for r in good.collect()} == {(k, k - 1) for k in range(1, 40, 2)}
    shelf.clear()


def test_parts(monkeypatch):
    """Shingles of a large batch are widened part by part; one text's stay together."""
    monkeypatch.setattr(near_dup, "BLOCK", 400)
    each = [np.arange(n, dtype=np.int32) - 5 for n in (30, 0, 60, 250, 1, 99, 40)]
    batch = pa.RecordBatch.from_pydict({"node": pa.array(range(7)), "shingles": pa.array(each, pa.list_(pa.int32()))})
    got = list(near_dup.parts([batch.slice(0, 0), batch.slice(0, 2), batch.slice(2)]))
    assert all(sum(map(len, x)) <= 100 or len(x) == 1 for _, x in got)
    assert [k for keys, _ in got for k in keys.tolist()] == list(range(7))
    assert [x.astype(np.uint32).view(np.int32).tolist() for _, xs in got for x in xs] == [x.tolist() for x in each]


def test_small_batches(spark, monkeypatch):
    """Python gets batches of bounded rows, and the session's own size holds again afterwards."""
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before, whole = spark.conf.get(name), near_dup.sketches
    sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches)
    monkeypatch.setattr(near_dup, "sketches", lambda rows: seen.extend(r["n"] for r in rows.coalesce(1).mapInArrow(sizes, "n long").collect()) or whole(rows))
    near_dup.near_classes(frame(spark, [(k, f"text {k}") for k in range(2500)]))
    assert sum(seen) == 2500 and max(seen) <= near_dup.BATCH
    assert spark.conf.get(name) == before
