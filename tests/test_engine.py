"""Operators on small hand-checked tables, and whole searches on planted similarities."""

import math
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandseek import queries as engine
from strandseek.functions import scores, vectors
from strandseek.operators import alignment, cluster, graph, knn, places, plots, report, stats, windows
from strandseek.operators import index as index_ops
from strandseek.operators import seeds as seed_ops
from strandseek.params import SearchParams, smoke
from strandseek.plans.search import diagnose, search
from strandseek.schema import NODES
from strandseek.sources import sinks, tables


def nodes_frame(spark, sequences):
    return spark.createDataFrame([(name, i, [float(v) for v in x]) for name, rows in sequences.items() for i, x in enumerate(rows)], NODES)


@pytest.mark.parametrize(("length", "size", "stride", "starts"), [(12, 11, 1, [0, 1]), (30, 11, 5, [0, 5, 10, 15]), (11, 11, 3, [0]), (10, 11, 1, [])])
def test_window_starts(spark, length, size, stride, starts):
    n = nodes_frame(spark, {"a": np.ones((length, 2))})
    rows = windows.windows(n, size, stride).orderBy("window_start").collect()
    assert [r["window_start"] for r in rows] == starts
    assert [r["window_index"] for r in rows] == list(range(len(starts)))
    assert all(r["transcript_length"] == length and len(r["vector"]) == 2 * size for r in rows)


def test_window_vectors(spark):
    n = nodes_frame(spark, {"a": [[0, 0], [0, 0], [3, 4]]})
    rows = {r["window_start"]: r["vector"] for r in windows.windows(n, 2).collect()}
    assert rows[0] == [0, 0, 0, 0] and rows[1] == pytest.approx([0, 0, 0.6, 0.8])


@pytest.mark.parametrize(("structure", "most", "kept"), [("((..", 0.5, False), ("((..", 0.51, True), (None, 0.1, True), ("", 0.1, True), ("...", 0.1, True)])
def test_unpaired(spark, structure, most, kept):
    n = nodes_frame(spark, {"a": np.ones((4, 1))})
    meta = spark.createDataFrame([("a", structure)], "transcript_id string, secondary_structure string")
    assert windows.windows(n, 4, meta=meta, max_unpaired=most).count() == int(kept)


def seed_rows(spark, pairs):
    rows = [("q", "t", q, q + 3, t, t + 3, q, t, 0.9, 1, t - q) for q, t in pairs]
    return spark.createDataFrame(rows, "query_transcript string, target_transcript string, query_window_start int, query_window_end int, target_window_start int, target_window_end int, query_window_index int, target_window_index int, similarity double, rank int, diagonal int")


def test_fold(spark):
    m = cluster.members(seed_rows(spark, [(0, 100), (5, 104), (10, 130), (15, 134), (200, 400)]), SearchParams())
    got = cluster.clusters(m).orderBy("cluster_id").collect()
    assert [(r["cluster_id"], r["seed_count"], r["diagonal"], r["diagonal_span"]) for r in got] == [(0, 2, 99, 1), (1, 2, 119, 1)]
    down = cluster.clusters(cluster.members(seed_rows(spark, [(200, 100), (201, 102)]), SearchParams())).first()
    assert down["diagonal"] == -99
    assert cluster.fold([0, 1], [0, 50], 80, 60, 0) == [0, 0]
    assert cluster.fold([0, 1], [0, 50], 80, 60, 40) == [0, 1]


def test_band_and_scores(spark):
    r = spark.range(1).select(
        *[scores.adaptive_band(F.lit(s), cap=c).alias(f"b{s}_{c}") for s, c in ((5, 0), (65, 0), (80, 0), (80, 100))],
        scores.bit_score(F.lit(150.0), F.lit(0.00556), F.lit(0.5144)).alias("bits"),
        scores.e_value(F.lit(150.0), F.lit(0.00556), F.lit(0.5144), F.lit(100000), F.lit(500)).alias("e"),
        scores.e_value(F.lit(200.0), F.lit(0.1), F.lit(0.01), F.lit(120), F.lit(80)).alias("e2"),
        scores.e_value(F.lit(200.0), F.lit(0.0), F.lit(0.01), F.lit(120), F.lit(80)).alias("e3"),
        vectors.cosine_of_distance(F.lit(5.0)).alias("c"),
    ).first()
    assert (r["b5_0"], r["b65_0"], r["b80_0"], r["b80_100"]) == (96, 98, 112, 100)
    assert r["bits"] == pytest.approx(2.162245, abs=1e-6) and r["e"] == pytest.approx(11170416.4956, rel=1e-6)
    assert r["e2"] == pytest.approx(1.978707e-7, rel=1e-6) and math.isinf(r["e3"]) and r["c"] == -1


@pytest.mark.parametrize(("n", "kept"), [(2, [9, 7]), (0, []), (-1, [9, 7, 5]), (-4, [])])
def test_top_n(spark, n, kept):
    df = spark.createDataFrame([("q", f"t{s}", 0, float(s)) for s in (9, 7, 5, 3)], "query_id string, target_id string, cluster_id int, score double")
    assert sorted((r["score"] for r in alignment.top_n(df, n).collect()), reverse=True) == kept


def test_gumbel():
    rng = np.random.default_rng(1)
    at, scale = stats.fit_gumbel(rng.gumbel(30, 7, 20000))
    assert at == pytest.approx(30, abs=0.3) and scale == pytest.approx(7, abs=0.2)


def planted(spark):
    rng = np.random.default_rng(11)
    unit = lambda n: (lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(rng.normal(size=(n, 16)))
    s = {f"s{k}": unit(60) for k in range(6)}
    s["s1"][10:35] = s["s0"][20:45]
    s["s2"][10:32] = np.delete(s["s0"][20:45], [12, 13, 14], axis=0)
    return nodes_frame(spark, s), s


@pytest.mark.parametrize("kind", ["flat_ip", "flat_l2", "ivf"])
def test_planted_search(spark, kind):
    n, _ = planted(spark)
    p = SearchParams(window_size=5, k=10, threshold=0.6, index_type=kind, nlist=4, nprobe=4, evd_samples=20, background_samples=500, gamma=3.0, top_n=5)
    out = search(n, spark.createDataFrame([("s0",)], "id string"), p)
    got = {r["target_id"]: r for r in out.alignments.collect()}
    assert {"s1", "s2"} <= set(got)
    best = got["s1"]
    trace = {(x["query_pos"], x["target_pos"]) for x in best["trace"] if x["state"] == "M"}
    assert {(20 + k, 10 + k) for k in range(25)} <= trace  # chance may lengthen it at the ends
    assert best["score"] >= 25 * 8 and best["evalue"] is not None
    assert max(got.values(), key=lambda r: r["score"])["target_id"] == "s1"


def test_exact_indexes_agree(spark):
    n, _ = planted(spark)
    rows = windows.windows(n, 5)
    q, d = windows.split_queries(rows, spark.createDataFrame([("s0",)], "id string"))
    key = lambda df: sorted(tuple(r) for r in df.select("query_window_start", "target_transcript", "target_window_start", "rank").collect())
    flat = key(knn.neighbours(q, d, SearchParams(k=7)))
    assert flat == key(knn.neighbours(q, d, SearchParams(k=7, index_type="ivf", nlist=5, nprobe=5))) == key(knn.neighbours_sql(q, d, 7))
    for kind in ("ivfpq", "opq_ivfpq", "hnsw", "hnswsq8", "hnswpq"):
        near = key(knn.neighbours(q, d, SearchParams(k=7, index_type=kind, nlist=4, nprobe=4, pq_m=20, pq_bits=6)))
        assert len({x[:3] for x in near} & {x[:3] for x in flat}) > 0.5 * len(flat)
    assert knn.neighbours(q, d, SearchParams(k=10_000)).where("query_window_start = 0").count() == d.count()


def test_inverted_lists(spark, tmp_path):
    """A stored index finds what flat search finds, and scores only the rows of probed lists."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 12))
    x = centres[rng.integers(0, 40, 3000)] + rng.normal(scale=0.25, size=(3000, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = spark.createDataFrame([(f"s{k % 50}", k // 50, k // 50, k // 50 + 3, v.tolist()) for k, v in enumerate(x)], "transcript_id string, window_index int, window_start int, window_end int, vector array<double>").repartition(3)
    q, d = windows.split_queries(rows, spark.createDataFrame([("s0",), ("s1",)], "id string"))
    key = lambda df: {tuple(r) for r in df.select("query_transcript", "query_window_start", "target_transcript", "target_window_start").collect()}
    flat = key(knn.neighbours(q, d, SearchParams(k=10)))
    for kind in ("ivf", "ivfpq", "opq_ivfpq", "hnsw", "hnswsq8", "hnswpq"):
        p = SearchParams(k=10, index_type=kind, nlist=32, pq_m=12, pq_bits=6, opq_m=4, hnsw_m=12, ef_construction=60, recall=0.9)
        index = knn.build_index(d, p)
        knn.write_index(d, index, str(tmp_path / kind))
        stored, held = knn.read_index(spark, str(tmp_path / kind))
        hits = knn.neighbours(q, held, p, stored)
        got = key(hits)
        assert len(got & flat) >= 0.9 * len(flat), kind
        assert got == key(knn.neighbours(q, d, p, index)), kind
        assert all(r["similarity"] == pytest.approx(r["score"], abs=1e-6) for r in hits.collect())  # ranked by what is exact
        work = knn.rows_scored(q, held, stored, stored.lists_needed or 1, max(64, stored.candidates_needed)).first()
        assert work["pairs"] == len(flat) // 10 * d.count() and 0 < work["scored"] < 0.3 * work["pairs"], kind
        plain = key(knn.neighbours(q, held, SearchParams(k=10, index_type=kind, nprobe=8), stored))
        assert len(plain & flat) >= (0.5 if kind.endswith("pq") else 0.85) * len(flat), kind  # ranked by the index's own scores
    with pytest.warns(UserWarning, match="mean norm"):
        knn.build_index(d.withColumn("vector", F.transform("vector", lambda v: v * 3)), SearchParams())
    assert sorted(index_ops.allocated(np.array([8.0, 4, 2, 1, 1, 1]), 3).tolist()) == list(range(6))


def test_depth_of_the_whole_database(spark):
    """On unrelated vectors, whose codes say little, the recall is reached, and a task still sends k rows a query and no more."""
    rng = np.random.default_rng(31)
    x = rng.normal(size=(2600, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = spark.createDataFrame([(f"s{k % 26}", k // 26, k // 26, k // 26 + 3, v.tolist()) for k, v in enumerate(x)], "transcript_id string, window_index int, window_start int, window_end int, vector array<double>").repartition(3)
    q, d = windows.split_queries(rows, spark.createDataFrame([("s0",)], "id string"))
    key = lambda df: {tuple(r) for r in df.select("query_transcript", "query_window_start", "target_transcript", "target_window_start").collect()}
    for metric in ("ip", "l2"):
        flat = key(knn.neighbours(q, d, SearchParams(k=10, metric=metric)))
        for kind in ("ivfpq", "hnswpq"):
            p = SearchParams(k=10, index_type=kind, metric=metric, nlist=8, pq_m=4, pq_bits=4, hnsw_m=8, ef_construction=40, recall=0.9)
            assert len(key(knn.neighbours(q, d, p)) & flat) >= 0.9 * len(flat), (kind, metric)
    p = SearchParams(k=10, index_type="ivfpq", nlist=8, pq_m=4, pq_bits=4, recall=0.9)
    index = knn.build_index(d, p)
    held = q.select(*knn.PLACE, "vector").toArrow()
    sent = knn.candidates(held.select(list(knn.PLACE)), index_ops.matrix(held.column("vector")), knn.indexed(d.coalesce(1), index), index, 10, 8, True)
    assert sent.count() == 10 * q.count()


def test_blocks_of_queries(spark, monkeypatch):
    """Work by blocks of queries, small ones and many, gives the same rows."""
    n, _ = planted(spark)
    rows = windows.windows(n, 5)
    q, d = windows.split_queries(rows, spark.createDataFrame([("s0",)], "id string"))
    key = lambda df: sorted(tuple(r) for r in df.select("query_window_start", "target_transcript", "target_window_start", "rank").collect())
    want = key(knn.neighbours(q, d, SearchParams(k=7)))
    assert len(knn.query_blocks(1000, 7)) == 1 and len(knn.query_blocks(knn.PAIRS, 2)) == 2
    assert sorted(k for s in knn.query_blocks(100, knn.PAIRS // 30) for k in range(s.start, s.stop)) == list(range(100))
    monkeypatch.setattr(knn, "QUERY_BYTES", 4096)
    assert want == key(knn.neighbours(q, d, SearchParams(k=7)))


def test_pairs_by_expressions(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = windows.windows(nodes_frame(spark, {f"t{k}": rng.normal(size=(60, 8)) for k in range(12)} | {"u": np.ones((20, 8)), "v": np.ones((20, 8))}), 3)
    q, d = windows.split_queries(rows, spark.createDataFrame([("t0",), ("u",)], "id string"))
    q, d = q.persist(), d.persist()
    seen, ranked = [], knn.ranked
    show = lambda df: sorted((r["query_transcript"], r["query_window_start"], r["rank"], r["target_transcript"], r["target_window_start"], round(r["similarity"], 9)) for r in df.collect())
    exact = show(knn.neighbours(q, d, SearchParams(k=5)))  # u against v: all pairs tie
    monkeypatch.setattr(knn, "ranked", lambda hits, k: seen.append(hits.count()) or ranked(hits, k))
    assert show(knn.neighbours_sql(q, d, 5)) == exact
    assert seen[-1] < q.count() * d.count() / 2  # most pairs go where they are scored
    monkeypatch.setattr(knn, "QUERY_BYTES", 40 * 24 * 8)
    assert show(knn.neighbours_sql(q, d, 5)) == exact
    few = d.where("transcript_id = 't1' AND window_start < 3")
    few = few.withColumn("vector", F.when(F.col("window_start") == 1, F.transform("vector", lambda x, i: F.when(i > 0, x))).otherwise(F.col("vector")))
    got = knn.neighbours_sql(q, few, 5).collect()
    assert len(got) == 3 * q.count() and all((r["score"] is None) == (r["target_window_start"] == 1) == (r["rank"] == 3) for r in got)
    assert knn.neighbours_sql(q.limit(0), d, 5).count() == knn.neighbours_sql(q, d.limit(0), 5).count() == 0
    with pytest.raises(ValueError, match="24 and 25"):
        knn.neighbours_sql(q, d.withColumn("vector", F.concat("vector", F.array(F.lit(0.0).cast("float")))), 5)


def test_rounding_of_what_is_left(spark, monkeypatch):
    """Pairs are dropped before they are rounded, and scores that only rounding makes equal tie by target."""
    at = "transcript_id string, window_index int, window_start int, window_end int, vector array<double>"
    d = spark.createDataFrame([(f"t{k % 7}", k, k, k + 3, [0.5 + (200 - k) * 1e-14, 3.0]) for k in range(200)], at).persist()
    q = spark.createDataFrame([("q", k, k, k + 3, [float(10**k), 0.0]) for k in range(6)], at).persist()
    seen, ranked = [], knn.ranked
    monkeypatch.setattr(knn, "ranked", lambda hits, k: seen.append(hits) or ranked(hits, k))
    show = lambda df: sorted((r["query_window_start"], r["rank"], r["target_transcript"], r["target_window_start"], r["score"]) for r in df.collect())
    got = show(knn.neighbours_sql(q, d, 5))
    joins = [x for x in seen[-1]._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join Inner" in x and "query_0" in x]
    assert joins and not any("round(" in x for x in joins)
    assert got == show(knn.neighbours(q, d, SearchParams(k=5))) and len({x[4] for x in got}) > 6


def test_codes_of_residuals():
    """Sums of table entries are the scores of decoded vectors; a learned rotation codes correlated rows better than none."""
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(24, 24)) * np.geomspace(4, 0.1, 24)
    x = rng.normal(size=(3000, 24)) @ mix.T
    q = rng.normal(size=(7, 24))
    centres = index_ops.k_means(x, 8)
    cuts, errors = index_ops.cuts_of(24, 6), {}
    for by_l2 in (False, True):
        for kind in ("ivfpq", "opq_ivfpq"):
            index = index_ops.Index(kind, by_l2, centres)
            lists = index.lists(x)
            r = x - centres[lists]
            if kind == "ivfpq":
                index.codebooks = [index_ops.k_means(r[:, a:b], 16, seed=int(a)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            else:
                index.rotation, index.codebooks = index_ops.rotated_books(r, 6, 16, 6)
                assert np.allclose(index.rotation @ index.rotation.T, np.eye(24))
            codes = index.code(x, lists)
            z = index.decoded(codes, lists)
            errors[kind] = ((x - z) ** 2).sum()
            mine = np.array([1, 4])
            score = index_ops.table_scores(index, index.tables(q), codes, mine).T + (q[mine] @ centres.T)[:, lists]
            want = q[mine] @ z.T
            if by_l2:
                score = 2 * score - index.offsets(codes, lists) - ((q[mine] ** 2).sum(1)[:, None] + (centres**2).sum(1)[lists])
                want = 2 * want - (z**2).sum(1) - (q[mine] ** 2).sum(1)[:, None]
            assert np.allclose(score, want, atol=1e-2)
            back = index_ops.Index.load(index.dump())
            assert np.array_equal(back.code(x[:50], lists[:50]), codes[:50]) and back.kind == kind and back.by_l2 == by_l2
        assert errors["opq_ivfpq"] < 0.8 * errors["ivfpq"]


@pytest.mark.parametrize("by_l2", [False, True])
def test_graph(by_l2):
    """A beam over a layered graph finds nearly all of the nearest and compares few; m and ef decide how well."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 24))
    x = centres[rng.integers(0, 60, 4000)] + 0.5 * rng.normal(size=(4000, 24))
    if not by_l2:
        x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, x = x[:100], x[100:]
    level = np.sort(graph.levels(rng.integers(0, 2**63, len(x)).astype(np.uint64), 8))[::-1]
    space = graph.Space(x, by_l2)
    near = 2 * q @ x.T - (x**2).sum(1) if by_l2 else q @ x.T
    best = np.argsort(-near, axis=1)[:, :10]
    share = {}
    for m, ef_construction, ef in ((8, 60, 64), (2, 4, 10)):
        layers = graph.build(space, level, m, ef_construction)
        assert [x.shape[1] for x in layers] == [2 * m] + [m] * (len(layers) - 1) and len(layers[0]) == len(x) > len(layers[1]) > 1
        linked = layers[0][layers[0] >= 0]
        assert linked.max() < len(x) and (layers[0] != np.arange(len(x))[:, None]).all()
        found = graph.search(space.to(q), layers, len(q), ef)
        assert found.compared < 0.3 * near.size
        share[m] = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found.nodes[:, :10].tolist(), best.tolist(), strict=True)])
    assert share[8] >= 0.95 and share[2] < share[8]
    few = graph.build(graph.Space(x[:1], by_l2), level[-1:], 4, 10)
    assert graph.search(graph.Space(x[:1], by_l2).to(q), few, len(q), 5).nodes[:, 0].tolist() == [0] * len(q)


def test_graph_without_walks(monkeypatch):
    """A graph is built by matrix products: each node's candidates are the nearest of all before it, and nothing is walked."""
    monkeypatch.setattr(graph, "beam", None)
    monkeypatch.setattr(graph, "WORK", 1 << 20)  # several parts of a batch
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 12))
    level = np.sort(graph.levels(rng.integers(0, 2**63, len(x)).astype(np.uint64), 8))[::-1]
    for by_l2 in (False, True):
        space = graph.Space(x, by_l2)
        assert [len(layer) for layer in graph.build(space, level, 8, 40)] == [int((level >= k).sum()) for k in range(level[0] + 1)]
        nodes, near = space.before(np.array([5, 900, 1499]), 40)
        assert (nodes[0, :5] >= 0).all() and (nodes[0, 5:] == -1).all()
        for k, new in ((1, 900), (2, 1499)):
            score = -((x[:new] - x[new]) ** 2).sum(1) if by_l2 else x[:new] @ x[new]
            assert set(nodes[k]) == set(np.argsort(-score)[:40]) and near[k] == pytest.approx(np.sort(score)[::-1][:40], abs=1e-3)


@pytest.mark.parametrize("kind", ["hnsw", "hnswsq8", "hnswpq"])
def test_graphs_of_unrelated_vectors(spark, kind):
    """Beams that would compare many of all pairs are given up for exact scores of all rows, so the neighbours are those of a flat search."""
    rng = np.random.default_rng(32)
    x = rng.normal(size=(2600, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[1300:1330] = x[1330]  # ties
    rows = spark.createDataFrame([(f"s{k % 26}", k // 26, k // 26, k // 26 + 3, v.tolist()) for k, v in enumerate(x)], "transcript_id string, window_index int, window_start int, window_end int, vector array<double>").withColumn("vector", F.col("vector").cast("array<float>"))
    q, d = windows.split_queries(rows.repartition(3), spark.createDataFrame([("s0",)], "id string"))
    key = lambda df: sorted(tuple(r) for r in df.select("query_window_start", "rank", "target_transcript", "target_window_start", F.round("similarity", 9)).collect())
    for metric in ("ip", "l2"):
        p = SearchParams(k=10, index_type=kind, metric=metric, pq_m=4, pq_bits=4, hnsw_m=8, ef_construction=40, recall=0.9)
        index = knn.build_index(d, p)
        assert key(knn.neighbours(q, d, p, index)) == key(knn.neighbours(q, d, SearchParams(k=10, metric=metric)))
        assert index.candidates_needed == knn.WHOLE


def test_shards_without_links(spark, monkeypatch):
    """One shard tells that beams don't pay, and the others aren't linked; what is searched for a recall's types is searched once."""
    monkeypatch.setattr(knn, "SHARD_ROWS", 1200)
    monkeypatch.setattr(knn, "beam_needed", None)
    linked, graphed = [], knn.graphed
    monkeypatch.setattr(knn, "graphed", lambda *a, **b: linked.append(b) or graphed(*a, **b))
    rng = np.random.default_rng(33)
    n = nodes_frame(spark, {f"s{k}": rng.normal(size=(100, 16)) for k in range(26)})
    q, d = windows.split_queries(windows.windows(n, 2), spark.createDataFrame([("s0",)], "id string"))
    key = lambda df: sorted(tuple(r) for r in df.select("query_window_start", "rank", "target_transcript", "target_window_start").collect())
    flat = key(knn.neighbours(q, d, SearchParams(k=10)))
    assert flat == key(knn.neighbours(q, d, SearchParams(k=10, index_type="hnsw", hnsw_m=8, ef_construction=40, recall=0.9)))
    assert linked == [{"first": True}, {"linked": False}] and not q.storageLevel.useMemory
    monkeypatch.setattr(engine, "ANN_TYPES", ("hnsw",) * 2)
    monkeypatch.setattr(engine, "sides", lambda *_: (q, d))
    plan = engine.ann_recall(spark, "")._jdf.queryExecution().withCachedData().toString()
    assert sum("InMemoryRelation" in x and "exact#" in x for x in plan.splitlines()) == 2


def test_best_rows():
    """A task's running best is that of all rows at once, ties in target order."""
    import pyarrow as pa

    rng = np.random.default_rng(3)
    score = np.round(rng.normal(size=(4, 90)), 1)
    best = knn.Best(4, 7)
    for a in range(0, 90, 30):
        part = pa.table({"transcript_id": [f"t{k:03}" for k in range(89 - a, 59 - a, -1)], "window_index": pa.array([0] * 30, pa.int32()), "window_start": pa.array([0] * 30, pa.int32()), "window_end": pa.array([1] * 30, pa.int32())})
        s = score[:, 89 - a : (59 - a if a < 60 else None) : -1]
        s = np.where(s < best.floor()[:, None], -np.inf, s)
        i, j = np.nonzero(np.isfinite(s))
        best.add(part, i, j, s[i, j], s[i, j])
    for k in range(4):
        order = sorted(range(90), key=lambda t: (-score[k, t], t))[:7]
        mine = best.query == k
        names = best.places.column("transcript_id").take(pa.array(best.row[mine])).to_pylist()
        assert names == [f"t{t:03}" for t in order]
    mask = knn.best_of(np.array([[1.0, 3, 3, 3, -np.inf]]), 2)
    assert mask.tolist() == [[False, True, True, False, False]]


@pytest.mark.parametrize("by_l2", [False, True])
def test_memory_of_a_search(by_l2):
    """A task's arrays have a bounded number of pairs, however many rows and queries meet; its rows are the nearest ones."""
    import tracemalloc
    from unittest.mock import MagicMock

    import pyarrow as pa

    rng = np.random.default_rng(4)
    q, x = rng.normal(size=(1500, 8)), rng.normal(size=(10_000, 8)).astype(np.float32)
    place = lambda n, name: {"transcript_id": pa.array([name] * n), **{c: pa.array(np.arange(n), pa.int32()) for c in knn.PLACE[1:]}}
    frame = MagicMock()
    frame.sparkSession.sparkContext.broadcast.side_effect = lambda value: MagicMock(value=value)
    knn.candidates(pa.table(place(1500, "q")), q, frame, index_ops.Index("flat_l2" if by_l2 else "flat_ip", by_l2), 3, 1, False)
    run = frame.select.return_value.mapInArrow.call_args.args[0]
    batch = pa.RecordBatch.from_pydict(place(10_000, "t") | {"vector": pa.FixedSizeListArray.from_arrays(x.ravel(), 8).cast(pa.list_(pa.float32()))})
    tracemalloc.start()
    got = pa.Table.from_batches(run(iter([batch]))).sort_by([("query_window_start", "ascending"), ("score", "descending")])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6  # 148 MB while 4 million scores were worked out at once
    near = 2 * q @ x.T.astype(float) - (q**2).sum(1)[:, None] - (x.astype(float) ** 2).sum(1) if by_l2 else q @ x.T.astype(float)
    assert got.column("target_window_start").to_pylist() == np.argsort(-near, axis=1)[:, :3].ravel().tolist()
    assert np.allclose(got.column("exact").to_numpy().reshape(-1, 3), np.sort(-near if by_l2 else near)[:, :3] if by_l2 else -np.sort(-near)[:, :3])


def test_empty_searches(spark):
    n, _ = planted(spark)
    none = spark.createDataFrame([], "id string")
    assert search(n, none, smoke(evd_samples=5)).alignments.count() == 0
    assert search(n, spark.createDataFrame([("s0",)], "id string"), SearchParams(window_size=100, evd_samples=5)).alignments.count() == 0
    with pytest.raises(ValueError, match="No database windows"):
        knn.build_index(windows.windows(n, 100), SearchParams())


def test_window_chunks(spark):
    """Chunks of windows are merged in the order of their ids; what doesn't fit together is refused."""
    n, _ = planted(spark)
    ids = spark.createDataFrame([("s0",), ("s3",)], "id string")

    def chunk(name, part, size=4):
        nodes = n.where(F.pmod(F.xxhash64("transcript_id"), F.lit(2)) == part)
        rows = windows.windows(nodes, size)
        q, d = windows.split_queries(rows, ids)
        return windows.Chunk(name, d, q, windows.window_stats(nodes, ids, rows, size).withColumns({"window_size": F.lit(size), "stride": F.lit(1)}))

    d, q, chunks, total = windows.merge_windows([chunk("b", 1), chunk("a", 0)])
    whole = windows.windows(n, 4)
    assert d.count() + q.count() == whole.count() and set(d.columns) == set(whole.columns)
    rows = chunks.orderBy("chunk_id").collect()
    assert [r["chunk_id"] for r in rows] == ["a", "b"] and rows[0]["database_first"] == 0 and rows[1]["database_first"] == rows[0]["database_windows"]
    t = total.first()
    assert t["chunks"] == 2 and t["database_windows"] == d.count() and t["queries"] == 2 and t["dimension"] == len(d.first()["vector"])
    for bad, word in (([chunk("a", 0), chunk("a", 1)], "repeated"), ([chunk("a", 0), chunk("b", 1, 5)], "differ")):
        with pytest.raises(ValueError, match=word):
            windows.merge_windows(bad)
    good = chunk("a", 0)
    with pytest.raises(ValueError, match="says"):
        windows.merge_windows([windows.Chunk("a", good.database, good.queries, good.stats.withColumn("database_windows", F.col("database_windows") + 1))])
    with pytest.raises(ValueError, match="says"):
        windows.merge_windows([windows.Chunk("a", good.database, good.queries, good.stats.withColumn("chunk_id", F.lit("z")))])


def test_alignment_of_given_clusters(spark):
    """align_only names ids without nodes, takes the first of repeated metadata rows, and its options change what they say."""
    from strandseek.plans.search import align_only, diagnose as _  # noqa: F401

    n, _ = planted(spark)
    p = smoke(window_size=5, evalue=False, evd_samples=5)
    out = search(n, spark.createDataFrame([("s0",)], "id string"), p)
    groups = out.clusters.persist()
    meta = spark.createDataFrame([(f"s{k}", "ACGU" * 30, "." * 120) for k in range(6)] * 2, "transcript_id string, sequence string, secondary_structure string")
    plain = align_only(groups, n, p, meta)
    assert plain.count() == plain.select("query_id", "target_id", "cluster_id").distinct().count() > 0
    with pytest.raises(ValueError, match="no nodes.*s99"):
        align_only(groups.withColumn("target_transcript", F.lit("s99")), n, p)
    text = report.alignment_text(plain).orderBy("text").first()["text"]
    assert re.search(r"Alignment \d+: s0 vs s\d \(cluster \d+\)", text) and "AvgCosine:" in text and "Gaps:" in text and "Content: Structure" in text
    assert out.stats.first()["alignments"] == out.alignments.count()
    shown = report.report_html(plain, 2)
    assert shown.count("<tr>") == 3 and "&lt;" not in shown
    c = align_only(groups, n, SearchParams(**{**p.__dict__, "compat_coords": True}))
    assert c.count() == plain.count()
    for mode, space in (("gumbel", "pair"), ("compat", "database")):
        q = SearchParams(**{**p.__dict__, "evalue": True, "evd_mode": mode, "search_space": space, "evd_samples": 30})
        evd = stats.evd_params(n, q)
        got = align_only(groups, n, q, None, evd).collect()
        assert all(r["evalue"] > 0 for r in got) and evd.first()["evd_K"] > 0


def test_scoring_matrix(spark):
    """The matrix in long form holds every cell of the band."""
    n, _ = planted(spark)
    p = smoke(window_size=5, evalue=False)
    groups = search(n, spark.createDataFrame([("s0",)], "id string"), p).clusters.limit(1)
    lengths = n.groupBy("transcript_id").agg(F.count("*").cast("int").alias("length"))
    places = alignment.regions(groups, lengths, p).persist()
    r = places.first()
    rows = alignment.scoring_matrix(places, n, p, 0.0, 1.0).collect()
    half = r["band"] // 2
    cells = sum(abs((j + 1) - (i + 1) - r["diagonal_offset"]) <= half for i in range(r["query_to"] - r["query_from"]) for j in range(r["target_to"] - r["target_from"]))
    assert len(rows) == cells and all(-4 <= x["score"] <= 8 for x in rows)


def test_matrix_plots(spark):
    """The path is marked where the trace goes, gaps stay at the other side's last place, and the chart's text names its region."""
    a = spark.createDataFrame(
        [("q", "t", 3, 12.3456, [("M", 2, 5), ("X", None, 6), ("M", 3, 7), ("Y", 4, None)])],
        "query_id string, target_id string, cluster_id int, score double, trace array<struct<state:string,query_pos:int,target_pos:int>>",
    )
    steps = [tuple(r)[3:] for r in plots.path_cells(a).orderBy("step").collect()]
    assert steps == [(0, "M", 2, 5), (1, "X", 2, 6), (2, "M", 3, 7), (3, "Y", 4, 7)]
    cells = spark.createDataFrame([("q", "t", 3, i, j, float(i * j)) for i in range(2, 5) for j in range(4, 9)], "query_transcript string, target_transcript string, cluster_id int, query_pos int, target_pos int, score double")
    marked = {(r["query_pos"], r["target_pos"]): r["state"] for r in plots.marked_matrix(cells, a).collect()}
    assert len(marked) == 15 and {k: v for k, v in marked.items() if v} == {(2, 5): "M", (2, 6): "X", (3, 7): "M", (4, 7): "Y"}
    places = spark.createDataFrame([("q", "t", 3, 9, 1, 2, 5, 4, 9, 4, 2, 8)], "query_transcript string, target_transcript string, cluster_id int, query_length int, target_length int, query_from int, query_to int, target_from int, target_to int, diagonal int, diagonal_span int, band int")
    got = plots.matrix_plots(a, places).first()
    assert got["name"] == "rank_01_q_vs_t_cluster_3_score_12_35" and got["title"] == "Rank 1: q vs t (cluster 3)" and got["caption"] == "Score 12.346 | Q[2,5) vs T[4,9) | Diagonal μ 4, span 2 | Band 8"
    assert got["query_ticks"] == [0, 8] and got["target_ticks"] == [0] and [tuple(p) for p in got["points"]] == [(5, 2), (6, 2), (7, 3), (7, 4)]


def test_readers(spark, tmp_path):
    (tmp_path / "t.tsv").write_text("transcript_id\tsequence\na\tACGU\nb\tGG\n")
    assert sorted(r["transcript_id"] for r in tables.read_transcripts(spark, str(tmp_path / "t.tsv")).collect()) == ["a", "b"]
    sinks.write_json(spark.createDataFrame([(0.3, 0.1)], "evd_lambda double, evd_K double"), str(tmp_path / "evd"))
    assert tables.read_evd(spark, str(tmp_path / "evd"))["evd_lambda"] == 0.3


def test_parameters():
    assert SearchParams(max_diagonal_span=0, xdrop=0.0, top_n=0).max_diagonal_span == 0
    for bad in ({"max_unpaired": 1.5}, {"index_type": "x"}, {"stride": 0}):
        with pytest.raises(ValueError):
            SearchParams(**bad)


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "n.tsv").write_text("transcript_id\tnode_index\tembedding_vector\n007\t1\t0.5,1\n007\t0\t1,2\na.b\t0\t\n")
    n = tables.read_nodes(spark, str(tmp_path / "n.tsv"))
    assert sorted((r[0], r[1], r[2]) for r in n.collect()) == [("007", 0, [1.0, 2.0]), ("007", 1, [0.5, 1.0])]
    (tmp_path / "q.csv").write_text("id\n007\n007\n\nzz\n")
    q = tables.read_queries(spark, str(tmp_path / "q.csv"))
    assert sorted(r[0] for r in q.collect()) == ["007", "zz"]
    assert [r[0] for r in tables.missing_ids(n, q).collect()] == ["zz"]
    nested = spark.createDataFrame([("t", "[[1, 2], [3, 4]]")], "transcript_id string, node_embeddings string")
    assert [(r[1], r[2]) for r in tables.normalise_nested(nested, "transcript_id").orderBy("node_index").collect()] == [(0, [1, 2]), (1, [3, 4])]
    wide = spark.createDataFrame([("t", 0, 1.0, 2.0, "x")], "transcript_id string, position int, emb_0 double, emb_1 double, note string")
    assert tables.normalise_wide(wide, "transcript_id").first()["embedding"] == [1.0, 2.0]
    sinks.write_tsv(n, str(tmp_path / "out"))
    assert tables.read_nodes(spark, str(tmp_path / "out"), vector_column="embedding").count() == 2
    x = np.load(__import__("io").BytesIO(sinks.npy(n, "embedding", ["transcript_id", "node_index"])))
    (tmp_path / "m.npy").write_bytes(sinks.npy(n, "embedding", ["transcript_id", "node_index"]))
    assert x.shape == (2, 2) and tables.read_vectors(spark, str(tmp_path / "m.npy")).count() == 2
    with pytest.raises(ValueError, match="missing columns"):
        tables.nodes_of(wide)


def test_presentation(spark):
    rows = spark.createDataFrame([("a", "((.)"), ("a", "(())"), ("b", ")(x)("), ("c", None), ("d", "")], "transcript_id string, secondary_structure string")
    assert sorted(tuple(r) for r in report.base_pairs(rows).collect()) == [("a", 0, 3), ("a", 1, 2), ("a", 1, 3), ("b", 1, 3)]
    assert "Arrow" not in report.base_pairs(rows)._jdf.queryExecution().toString() and "Python" not in report.base_pairs(rows)._jdf.queryExecution().toString()
    names = spark.createDataFrame([("a.b",), ("a_b",)], "x string").select(scores.safe_filename(F.col("x"))).collect()
    assert [r[0] for r in names] == ["a_b", "a_b"]


def test_drawings(spark):
    """Columns are found under several names, lists of ranges are marked, and what doesn't fit isn't drawn."""
    rows = spark.createDataFrame(
        [("q", None, "GATTACA", "((...))", "", None, "1;4", "3;6,9", "x"), ("q", "s", "GAT", "((.))", "ACGU", "", None, None, "y")],
        "query_id string, subject_id string, query_sequence string, query_structure string, sequence_2 string, subject_structure string, query_start string, query_end string, pair string",
    )
    got = {(r["pair"], r["side"]): r for r in report.drawing_sides(rows).collect()}
    first = got["x", "query"]
    assert first["sequence"] == "GAUUACA" and first["structure"] == "((...))" and first["valid"] and [tuple(h) for h in first["highlights"]] == [(1, 3), (4, 6)]
    assert got["x", "target"]["transcript_id"] == "RNA_x_2" and not got["x", "target"]["valid"] and not got["y", "query"]["valid"]
    assert got["y", "target"]["transcript_id"] == "s" and got["y", "target"]["structure"] == "...." and got["y", "target"]["valid"]
    made = {(r["pair"], r["side"]): r for r in report.drawings(report.drawing_sides(rows)).collect()}
    assert set(made) == {("x", "query"), ("y", "target")} and made["x", "query"]["width"] == 100
    svg = made["x", "query"]["svg"]
    assert svg.count("<path") == made["x", "query"]["arcs"] == 2 and svg.count('stroke-width="4"') == 2 and made["y", "target"]["arcs"] == 0
    wide = report.drawings(report.drawing_sides(rows.drop("pair").withColumn("query_sequence", F.repeat(F.lit("A"), 900)).withColumn("query_structure", F.repeat(F.lit("."), 900)))).where("side = 'query'").collect()
    assert [r["width"] for r in wide] == [700, 700]
    plain = spark.createDataFrame([("q", "t", 0, 12.34, "((..))", "(())", 0, 6, 0, 4), ("q", "u", 1, 1.0, None, None, 0, 1, 0, 1)], "query_id string, target_id string, cluster_id int, score double, query_structure string, target_structure string, query_start int, query_end int, target_start int, target_end int")
    plain = plain.withColumns({f"{s}_sequence": F.translate(f"{s}_structure", "().", "ACG") for s in ("query", "target")})
    full = report.with_drawings(plain)
    page = report.report_html(full, 2)
    assert page.count("data:image/svg+xml;base64,") == 2 and full.where("query_drawing IS NULL").count() == 1


def test_whole_strings_of_a_report(spark, monkeypatch):
    """Whole strings join a report's rows when these are in order; the rows and their order are those of a plain join, and the shuffle holds no whole string."""
    rng = np.random.default_rng(4)
    rows = spark.createDataFrame([(f"q{k % 3}", f"t{k % 4}", k, float(rng.integers(0, 30))) for k in range(300)], "query_id string, target_id string, cluster_id int, score double").repartition(5)
    whole = spark.createDataFrame([(f"t{k}", "(.)" * 40 * k) for k in range(3)], "target_id string, query_structure_region string")
    got = report.report_rows(rows, whole)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" in plan and plan.index("Join") < plan.index("Sort")  # it is still sorted, below the join
    want = report.report_rows(rows.join(whole, "target_id", "left").select(*rows.columns, "query_structure_region"))
    assert got.columns == want.columns and got.collect() == want.collect()
    monkeypatch.setattr(report, "WHOLE_BYTES", 0)
    assert report.report_rows(rows, whole).collect() == want.collect()


def test_base_pairs_of_equal_structures(spark, monkeypatch):
    """Base pairs are worked out once a distinct structure, however many drawings show it."""
    rows = spark.createDataFrame([(str(k), s, f"t{k}", "AGGCUU" + "A" * (k % 2), "((..))" + "." * (k % 2), [(0, 6)], True) for k in range(6) for s in ("query", "target")], "pair string, side string, transcript_id string, sequence string, structure string, highlights array<struct<start:int,end:int>>, valid boolean")
    seen, plain = [], report.base_pairs
    monkeypatch.setattr(report, "base_pairs", lambda meta, structure: seen.append(meta.count()) or plain(meta, structure))
    made = report.drawings(rows).collect()
    assert seen == [2] and len(made) == 12
    assert all(r["arcs"] == 2 == r["svg"].count("<path") == r["svg"].count("#c0392b") - 1 for r in made)


def test_places(spark):
    """Ranges number ids as one sort would; only wanted places are fetched; gaps in the index close."""
    ids = spark.createDataFrame([(f"{k * 7919 % 1000:03}",) for k in range(1000)], "transcript_id string").repartition(5)
    want = [(f"{k:03}", k) for k in range(1000)]
    for about in (1_000_000, 90):
        assert sorted(tuple(r) for r in places.numbered(ids, about).collect()) == want
    assert places.numbered(ids.limit(0)).count() == 0
    n = spark.createDataFrame([("a", 10, [1.0]), ("a", 3, [2.0]), ("a", 12, [3.0]), ("b", 0, [4.0])], NODES)
    wanted = spark.createDataFrame([("a", 0), ("a", 2), ("a", 0), ("a", 9), ("c", 0)], "transcript_id string, at int")
    for bounded in (False, True):
        assert sorted((r["transcript_id"], r["at"], list(r["embedding"])) for r in places.fetched(n, wanted, bounded).collect()) == [("a", 0, [2.0]), ("a", 2, [3.0])]
    rows = spark.createDataFrame([("a", "b", 0, 1, 3, 0, 1, 9, 0), ("a", "c", 1, 0, 2, 0, 1, 9, 0)], "query_transcript string, target_transcript string, cluster_id int, query_from int, query_to int, target_from int, target_to int, band int, diagonal_offset int")
    got = alignment.with_vectors(rows, n)
    assert [(r["target_transcript"], [list(x) for x in r["query_vectors"]], [list(x) for x in r["target_vectors"]]) for r in got.collect()] == [("b", [[1.0], [3.0]], [[4.0]])]


def shuffled_columns(df):
    """The columns of each shuffle of a frame's plan."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return [m[1] for m in re.finditer(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text)]


def test_draws_come_before_vectors(spark, tmp_path):
    """No shuffle of the background's plan carries the vectors of all nodes, and no window is over one partition."""
    rng = np.random.default_rng(1)
    nodes_frame(spark, {f"t{k}": rng.normal(size=(20, 4)) for k in range(30)}).write.parquet(str(tmp_path / "n"))
    n = spark.read.parquet(str(tmp_path / "n"))
    out = stats.background(n, 50)
    wide = [c for c in shuffled_columns(out) if "embedding" in c]
    assert all("id" in c for c in wide)  # only what has been drawn
    assert "SinglePartition, REQUIRED" not in out._jdf.queryExecution().toString()
    assert out.first()["background_sigma"] > 0


def test_diagnose(spark):
    n, _ = planted(spark)
    rows = windows.windows(n, 3).withColumn("key", F.concat_ws(":", "transcript_id", "window_start"))
    out = diagnose(rows, "key", "transcript_id")
    assert out["norms"].first()["norm_mean"] == pytest.approx(1, abs=1e-5)
    assert out["dispersion"].count() == 6 and out["components"].count() == rows.count()


def test_streaming(spark, tmp_path, monkeypatch):
    from strandseek.streaming.incremental import search_stream

    n, _ = planted(spark)
    q, d = windows.split_queries(windows.windows(n, 5), spark.createDataFrame([("s0",)], "id string"))
    for half in (0, 1):
        q.where(F.col("window_start") % 2 == half).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    want = seed_ops.seeds(knn.neighbours(q, d, SearchParams(k=5)), 0.6).count()
    arriving = lambda files: spark.readStream.schema(q.schema).option("maxFilesPerTrigger", files).parquet(str(tmp_path / "in"))
    for files, kind, store in ((9, "flat_ip", None), (1, "flat_ip", None), (1, "ivf", str(tmp_path / "ivf")), (1, "hnsw", str(tmp_path / "hnsw"))):
        got, made = [], []
        p = SearchParams(k=5, threshold=0.6, index_type=kind, nlist=4, nprobe=4)
        if store:
            monkeypatch.setattr(knn, "indexed", lambda *a, f=knn.indexed, made=made: made.append(1) or f(*a))
        s = search_stream(arriving(files), d, p, lambda df, _, got=got: got.append(df.count()), str(tmp_path / f"ck{kind}{files}{bool(store)}"), store)
        s.awaitTermination()
        monkeypatch.undo()
        assert sum(got) == want > 0 and len(got) == (1 if files == 9 else 2)
        assert len(made) == (1 if store else 0)  # the database is indexed once, however many batches come


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test data")
def test_queries_against_sql(spark):
    import duckdb

    import __spark_entry__
    from strandseek import queries

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("embeddings", "orders", "customer"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    said = lambda v: "-" if v is None or v != v else f"{v:.5f}" if isinstance(v, float) else str(v)
    differ = {}
    for name, sql in queries.SQL.items():
        ours, theirs = queries.QUERIES[name](spark, sf), con.sql(sql)
        cols = sorted(ours.columns)
        if cols != sorted(theirs.columns):
            differ[name] = cols
            continue
        a = sorted(tuple(said(r[c]) for c in cols) for r in ours.collect())
        at = [theirs.columns.index(c) for c in cols]
        b = sorted(tuple(said(r[k]) for k in at) for r in theirs.fetchall())
        if a != b:
            differ[name] = next((x for x in zip(a, b, strict=False) if x[0] != x[1]), (len(a), len(b)))
    assert not differ
    assert __spark_entry__.entry(spark).count() > 0
