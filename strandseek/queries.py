"""The engine's queries over the driver's tables, and the same in DuckDB's SQL where SQL can express them.

Each label of ``embeddings`` is a transcript (T0, T1 ...); T0 and T1 are the queries. Structures and
sequences are derived from the vectors' first two components.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandseek.functions import scores, vectors
from strandseek.operators import alignment, cluster, diagnostics, knn, plots, report, stats, windows
from strandseek.operators import seeds as seed_ops
from strandseek.params import SearchParams
from strandseek.plans.search import search
from strandseek.sources import tables
from strandseek.sources.tables import driver_nodes, first_of_each, meta_projection, missing_ids, query_ids

P = SearchParams(window_size=3, k=20, threshold=0.15, top_n=10, background_samples=2000, evd_samples=60)
QUERIES, SQL = {}, {}
R6 = lambda c: F.round(c, 6)

NODES = "n AS (SELECT 'T' || CAST(label AS VARCHAR) AS t, CAST(row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS INTEGER) AS i, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"


def windows_sql(size: int, stride: int = 1, name: str = "w") -> str:
    """CTEs: raw windows, then unit vectors (as floats, like the engine's)."""
    frame = f"OVER (PARTITION BY t ORDER BY i ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING)"
    return (
        f"{name}0 AS (SELECT t, i AS s, CAST(i / {stride} AS INTEGER) AS x, flatten(list(e) {frame}) AS r, count(*) {frame} AS c, count(*) OVER (PARTITION BY t) AS l FROM n), "
        f"{name}1 AS (SELECT *, sqrt(list_sum(list_transform(r, lambda v: v * v))) AS nn FROM {name}0 WHERE c = {size} AND s % {stride} = 0), "
        f"{name} AS (SELECT t, x, s, l, nn, CAST(list_transform(r, lambda v: CAST(CASE WHEN nn > 0 THEN v / nn ELSE v END AS FLOAT)) AS DOUBLE[]) AS v FROM {name}1)"
    )


META_SQL = (
    "m AS (SELECT t, string_agg(CASE WHEN e[1] > 0.05 THEN '(' WHEN e[1] < -0.05 THEN ')' ELSE '.' END, '' ORDER BY i) AS st, "
    "string_agg(CASE WHEN e[2] > 0.1 THEN 'A' WHEN e[2] > 0 THEN 'C' WHEN e[2] > -0.1 THEN 'G' ELSE 'U' END, '' ORDER BY i) AS sq, max(i) + 1 AS l FROM n GROUP BY t)"
)
HITS_SQL = (
    f"{NODES}, {windows_sql(3)}, p AS (SELECT a.t AS qt, a.x AS qx, a.s AS qs, b.t AS tt, b.x AS tx, b.s AS ts, round(list_dot_product(a.v, b.v), 12) AS sc "
    "FROM w a, w b WHERE a.t IN ('T0', 'T1') AND b.t NOT IN ('T0', 'T1')), "
    "h AS (SELECT *, row_number() OVER (PARTITION BY qt, qs ORDER BY sc DESC, tt, ts) AS rk, greatest(-1, least(1, sc)) AS sim FROM p QUALIFY rk <= 20), "
    "s AS (SELECT *, ts - qs AS dg FROM h WHERE sim >= 0.15 AND qt <> tt)"
)
FOLD_SQL = (
    f"{HITS_SQL}, o AS (SELECT *, row_number() OVER (PARTITION BY qt, tt ORDER BY qs, ts, rk) AS k FROM s), "
    "f AS (SELECT qt, tt, k, qs, ts, dg, dg AS lo, dg AS hi, 0 AS g FROM o WHERE k = 1 UNION ALL "
    "SELECT qt, tt, k, qs, ts, dg, CASE WHEN ok THEN least(lo, dg) ELSE dg END, CASE WHEN ok THEN greatest(hi, dg) ELSE dg END, CASE WHEN ok THEN g ELSE g + 1 END FROM ("
    "SELECT o.qt, o.tt, o.k, o.qs, o.ts, o.dg, f.lo, f.hi, f.g, o.qs - f.qs <= 80 AND o.ts - f.ts <= 80 AND o.dg BETWEEN f.lo - 12 AND f.hi + 12 "
    "AND greatest(f.hi, o.dg) - least(f.lo, o.dg) <= 96 AS ok FROM f JOIN o ON o.qt = f.qt AND o.tt = f.tt AND o.k = f.k + 1)), "
    "z AS (SELECT *, count(*) OVER (PARTITION BY qt, tt, g) AS n FROM f), "
    "mem AS (SELECT CAST(dense_rank() OVER (PARTITION BY z.qt ORDER BY z.tt, z.g) - 1 AS INTEGER) AS cid, o.* FROM z JOIN o USING (qt, tt, k) WHERE z.n >= 2), "
    "cl AS (SELECT cid, qt, tt, CAST(trunc(median(dg)) AS INTEGER) AS dg, CAST(count(*) AS INTEGER) AS n, min(qs) AS q0, max(qs) + 3 AS q1, min(ts) AS t0, max(ts) + 3 AS t1, "
    "max(sim) AS ms, min(dg) AS d0, max(dg) AS d1 FROM mem GROUP BY cid, qt, tt)"
)
LENGTHS_SQL = "ln AS (SELECT t, max(i) + 1 AS l FROM n GROUP BY t)"


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def nodes_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_nodes(spark, sf_dir)


def asked(spark: SparkSession) -> DataFrame:
    return query_ids(spark.createDataFrame([("T0",), ("T1",), ("T0",), (None,)], "id string"))


def meta_of(nodes: DataFrame) -> DataFrame:
    x, y = F.get("embedding", F.lit(0)), F.get("embedding", F.lit(1))
    st = F.when(x.cast("double") > 0.05, "(").when(x.cast("double") < -0.05, ")").otherwise(".")
    sq = F.when(y.cast("double") > 0.1, "A").when(y > 0, "C").when(y.cast("double") > -0.1, "G").otherwise("U")
    rows = nodes.groupBy("transcript_id").agg(F.sort_array(F.collect_list(F.struct("node_index", st.alias("st"), sq.alias("sq")))).alias("a"))
    return rows.select("transcript_id", F.array_join("a.sq", "").alias("sequence"), F.array_join("a.st", "").alias("secondary_structure"), F.lit("x").alias("note"))


def sides(spark: SparkSession, sf_dir: str, size: int = 3) -> tuple[DataFrame, DataFrame]:
    q, d = windows.split_queries(windows.windows(nodes_of(spark, sf_dir), size), asked(spark))
    return windows.renumbered(q), d


def hits_of(spark: SparkSession, sf_dir: str, p: SearchParams = P) -> DataFrame:
    return knn.neighbours(*sides(spark, sf_dir), p)


def seeds_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seed_ops.seeds(hits_of(spark, sf_dir), P.threshold)


def lengths_of(nodes: DataFrame) -> DataFrame:
    return nodes.groupBy("transcript_id").agg(F.count("*").cast("int").alias("length"))


@query(f"WITH {NODES} SELECT t AS transcript_id, i AS node_index, round(sqrt(list_sum(list_transform(e, lambda v: v * v))), 6) AS norm, round(e[1], 6) AS first, len(e) AS dimension FROM n")
def scan_nodes(spark, sf_dir):
    n = nodes_of(spark, sf_dir)
    return n.select("transcript_id", "node_index", R6(vectors.norm("embedding")).alias("norm"), R6(F.get("embedding", F.lit(0)).cast("double")).alias("first"), F.size("embedding").cast("long").alias("dimension"))


@query(f"WITH {NODES} SELECT t AS transcript_id, CASE WHEN t IN ('T0', 'T1') THEN 'query' ELSE 'database' END AS side, count(*) AS nodes FROM n GROUP BY 1, 2")
def query_split(spark, sf_dir):
    q, d = windows.split_queries(nodes_of(spark, sf_dir), asked(spark))
    both = q.withColumn("side", F.lit("query")).unionByName(d.withColumn("side", F.lit("database")))
    return both.groupBy("transcript_id", "side").agg(F.count("*").alias("nodes"))


@query(f"WITH {NODES}, {META_SQL} SELECT t AS transcript_id, sq AS sequence, st AS secondary_structure FROM m")
def metadata_projection(spark, sf_dir):
    return meta_projection(meta_of(nodes_of(spark, sf_dir)))


@query("SELECT label, min(vec_id) AS vec_id FROM embeddings GROUP BY label")
def first_row_of_each_id(spark, sf_dir):
    return first_of_each(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("label", "vec_id"), "label", F.col("vec_id"))


@query("SELECT 'T' || i AS id FROM range(7, 13) r(i) WHERE NOT EXISTS (SELECT 1 FROM embeddings WHERE label = i)")
def missing_id_list(spark, sf_dir):
    return missing_ids(nodes_of(spark, sf_dir), spark.range(7, 13).select(F.concat(F.lit("T"), F.col("id").cast("string")).alias("id")))


def shown_nodes(rows: DataFrame) -> DataFrame:
    return rows.select("transcript_id", "node_index", F.size("embedding").cast("long").alias("dimension"), F.round(vectors.norm("embedding"), 4).alias("norm"))


SHOWN_NODES = "SELECT t AS transcript_id, i AS node_index, len(e) AS dimension, round(sqrt(list_sum(list_transform(e, lambda v: v * v))), 4) AS norm FROM n"


@query(f"WITH {NODES} {SHOWN_NODES}")
def nodes_from_text(spark, sf_dir):
    n = nodes_of(spark, sf_dir).withColumn("embedding_vector", F.array_join(F.col("embedding").cast("array<string>"), ","))
    return shown_nodes(tables.nodes_of(n))


@query(f"WITH {NODES} {SHOWN_NODES}")
def nodes_from_lists(spark, sf_dir):
    n = nodes_of(spark, sf_dir).groupBy("transcript_id").agg(F.sort_array(F.collect_list(F.struct("node_index", "embedding"))).alias("a"))
    return shown_nodes(tables.normalise_nested(n.select("transcript_id", F.to_json("a.embedding").alias("node_embeddings")), "transcript_id"))


@query(f"WITH {NODES} {SHOWN_NODES}")
def nodes_from_columns(spark, sf_dir):
    n = nodes_of(spark, sf_dir)
    wide = n.select("transcript_id", F.col("node_index").alias("position"), *[F.get("embedding", F.lit(k)).alias(f"emb_{k}") for k in range(64)], F.lit("x").alias("note"))
    return shown_nodes(tables.normalise_wide(wide, "transcript_id"))


@query(f"WITH {NODES} SELECT t AS transcript_id, count(*) AS nodes FROM n WHERE t IN ('T0', 'T1') GROUP BY t")
def nodes_of_ids(spark, sf_dir):
    return tables.only_ids(nodes_of(spark, sf_dir), asked(spark)).groupBy("transcript_id").agg(F.count("*").alias("nodes"))


@query(
    f"WITH {NODES}, {META_SQL}, {windows_sql(4)} SELECT w.t AS transcript_id, CAST(row_number() OVER (PARTITION BY w.t ORDER BY s) - 1 AS INTEGER) AS window_index, s AS window_start FROM w JOIN m USING (t) "
    "WHERE t IN ('T0', 'T1') AND (s + 4 > length(st) OR length(regexp_replace(substr(st, s + 1, 4), '[^.]', '', 'g')) / 4.0 < 0.5)"
)
def renumbered_query_windows(spark, sf_dir):
    n = nodes_of(spark, sf_dir)
    q, _ = windows.split_queries(windows.windows(n, 4, meta=meta_of(n), max_unpaired=0.5), asked(spark))
    return windows.renumbered(q).select("transcript_id", "window_index", "window_start")


@query(f"WITH {NODES}, {windows_sql(3)} SELECT 'flat_ip' AS index_type, 'ip' AS metric, count(*) AS vectors, max(len(v)) AS dimension FROM w WHERE t NOT IN ('T0', 'T1')")
def index_stats(spark, sf_dir):
    return knn.index_stats(sides(spark, sf_dir)[1], P).withColumn("dimension", F.col("dimension").cast("long"))


def window_chunks(spark, sf_dir, size: int = 3) -> list[windows.Chunk]:
    """The windows of every third label, as a part of the database that was worked on by itself."""
    n, out = nodes_of(spark, sf_dir), []
    for k in (2, 0, 1):
        nodes = n.where(F.substring("transcript_id", 2, 9).cast("int") % 3 == k)
        rows = windows.windows(nodes, size)
        q, d = windows.split_queries(rows, asked(spark))
        out.append(windows.Chunk(f"c{k}", d, q, windows.window_stats(nodes, asked(spark), rows, size).withColumns({"window_size": F.lit(size), "stride": F.lit(1)})))
    return out


@query(
    f"WITH {NODES}, {LENGTHS_SQL}, a AS (SELECT count(*) AS transcripts, CAST(sum(CASE WHEN l >= 3 THEN 1 ELSE 0 END) AS BIGINT) AS long_enough, CAST(sum(greatest(l - 2, 0)) AS BIGINT) AS possible_windows, "
    "CAST(sum(CASE WHEN t IN ('T0', 'T1') THEN greatest(l - 2, 0) ELSE 0 END) AS BIGINT) AS query_windows FROM ln) "
    "SELECT transcripts, long_enough, possible_windows, possible_windows AS kept_windows, query_windows, possible_windows - query_windows AS database_windows, CAST(0 AS BIGINT) AS filtered_windows, "
    "CAST(2 AS BIGINT) AS queries, 3 AS window_size, 1 AS stride, 192 AS dimension, 3 AS chunks FROM a"
)
def merge_stats(spark, sf_dir):
    return windows.merge_windows(window_chunks(spark, sf_dir))[3]


WINDOW_COLUMNS = "SELECT t AS transcript_id, x AS window_index, s AS window_start, s + {0} AS window_end, {0} AS window_size, CAST(l AS INTEGER) AS transcript_length, round(v[1], 5) AS first, round(v[-1], 5) AS last, round(sqrt(list_sum(list_transform(v, lambda y: y * y))), 5) AS norm FROM w"


def window_columns(rows: DataFrame) -> DataFrame:
    end = lambda k: F.round(F.element_at("vector", k).cast("double"), 5)
    return rows.withColumns({"first": end(1), "last": end(-1), "norm": F.round(vectors.norm("vector"), 5)}).drop("vector")


@query(f"WITH {NODES}, {windows_sql(3)} {WINDOW_COLUMNS.format(3)}")
def sliding_windows(spark, sf_dir):
    return window_columns(windows.windows(nodes_of(spark, sf_dir), 3))


@query(f"WITH {NODES}, {windows_sql(5, 3)} {WINDOW_COLUMNS.format(5)}")
def window_stride(spark, sf_dir):
    return window_columns(windows.windows(nodes_of(spark, sf_dir), 5, 3))


@query(f"WITH {NODES}, {windows_sql(3)} SELECT t AS transcript_id, s AS window_start, round(nn, 6) AS norm FROM w1")
def window_norm(spark, sf_dir):
    return windows.window_norms(windows.windows(nodes_of(spark, sf_dir), 3, normalize=False)).withColumn("norm", R6("norm"))


@query(
    f"WITH {NODES}, {META_SQL}, {windows_sql(4)} SELECT w.t AS transcript_id, x AS window_index, s AS window_start FROM w JOIN m USING (t) "
    "WHERE s + 4 > length(st) OR length(regexp_replace(substr(st, s + 1, 4), '[^.]', '', 'g')) / 4.0 < 0.5"
)
def unpaired_filter(spark, sf_dir):
    n = nodes_of(spark, sf_dir)
    return windows.windows(n, 4, meta=meta_of(n), max_unpaired=0.5).select("transcript_id", "window_index", "window_start")


@query(
    f"WITH {NODES}, {META_SQL}, {windows_sql(4)}, k AS (SELECT w.t FROM w JOIN m USING (t) WHERE length(regexp_replace(substr(st, s + 1, 4), '[^.]', '', 'g')) / 4.0 < 0.5), "
    "a AS (SELECT count(*) AS transcripts, CAST(sum(CASE WHEN l >= 4 THEN 1 ELSE 0 END) AS BIGINT) AS long_enough, CAST(sum(greatest(l - 3, 0)) AS BIGINT) AS possible_windows FROM m) "
    "SELECT a.*, 2 AS queries, (SELECT count(*) FROM k) AS kept_windows, (SELECT count(*) FROM k WHERE t IN ('T0', 'T1')) AS query_windows, "
    "(SELECT count(*) FROM k WHERE t NOT IN ('T0', 'T1')) AS database_windows, possible_windows - (SELECT count(*) FROM k) AS filtered_windows FROM a"
)
def window_statistics(spark, sf_dir):
    n = nodes_of(spark, sf_dir)
    return windows.window_stats(n, asked(spark), windows.windows(n, 4, meta=meta_of(n), max_unpaired=0.5), 4)


@query(
    f"WITH {NODES}, {windows_sql(3)}, c AS (SELECT 'c' || CAST(CAST(substr(t, 2) AS INTEGER) % 3 AS VARCHAR) AS chunk_id, count(*) FILTER (t NOT IN ('T0', 'T1')) AS d, count(*) FILTER (t IN ('T0', 'T1')) AS q, "
    "round(sum(CASE WHEN t NOT IN ('T0', 'T1') THEN v[1] ELSE 0 END), 4) AS s FROM w GROUP BY 1) "
    "SELECT chunk_id, CAST(sum(d) OVER o - d AS BIGINT) AS database_first, d AS database_windows, CAST(sum(q) OVER o - q AS BIGINT) AS query_first, q AS query_windows, s AS first_sum FROM c WINDOW o AS (ORDER BY chunk_id)"
)
def merge_chunks(spark, sf_dir):
    d, _, placed, _ = windows.merge_windows(window_chunks(spark, sf_dir))
    of = F.concat(F.lit("c"), (F.substring("transcript_id", 2, 9).cast("int") % 3).cast("string"))
    sums = d.groupBy(of.alias("chunk_id")).agg(F.round(F.sum(F.get("vector", F.lit(0)).cast("double")), 4).alias("first_sum"))
    return placed.join(sums, "chunk_id", "left")


def hit_columns() -> list:
    return ["query_transcript", "query_window_start", "target_transcript", "target_window_start", "rank", R6("similarity").alias("similarity")]


HIT_SELECT = "SELECT qt AS query_transcript, qs AS query_window_start, tt AS target_transcript, ts AS target_window_start, CAST(rk AS INTEGER) AS rank, round(sim, 6) AS similarity FROM h"


@query(f"WITH {HITS_SQL} {HIT_SELECT}")
def knn_ip(spark, sf_dir):
    return hits_of(spark, sf_dir).select(hit_columns())


@query(f"WITH {HITS_SQL} {HIT_SELECT}")
def knn_ip_expressions(spark, sf_dir):
    return knn.neighbours_sql(*sides(spark, sf_dir), P.k).select(hit_columns())


L2_SQL = HITS_SQL.replace("round(list_dot_product(a.v, b.v), 12) AS sc", "-round(list_dot_product(a.v, a.v) + list_dot_product(b.v, b.v) - 2 * list_dot_product(a.v, b.v), 12) AS sc").replace(
    "greatest(-1, least(1, sc)) AS sim", "greatest(-1, least(1, 1 + sc / 2)) AS sim"
)


@query(f"WITH {L2_SQL} {HIT_SELECT}")
def knn_l2(spark, sf_dir):
    return hits_of(spark, sf_dir, SearchParams(k=20, index_type="flat_l2", metric="l2")).select(hit_columns())


@query("SELECT a.vec_id AS a, b.vec_id AS b, round(greatest(-1, least(1, 1 - list_sum(list_transform(list_zip(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) / 2)), 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def cosine_from_l2(spark, sf_dir):
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    a, b = v.select(F.col("vec_id").alias("a"), F.col("embedding").alias("x")), v.select((F.col("vec_id") - 1).alias("a"), F.col("vec_id").alias("b"), F.col("embedding").alias("y"))
    far = F.aggregate(F.zip_with("x", "y", lambda p, q: (p.cast("double") - q.cast("double")) * (p.cast("double") - q.cast("double"))), F.lit(0.0), lambda s, d: s + d)
    return a.join(b, "a").select("a", "b", R6(vectors.cosine_of_distance(far)).alias("cosine"))


SEED_SELECT = (
    "qt AS query_transcript, tt AS target_transcript, qs AS query_window_start, qs + 3 AS query_window_end, ts AS target_window_start, ts + 3 AS target_window_end, "
    "qx AS query_window_index, tx AS target_window_index, round(sim, 6) AS similarity, CAST(rk AS INTEGER) AS rank, dg AS diagonal"
)


@query(f"WITH {HITS_SQL} SELECT {SEED_SELECT} FROM s")
def seeds(spark, sf_dir):
    return seeds_of(spark, sf_dir).withColumn("similarity", R6("similarity"))


SELF_SQL = HITS_SQL.replace("WHERE a.t IN ('T0', 'T1') AND b.t NOT IN ('T0', 'T1')", "WHERE a.t IN ('T0', 'T1')")


@query(f"WITH {SELF_SQL} {HIT_SELECT} WHERE qt <> tt")
def self_hit_exclusion(spark, sf_dir):
    rows = windows.windows(nodes_of(spark, sf_dir), 3)
    q, _ = windows.split_queries(rows, asked(spark))
    return seed_ops.without_self(knn.neighbours(q, rows, P)).select(hit_columns())


@query(
    f"WITH {HITS_SQL}, a AS (SELECT t, count(*) AS windows FROM w WHERE t IN ('T0', 'T1') GROUP BY t), b AS (SELECT qt, count(*) AS k FROM s GROUP BY qt) "
    "SELECT a.t AS query_transcript, windows, coalesce(k, 0) AS seeds_kept, 20 AS top_k, CAST(0.15 AS DOUBLE) AS threshold, false AS rescored FROM a LEFT JOIN b ON a.t = b.qt"
)
def seed_stats(spark, sf_dir):
    return seed_ops.seed_stats(seeds_of(spark, sf_dir), sides(spark, sf_dir)[0], P.k, P.threshold, P.rescored)


@query(f"WITH RECURSIVE {FOLD_SQL} SELECT cid AS cluster_id, {SEED_SELECT} FROM mem")
def cluster_members(spark, sf_dir):
    return cluster.members(seeds_of(spark, sf_dir), P).withColumn("similarity", R6("similarity"))


def clusters_of(spark, sf_dir) -> DataFrame:
    return cluster.clusters(cluster.members(seeds_of(spark, sf_dir), P))


def clusters_held(spark, sf_dir) -> DataFrame:
    """The same, kept for steps that read them several times."""
    return clusters_of(spark, sf_dir).persist()


@query(
    f"WITH RECURSIVE {FOLD_SQL} SELECT cid AS cluster_id, qt AS query_transcript, tt AS target_transcript, dg AS diagonal, n AS seed_count, q0 AS query_start, q1 AS query_end, "
    "t0 AS target_start, t1 AS target_end, round(ms, 6) AS max_similarity, d0 AS diagonal_min, d1 AS diagonal_max, d1 - d0 AS diagonal_span FROM cl"
)
def cluster_summary(spark, sf_dir):
    return clusters_of(spark, sf_dir).withColumn("max_similarity", R6("max_similarity"))


@query(
    f"WITH RECURSIVE {FOLD_SQL}, a AS (SELECT qt, count(*) AS seeds FROM s GROUP BY qt), b AS (SELECT qt, count(DISTINCT cid) AS c, count(*) AS k FROM mem GROUP BY qt) "
    "SELECT a.qt AS query_transcript, seeds, coalesce(c, 0) AS clusters, coalesce(k, 0) AS clustered_seeds FROM a LEFT JOIN b USING (qt)"
)
def cluster_stats(spark, sf_dir):
    rows = seeds_of(spark, sf_dir)
    return cluster.cluster_stats(rows, cluster.members(rows, P))


def region_sql(padding: int = 32, width: int = 96, buffer: int = 32) -> str:
    return (
        f"rg AS (SELECT cl.*, greatest(0, q0 - {padding}) AS qf, least(a.l, q1 + {padding}) AS qe, greatest(0, t0 - {padding}) AS tf, least(b.l, t1 + {padding}) AS te, "
        f"greatest({width}, d1 - d0 + {buffer} + (d1 - d0 + {buffer}) % 2) AS band FROM cl JOIN ln a ON a.t = qt JOIN ln b ON b.t = tt)"
    )


REGION_SQL = region_sql()


@query(
    f"WITH RECURSIVE {FOLD_SQL}, {LENGTHS_SQL}, {REGION_SQL} SELECT qt AS query_transcript, tt AS target_transcript, cid AS cluster_id, CAST(qf AS INTEGER) AS query_from, CAST(qe AS INTEGER) AS query_to, "
    "CAST(tf AS INTEGER) AS target_from, CAST(te AS INTEGER) AS target_to, CAST(dg + qf - tf AS INTEGER) AS diagonal_offset, CAST(band AS INTEGER) AS band FROM rg"
)
def region_bounds(spark, sf_dir):
    rows = alignment.regions(clusters_of(spark, sf_dir), lengths_of(nodes_of(spark, sf_dir)), P)
    return rows.select("query_transcript", "target_transcript", "cluster_id", "query_from", "query_to", "target_from", "target_to", "diagonal_offset", "band")


@query(
    f"WITH RECURSIVE {FOLD_SQL} SELECT qt AS query_transcript, cid AS cluster_id, d1 - d0 AS span, CAST(greatest(96, d1 - d0 + 32 + (d1 - d0 + 32) % 2) AS INTEGER) AS band, "
    "CAST(greatest(8, d1 - d0 + 3 + (d1 - d0 + 3) % 2) AS INTEGER) AS narrow, CAST(greatest(1, least(greatest(8, d1 - d0 + 3 + (d1 - d0 + 3) % 2), 10)) AS INTEGER) AS capped FROM cl"
)
def adaptive_bands(spark, sf_dir):
    span = F.col("diagonal_span")
    bands = {"band": scores.adaptive_band(span), "narrow": scores.adaptive_band(span, 8, 3), "capped": scores.adaptive_band(span, 8, 3, 10)}
    return clusters_of(spark, sf_dir).select("query_transcript", "cluster_id", span.alias("span"), *[v.cast("int").alias(k) for k, v in bands.items()])


def draw_sql(which: int, seed: int) -> str:
    a, b = stats.STEPS[which], stats.STEPS[(which + 1) % 4]
    return f"(((i + 1) * {a} + {seed * 7919 + which * 104729}) % {stats.PRIME} * {b} % {stats.PRIME})"


@query(
    f"WITH {NODES}, ids AS (SELECT t, count(*) AS l, row_number() OVER (ORDER BY t) - 1 AS p FROM n GROUP BY t), c AS (SELECT count(*) AS c FROM ids), "
    f"d AS (SELECT {draw_sql(0, 42)} AS a, {draw_sql(1, 42)} AS b, {draw_sql(2, 42)} AS x, {draw_sql(3, 42)} AS y FROM range(0, 2000) r(i)), "
    "g AS (SELECT list_dot_product(u.e, v.e) AS s FROM d, c JOIN ids f ON f.p = d.a % c.c JOIN ids h ON h.p = d.b % c.c JOIN n u ON u.t = f.t AND u.i = d.x % f.l JOIN n v ON v.t = h.t AND v.i = d.y % h.l) "
    "SELECT round(avg(s), 6) AS background_mu, round(stddev_pop(s), 6) AS background_sigma FROM g"
)
def background_stats(spark, sf_dir):
    return stats.background(nodes_of(spark, sf_dir), 2000, 42).select(R6("background_mu").alias("background_mu"), R6("background_sigma").alias("background_sigma"))


@query(
    f"WITH RECURSIVE {FOLD_SQL}, {LENGTHS_SQL}, {region_sql(4, 6, 2)} SELECT qt AS query_transcript, tt AS target_transcript, cid AS cluster_id, a.i AS query_pos, b.i AS target_pos, "
    "round(greatest(-4, least(8, 1.5 * (list_dot_product(a.e, b.e) - 0.01) / 0.125)), 6) AS score FROM rg JOIN n a ON a.t = qt AND a.i >= qf AND a.i < qe JOIN n b ON b.t = tt AND b.i >= tf AND b.i < te "
    "WHERE (b.i - tf) - (a.i - qf) - (dg + qf - tf) BETWEEN -(band // 2) AND band // 2"
)
def cell_scores(spark, sf_dir):
    n, p = nodes_of(spark, sf_dir), SearchParams(padding=4, band_width=6, band_buffer=2)
    rows = alignment.regions(clusters_held(spark, sf_dir), lengths_of(n), p)
    return alignment.scoring_matrix(rows, n, p, 0.01, 0.125).withColumn("score", R6("score"))


TOP_SQL = "SELECT query_id, target_id, cluster_id, score FROM (SELECT CAST(o_custkey % 20 AS VARCHAR) AS query_id, CAST(o_orderkey AS VARCHAR) AS target_id, 0 AS cluster_id, CAST(round(o_totalprice) AS DOUBLE) AS score FROM orders) QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY "


def ranked_orders(spark, sf_dir) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return o.select((F.col("o_custkey") % 20).cast("string").alias("query_id"), F.col("o_orderkey").cast("string").alias("target_id"), F.lit(0).alias("cluster_id"), F.round("o_totalprice").cast("double").alias("score"))


@query(f"{TOP_SQL} score DESC, target_id, cluster_id) <= 5")
def topn_per_query(spark, sf_dir):
    return alignment.top_n(ranked_orders(spark, sf_dir), 5)


@query(f"{TOP_SQL} score, target_id DESC, cluster_id DESC) > 10")
def topn_negative(spark, sf_dir):
    return alignment.top_n(ranked_orders(spark, sf_dir), -10)


def context_rows(spark, sf_dir) -> DataFrame:
    c = clusters_of(spark, sf_dir)
    return c.select(F.col("query_transcript").alias("query_id"), F.col("target_transcript").alias("target_id"), "cluster_id", "query_start", "query_end", "target_start", "target_end")


@query(
    f"WITH RECURSIVE {FOLD_SQL}, {META_SQL} SELECT cid AS cluster_id, qt AS query_id, tt AS target_id, substr(a.sq, q0 + 1, q1 - q0) AS query_sequence_region, substr(b.sq, t0 + 1, t1 - t0) AS target_sequence_region, "
    "substr(a.st, q0 + 1, q1 - q0) AS query_structure_region, substr(b.st, t0 + 1, t1 - t0) AS target_structure_region FROM cl JOIN m a ON a.t = qt JOIN m b ON b.t = tt"
)
def region_strings(spark, sf_dir):
    out = alignment.with_context(context_rows(spark, sf_dir), meta_of(nodes_of(spark, sf_dir)))
    return out.select("cluster_id", "query_id", "target_id", *[f"{s}_{k}_region" for k in ("sequence", "structure") for s in ("query", "target")])


@query(
    f"WITH {NODES}, {META_SQL} SELECT t AS query_id, substr(sq, 1, 3) || '-' || substr(sq, 4, 1) || 'N' AS upper, substr(st, 1, 2) || '-' || substr(st, 3, 2) || 'N' AS lower, '|| ' || ' ||' AS mask FROM m"
)
def alignment_strings(spark, sf_dir):
    m = meta_of(nodes_of(spark, sf_dir))
    steps = [("M", 0, 0), ("M", 1, 1), ("Y", 2, None), ("X", None, 2), ("M", 3, 3), ("M", 100_000, 100_000)]
    trace = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(q).cast("int").alias("query_pos"), F.lit(t).cast("int").alias("target_pos")) for s, q, t in steps])
    upper, lower, mask = alignment.strings(trace, F.col("sequence"), F.col("secondary_structure"))
    return m.select(F.col("transcript_id").alias("query_id"), upper.alias("upper"), lower.alias("lower"), mask.alias("mask"))


UNIT_ROWS = "u AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"


def vector_rows(spark, sf_dir) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", F.col("embedding").alias("vector"))


@query(
    f"WITH {UNIT_ROWS}, x AS (SELECT sqrt(list_sum(list_transform(e, lambda v: v * v))) AS n FROM u) SELECT count(*) AS rows, round(min(n), 6) AS norm_min, round(max(n), 6) AS norm_max, round(avg(n), 6) AS norm_mean, round(stddev_pop(n), 6) AS norm_std FROM x"
)
def norm_stats(spark, sf_dir):
    s = diagnostics.norm_stats(vector_rows(spark, sf_dir))
    return s.select("rows", *[R6(c).alias(c) for c in s.columns[1:]])


COSINES_SQL = (
    f"WITH {UNIT_ROWS}, l AS (SELECT vec_id, sqrt(list_sum(list_transform(e, lambda v: v * v))) AS n, e FROM u ORDER BY md5('7:' || vec_id), vec_id LIMIT 2000), "
    "f AS (SELECT vec_id, CAST(list_transform(e, lambda v: CAST(v / n AS FLOAT)) AS DOUBLE[]) AS e FROM l), c AS (SELECT list_dot_product(a.e, b.e) AS c FROM f a JOIN f b ON a.vec_id < b.vec_id)"
)


@query(f"{COSINES_SQL} SELECT count(*) AS pairs, round(avg(c), 6) AS cosine_mean, round(stddev_pop(c), 6) AS cosine_std, round(min(c), 6) AS cosine_min, round(max(c), 6) AS cosine_max FROM c")
def pairwise_cosine(spark, sf_dir):
    s = diagnostics.cosine_stats(diagnostics.pair_cosines(vector_rows(spark, sf_dir), "vec_id"))
    return s.select("pairs", *[R6(c).alias(c) for c in s.columns[1:]])


@query(f"{COSINES_SQL} SELECT CAST(least(59, floor((c + 1) / 2 * 60)) AS INTEGER) AS bin, count(*) AS count FROM c GROUP BY 1")
def cosine_histogram(spark, sf_dir):
    return diagnostics.histogram(diagnostics.pair_cosines(vector_rows(spark, sf_dir), "vec_id"), "cosine", -1, 1)


@query(
    f"WITH {UNIT_ROWS}, k AS (SELECT label, i, avg(e[i]) AS x FROM u, range(1, 65) r(i) GROUP BY label, i), c AS (SELECT label, list(x ORDER BY i) AS c FROM k GROUP BY label) "
    "SELECT label, count(*) AS count, round(1 - avg(list_dot_product(e, c) / sqrt(list_dot_product(c, c))), 6) AS dispersion FROM u JOIN c USING (label) GROUP BY label HAVING count(*) >= 2"
)
def label_dispersion(spark, sf_dir):
    return diagnostics.label_dispersion(vector_rows(spark, sf_dir)).withColumn("dispersion", R6("dispersion"))


@query(
    f"WITH {UNIT_ROWS}, k AS (SELECT label, i, avg(e[i]) AS x FROM u, range(1, 65) r(i) GROUP BY label, i), c AS (SELECT label, list(x ORDER BY i) AS c FROM k GROUP BY label) "
    "SELECT label, count(*) AS count, round(1 - avg(list_dot_product(e, c) / sqrt(list_dot_product(c, c))), 6) AS dispersion FROM u JOIN c USING (label) GROUP BY label HAVING count(*) >= 2 ORDER BY 3, 2 DESC, 1 LIMIT 3"
)
def tightest_labels(spark, sf_dir):
    return diagnostics.tightest(diagnostics.label_dispersion(vector_rows(spark, sf_dir)), 3).withColumn("dispersion", R6("dispersion"))


@query("SELECT c_custkey AS id, regexp_replace(c_name || '.' || c_custkey || '/x y', '[^A-Za-z0-9_-]', '_', 'g') AS name FROM customer")
def safe_filename(spark, sf_dir):
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return c.select(F.col("c_custkey").alias("id"), scores.safe_filename(F.concat("c_name", F.lit("."), F.col("c_custkey").cast("string"), F.lit("/x y"))).alias("name"))


@query(f"WITH {HITS_SQL} {HIT_SELECT}")
def knn_ivf_all_lists(spark, sf_dir):
    return hits_of(spark, sf_dir, SearchParams(k=20, index_type="ivf", nlist=16, nprobe=16)).select(hit_columns())


ANN_TYPES = ("ivf", "ivfpq", "opq_ivfpq", "hnsw", "hnswsq8", "hnswpq")
ANN_RECALL = 0.9


def ann_params(kind: str) -> SearchParams:
    return SearchParams(k=20, index_type=kind, nlist=16, pq_m=16, pq_bits=5, opq_m=16, recall=ANN_RECALL)


def approximate(kind: str):
    def run(spark, sf_dir):
        return hits_of(spark, sf_dir, ann_params(kind)).select(hit_columns())

    run.__name__ = f"knn_{kind}"
    QUERIES[run.__name__] = run


for _kind in ANN_TYPES:
    approximate(_kind)


@query(
    f"WITH {NODES}, {windows_sql(3)}, a AS (SELECT count(*) AS n FROM w WHERE t NOT IN ('T0', 'T1')) SELECT k AS index_type, count(*) AS windows, CAST(sum(least(20, n)) AS BIGINT) AS neighbours, true AS reached "
    f"FROM w, a, (VALUES {', '.join(f"('{k}')" for k in ANN_TYPES)}) v(k) WHERE t IN ('T0', 'T1') GROUP BY k"
)
def ann_recall(spark, sf_dir):
    """Of each approximate type, whether it finds the share of the exact neighbours that was aimed at."""
    q, d = (x.persist() for x in sides(spark, sf_dir))
    by = ["query_transcript", "query_window_start", "target_transcript", "target_window_start"]
    flat, out = knn.neighbours(q, d, P).select(*by, F.lit(1).alias("exact")).persist(), None  # searched once for all types
    for kind in ANN_TYPES:
        near = knn.neighbours(q, d, ann_params(kind)).select(*by, F.lit(1).alias("found"))
        rows = flat.join(near, by, "left").agg(F.countDistinct(*by[:2]).alias("windows"), F.count("*").alias("neighbours"), F.count("found").alias("found"))
        rows = rows.select(F.lit(kind).alias("index_type"), "windows", "neighbours", (F.col("found") >= ANN_RECALL * F.col("neighbours")).alias("reached"))
        out = rows if out is None else out.unionByName(rows)
    return out


def result_of(spark, sf_dir, p: SearchParams = P):
    n = nodes_of(spark, sf_dir)
    return search(n, asked(spark), p, meta_of(n))


@query()
def smith_waterman(spark, sf_dir):
    return result_of(spark, sf_dir, SearchParams(**{**P.__dict__, "evalue": False})).alignments.drop("trace")


@query()
def alignment_trace(spark, sf_dir):
    return alignment.traces(result_of(spark, sf_dir, SearchParams(**{**P.__dict__, "evalue": False})).alignments)


@query()
def alignment_text(spark, sf_dir):
    return report.alignment_text(result_of(spark, sf_dir, SearchParams(**{**P.__dict__, "evalue": False})).alignments)


@query()
def search_end_to_end(spark, sf_dir):
    return result_of(spark, sf_dir).alignments.drop("trace")


@query()
def null_scores(spark, sf_dir):
    n = nodes_of(spark, sf_dir)
    return stats.null_scores(n, P, 0.0, 0.125)


@query()
def evd_params(spark, sf_dir):
    return stats.evd_params(nodes_of(spark, sf_dir), P)


@query()
def pca(spark, sf_dir):
    return diagnostics.principal_components(vector_rows(spark, sf_dir), "vec_id")[0]


@query(
    f"WITH {NODES}, {META_SQL}, c AS (SELECT t, k, substr(st, CAST(k + 1 AS INTEGER), 1) AS ch FROM (SELECT t, st, unnest(range(length(st))) AS k FROM m)), "
    "s AS (SELECT *, sum(CASE ch WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER (PARTITION BY t ORDER BY k) AS s FROM c), "
    "a AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY t ORDER BY k)) AS d FROM s), p AS (SELECT *, lag(d, 1, 0) OVER (PARTITION BY t ORDER BY k) AS e FROM a), "
    "l AS (SELECT t, k, ch, CASE ch WHEN '(' THEN d ELSE e END AS v FROM p WHERE ch = '(' OR (ch = ')' AND e > 0)), "
    "x AS (SELECT t, k AS i, ch, lead(k) OVER o AS j, lead(ch) OVER o AS cj FROM l WINDOW o AS (PARTITION BY t, v ORDER BY k)) "
    "SELECT t AS transcript_id, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j FROM x WHERE ch = '(' AND cj = ')'"
)
def base_pairs(spark, sf_dir):
    return report.base_pairs(meta_of(nodes_of(spark, sf_dir)))


@query()
def report_table(spark, sf_dir):
    return report.report_rows(result_of(spark, sf_dir, SearchParams(**{**P.__dict__, "evalue": False})).alignments)


#: Alignments made from orders and metadata, for the presentation alone: of every order one, its strings cut out of two transcripts.
FIXED_SQL = (
    f"{NODES}, {META_SQL}, f AS (SELECT 'Q' || CAST(o_custkey % 20 AS VARCHAR) AS query_id, 'T' || CAST(o_orderkey % 10 AS VARCHAR) AS target_id, CAST(o_orderkey AS INTEGER) AS cluster_id, "
    "CAST(o_orderkey AS DOUBLE) / 7 AS score, CAST(o_custkey % 90 AS DOUBLE) / 97 AS avg_cosine, 12 AS alignment_length, CAST(o_orderkey % 3 AS INTEGER) AS gap_opens, CAST(o_orderkey % 5 AS INTEGER) AS gap_bases, "
    "CAST(o_orderkey % 7 AS INTEGER) AS query_start, CAST(o_orderkey % 7 + 12 AS INTEGER) AS query_end, 3 AS target_start, 15 AS target_end FROM orders), "
    "g AS (SELECT f.*, CASE WHEN cluster_id % 4 = 0 THEN NULL ELSE substr(st, query_start + 1, 12) END AS aligned_query_structure, CASE WHEN cluster_id % 4 = 0 THEN NULL ELSE substr(st, 4, 12) END AS aligned_target_structure, "
    "CASE WHEN cluster_id % 8 = 0 THEN substr(sq, query_start + 1, 12) END AS aligned_query_sequence, CASE WHEN cluster_id % 8 = 0 THEN substr(sq, 4, 12) END AS aligned_target_sequence, "
    "CASE WHEN cluster_id % 4 <> 0 THEN 'structure' WHEN cluster_id % 8 = 0 THEN 'sequence' END AS alignment_content, repeat('|', 12) AS alignment_mask, st AS query_structure_region FROM f JOIN m ON t = target_id)"
)


def fixed_alignments(spark, sf_dir) -> DataFrame:
    o, m = spark.read.parquet(f"{sf_dir}/orders.parquet"), meta_of(nodes_of(spark, sf_dir))
    key, of = F.col("o_orderkey"), F.col("o_custkey")
    f = o.select(
        F.concat(F.lit("Q"), (of % 20).cast("string")).alias("query_id"), F.concat(F.lit("T"), (key % 10).cast("string")).alias("target_id"), key.cast("int").alias("cluster_id"),
        (key.cast("double") / 7).alias("score"), ((of % 90).cast("double") / 97).alias("avg_cosine"), F.lit(12).alias("alignment_length"), (key % 3).cast("int").alias("gap_opens"), (key % 5).cast("int").alias("gap_bases"),
        (key % 7).cast("int").alias("query_start"), (key % 7 + 12).cast("int").alias("query_end"), F.lit(3).alias("target_start"), F.lit(15).alias("target_end"),
    ).join(F.broadcast(m.where(F.col("transcript_id").isin([f"T{k}" for k in range(10)]))), F.col("target_id") == F.col("transcript_id"))
    c, cut = F.col("cluster_id"), lambda text, side: F.substring(F.col(text), F.col(f"{side}_start") + 1, F.lit(12))
    structure, sequence = c % 4 != 0, c % 8 == 0
    strings = {f"aligned_{s}_structure": F.when(structure, cut("secondary_structure", s)) for s in ("query", "target")} | {f"aligned_{s}_sequence": F.when(sequence, cut("sequence", s)) for s in ("query", "target")}
    more = {"alignment_content": F.when(structure, "structure").when(sequence, "sequence"), "alignment_mask": F.repeat(F.lit("|"), 12)}
    return f.withColumns(strings | more).drop("transcript_id", "sequence", "secondary_structure", "note")


@query(
    f"WITH {FIXED_SQL}, u AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, target_id, cluster_id) AS k, coalesce(aligned_query_structure, aligned_query_sequence) AS q, "
    "coalesce(aligned_target_structure, aligned_target_sequence) AS x FROM g WHERE length(coalesce(aligned_query_structure, aligned_query_sequence)) > 0 AND length(coalesce(aligned_target_structure, aligned_target_sequence)) > 0) "
    "SELECT query_id, target_id, cluster_id, printf('Alignment %d: %s vs %s (cluster %d)', k, query_id, target_id, cluster_id) || chr(10) || "
    "printf('  Score: %.3f', score) || chr(9) || printf('AvgCosine: %.3f', avg_cosine) || chr(9) || printf('Len: %d', alignment_length) || chr(9) || printf('Gaps: %d/%d', gap_opens, gap_bases) || chr(10) || "
    "CASE alignment_content WHEN 'structure' THEN '  Content: Structure' || chr(10) WHEN 'sequence' THEN '  Content: Sequence' || chr(10) ELSE '' END || "
    "printf('  Query  %6d  %s  %6d', query_start, q, query_end) || chr(10) || repeat(' ', 17) || alignment_mask || chr(10) || printf('  Target %6d  %s  %6d', target_start, x, target_end) || chr(10) AS text FROM u"
)
def alignment_text_of_table(spark, sf_dir):
    return report.alignment_text(fixed_alignments(spark, sf_dir))


@query(
    f"WITH {FIXED_SQL} SELECT query_id, target_id, cluster_id, round(score, 1) AS score, avg_cosine, alignment_length, gap_opens, gap_bases, query_start, query_end, target_start, target_end, aligned_query_structure, "
    "aligned_target_structure, aligned_query_sequence, aligned_target_sequence, regexp_replace(regexp_replace(query_structure_region, '(.{30})', '\\1<br>', 'g'), '<br>$', '') AS query_structure_region FROM g"
)
def report_table_of_table(spark, sf_dir):
    whole = meta_of(nodes_of(spark, sf_dir)).select(F.col("transcript_id").alias("target_id"), F.col("secondary_structure").alias("query_structure_region"))
    return report.report_rows(fixed_alignments(spark, sf_dir), whole)


#: Whole sequences on one another, unbanded and without X-drop: the recurrences a row at a time.
LOCAL_SQL = (
    f"WITH RECURSIVE {NODES}, sq AS (SELECT t, list(e ORDER BY i) AS v, count(*) AS l FROM n GROUP BY t), "
    "p AS (SELECT a.t AS qt, b.t AS tt, a.v AS q, b.v AS x, a.l AS m, b.l AS nn FROM sq a, sq b WHERE a.t IN ('T0', 'T1') AND b.t NOT IN ('T0', 'T1')), "
    "r AS (SELECT qt, tt, CAST(0 AS BIGINT) AS i, list_transform(range(nn + 1), lambda j: CAST(0 AS DOUBLE)) AS ms, list_transform(range(nn + 1), lambda j: CAST(-1e9 AS DOUBLE)) AS xs, "
    "list_transform(range(nn + 1), lambda j: CAST(-1e9 AS DOUBLE)) AS ys, CAST(0 AS DOUBLE) AS best FROM p UNION ALL "
    "SELECT qt, tt, i + 1, m2, x2, y2, greatest(best, list_max(m2), list_max(x2), list_max(y2)) FROM ("
    "SELECT *, [CAST(-1e9 AS DOUBLE)] || list_transform(range(1, nn + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: m2[k] - 12 + k * 2)) - j * 2) AS x2 FROM ("
    "SELECT r.qt, r.tt, r.i, r.best, p.nn, [CAST(0 AS DOUBLE)] || list_transform(range(1, nn + 1), lambda j: "
    "greatest(-4, least(8, 1.5 * (list_dot_product(q[r.i + 1], x[j]) - 0.01) / 0.125)) + greatest(0, ms[j], xs[j], ys[j])) AS m2, "
    "[CAST(-1e9 AS DOUBLE)] || list_transform(range(1, nn + 1), lambda j: greatest(ms[j + 1] - 12, ys[j + 1] - 2)) AS y2 FROM r JOIN p ON r.qt = p.qt AND r.tt = p.tt WHERE r.i < p.m)))"
)


@query(f"{LOCAL_SQL} SELECT r.qt AS query_id, r.tt AS target_id, round(best, 5) AS score FROM r JOIN p ON r.qt = p.qt AND r.tt = p.tt WHERE r.i = p.m AND best > 0")
def local_alignment_scores(spark, sf_dir):
    n = nodes_of(spark, sf_dir)
    lengths, ids = lengths_of(n), asked(spark)
    q, d = windows.split_queries(lengths, ids)
    # every query against every transcript: the queries are the stated set, a row that holds them all is joined
    held = q.agg(F.collect_list(F.struct(F.col("transcript_id").alias("query_transcript"), F.col("length").alias("query_to"))).alias("asked")).withColumn("one", F.lit(1))
    pairs = d.select(F.col("transcript_id").alias("target_transcript"), F.col("length").alias("target_to"), F.lit(1).alias("one")).join(F.broadcast(held), "one")
    pairs = pairs.select("target_transcript", "target_to", F.explode("asked").alias("x")).select("target_transcript", "target_to", "x.*")
    rows = pairs.withColumns({c: F.lit(0) for c in ("cluster_id", "query_from", "target_from", "diagonal_offset")}).withColumn("band", 2 * F.col("query_to") + 2 * F.col("target_to"))
    out = alignment.aligned(rows, n, SearchParams(xdrop=1e12), 0.01, 0.125)
    return out.select("query_id", "target_id", F.round("score", 5).alias("score"))


@query(
    f"{LOCAL_SQL}, s AS (SELECT r.qt, r.tt, round(best, 5) AS s, p.m, p.nn FROM r JOIN p ON r.qt = p.qt AND r.tt = p.tt WHERE r.i = p.m AND best > 0), "
    "l AS (SELECT s.*, lam, k FROM s, (VALUES (0.05, 0.01), (0.2, 0.5), (0.0, 0.01)) v(lam, k)), b AS (SELECT *, CASE WHEN lam > 0 THEN (lam * s - ln(k)) / ln(2) ELSE 0 END AS b FROM l), "
    "e AS (SELECT *, CASE WHEN lam > 0 THEN m * nn * pow(2.0, -b) ELSE CAST('inf' AS DOUBLE) END AS e FROM b) "
    "SELECT qt AS query_id, tt AS target_id, CAST(lam AS DOUBLE) AS evd_lambda, round(b, 6) AS bit_score, CASE WHEN isinf(e) THEN 'inf' ELSE format('{:.4e}', e) END AS evalue, "
    "CASE WHEN e < 0.001 THEN 'highly significant' WHEN e < 0.01 THEN 'significant' WHEN e < 0.1 THEN 'marginal' WHEN e < 1 THEN 'weak' ELSE 'not significant' END AS significance FROM e"
)
def bit_score_evalue(spark, sf_dir):
    lengths = lengths_of(nodes_of(spark, sf_dir))
    rows = local_alignment_scores(spark, sf_dir)
    for side in ("query", "target"):
        rows = rows.join(lengths.select(F.col("transcript_id").alias(f"{side}_id"), F.col("length").alias(f"{side}_length")), f"{side}_id")
    given = F.explode(F.array(*[F.struct(F.lit(lam).alias("lam"), F.lit(k).alias("k")) for lam, k in ((0.05, 0.01), (0.2, 0.5), (0.0, 0.01))]))
    rows = rows.withColumn("given", given).select("*", "given.*")
    lam, k = F.col("lam"), F.col("k")
    e = scores.e_value(F.col("score"), lam, k, F.col("query_length"), F.col("target_length"))
    shown = F.when(e == float("inf"), "inf").otherwise(F.format_string("%.4e", e))
    return rows.select("query_id", "target_id", lam.alias("evd_lambda"), R6(scores.bit_score(F.col("score"), lam, k)).alias("bit_score"), shown.alias("evalue"), scores.significance(e).alias("significance"))


#: The same recurrences inside a band, and with X-drop: a row outside the band keeps the one before, and a row that falls too far behind is the last.
BAND_P = SearchParams(padding=12, band_width=6, band_buffer=2, xdrop=14.0)
BANDED_SQL = (
    f"WITH RECURSIVE {FOLD_SQL}, {LENGTHS_SQL}, {region_sql(12, 6, 2)}, sq AS (SELECT t, list(e ORDER BY i) AS v FROM n GROUP BY t), "
    "pr AS (SELECT qt, tt, cid, a.v[qf + 1 : qe] AS q, b.v[tf + 1 : te] AS x, qe - qf AS m, te - tf AS nn, dg + qf - tf AS off, band // 2 AS half FROM rg JOIN sq a ON a.t = qt JOIN sq b ON b.t = tt), "
    "r AS (SELECT qt, tt, cid, CAST(0 AS BIGINT) AS i, list_transform(range(nn + 1), lambda j: CAST(0 AS DOUBLE)) AS ms, list_transform(range(nn + 1), lambda j: CAST(-1e9 AS DOUBLE)) AS xs, "
    "list_transform(range(nn + 1), lambda j: CAST(-1e9 AS DOUBLE)) AS ys, CAST(0 AS DOUBLE) AS best, false AS done FROM pr UNION ALL "
    "SELECT qt, tt, cid, i + 1, CASE WHEN a > b THEN ms ELSE m2 END, CASE WHEN a > b THEN xs ELSE x2 END, CASE WHEN a > b THEN ys ELSE y2 END, CASE WHEN a > b THEN best ELSE greatest(best, top) END, "
    "a <= b AND greatest(best, top) - top > 14 FROM (SELECT *, greatest(list_max(m2[2:]), list_max(x2[2:]), list_max(y2[2:])) AS top FROM ("
    "SELECT *, [CAST(-1e9 AS DOUBLE)] || list_transform(range(1, nn + 1), lambda j: CASE WHEN j BETWEEN a AND b THEN "
    "list_max(list_transform(range(1, j + 1), lambda k: (CASE WHEN k = 1 AND a > 1 THEN CAST(-1e9 AS DOUBLE) ELSE m2[k] END) - 12 + k * 2)) - j * 2 ELSE CAST(-1e9 AS DOUBLE) END) AS x2 FROM ("
    "SELECT *, [CAST(0 AS DOUBLE)] || list_transform(range(1, nn + 1), lambda j: CASE WHEN j BETWEEN a AND b THEN "
    "greatest(-4, least(8, 1.5 * (list_dot_product(q[i + 1], x[j]) - 0.01) / 0.125)) + greatest(0, ms[j], xs[j], ys[j]) ELSE CAST(-1e9 AS DOUBLE) END) AS m2, "
    "[CAST(-1e9 AS DOUBLE)] || list_transform(range(1, nn + 1), lambda j: CASE WHEN j BETWEEN a AND b THEN greatest(ms[j + 1] - 12, ys[j + 1] - 2) ELSE CAST(-1e9 AS DOUBLE) END) AS y2 FROM ("
    "SELECT r.*, pr.q, pr.x, pr.nn, greatest(1, r.i + 1 + off - half) AS a, least(pr.nn, r.i + 1 + off + half) AS b FROM r JOIN pr ON r.qt = pr.qt AND r.tt = pr.tt AND r.cid = pr.cid WHERE r.i < pr.m AND NOT r.done)))))"
)


@query(f"{BANDED_SQL} SELECT qt AS query_id, tt AS target_id, cid AS cluster_id, round(max(best), 5) AS score FROM r GROUP BY qt, tt, cid HAVING max(best) > 0")
def banded_alignment_scores(spark, sf_dir):
    n = nodes_of(spark, sf_dir)
    rows = alignment.regions(clusters_held(spark, sf_dir), lengths_of(n), BAND_P)
    return alignment.aligned(rows, n, BAND_P, 0.01, 0.125).select("query_id", "target_id", "cluster_id", F.round("score", 5).alias("score"))


@query(
    f"{BANDED_SQL}, t AS (SELECT qt, tt, cid, round(max(best), 9) AS score FROM r GROUP BY qt, tt, cid HAVING max(best) > 0), k AS (SELECT *, row_number() OVER (PARTITION BY qt ORDER BY score DESC, tt, cid) AS rank FROM t) "
    "SELECT k.qt AS query_id, k.tt AS target_id, k.cid AS cluster_id, CAST(rank AS INTEGER) AS rank, "
    "regexp_replace(printf('rank_%02d_%s_vs_%s_cluster_%d_score_%.2f', rank, k.qt, k.tt, k.cid, score), '[^A-Za-z0-9_-]', '_', 'g') AS name, printf('Rank %d: %s vs %s (cluster %d)', rank, k.qt, k.tt, k.cid) AS title, "
    "printf('Score %.3f | Q[%d,%d) vs T[%d,%d) | Diagonal μ %d, span %d | Band %d', score, qf, qe, tf, te, dg, d1 - d0, band) AS caption, "
    "CAST(qf AS INTEGER) AS region_query_start, CAST(qe AS INTEGER) AS region_query_end, CAST(tf AS INTEGER) AS region_target_start, CAST(te AS INTEGER) AS region_target_end "
    "FROM k JOIN rg ON rg.qt = k.qt AND rg.tt = k.tt AND rg.cid = k.cid"
)
def matrix_plots(spark, sf_dir):
    n = nodes_of(spark, sf_dir)
    places = alignment.regions(clusters_held(spark, sf_dir), lengths_of(n), BAND_P)
    rows = alignment.aligned(places, n, BAND_P, 0.01, 0.125).withColumn("score", F.round("score", 9)).persist()  # so equal alignments tie
    return plots.matrix_plots(rows, places).drop("query_ticks", "target_ticks", "points")


@query(
    f"{BANDED_SQL}, k AS (SELECT qt, tt, cid FROM r GROUP BY qt, tt, cid HAVING max(best) > 0) SELECT k.qt AS query_transcript, k.tt AS target_transcript, k.cid AS cluster_id, count(*) AS cells, true AS path_inside, true AS path_connected "
    "FROM k JOIN rg ON rg.qt = k.qt AND rg.tt = k.tt AND rg.cid = k.cid JOIN n a ON a.t = k.qt AND a.i >= qf AND a.i < qe JOIN n b ON b.t = k.tt AND b.i >= tf AND b.i < te "
    "WHERE (b.i - tf) - (a.i - qf) - (dg + qf - tf) BETWEEN -(band // 2) AND band // 2 GROUP BY ALL"
)
def marked_matrices(spark, sf_dir):
    """Of each aligned region its cells, whether all of the path lies on them, and whether matched cells and steps are as many as the alignment is long."""
    n = nodes_of(spark, sf_dir)
    places = alignment.regions(clusters_held(spark, sf_dir), lengths_of(n), BAND_P)
    rows = alignment.aligned(places, n, BAND_P, 0.01, 0.125).persist()
    key = list(plots.KEYS)
    cells = plots.marked_matrix(alignment.scoring_matrix(places, n, BAND_P, 0.01, 0.125), rows)
    seen = cells.groupBy(*key).agg(F.count("*").alias("cells"), F.count("state").alias("marked"), F.count_if(F.col("state") == "M").alias("matched"))
    steps = F.col("alignment_length")
    about = rows.select(*[F.col(old).alias(new) for new, old in plots.KEYS.items()], steps.alias("steps"), (steps - F.col("gap_bases")).alias("matches"))
    return seen.join(about, key).select(*key, "cells", (F.col("marked") == F.col("steps")).alias("path_inside"), (F.col("matched") == F.col("matches")).alias("path_connected"))


def sides_of(spark, sf_dir) -> DataFrame:
    rows = alignment.with_context(context_rows(spark, sf_dir), meta_of(nodes_of(spark, sf_dir)))
    return report.drawing_sides(rows.withColumn("pair", F.concat_ws(":", "query_id", "target_id", F.col("cluster_id").cast("string"))))


SIDES_SQL = (
    "sd AS (SELECT qt || ':' || tt || ':' || cid AS pair, 'query' AS side, qt AS t, q0 AS s0, q1 AS s1 FROM cl UNION ALL SELECT qt || ':' || tt || ':' || cid, 'target', tt, t0, t1 FROM cl)"
)
PAIRS_SQL = (
    "c AS (SELECT t, k, substr(st, CAST(k + 1 AS INTEGER), 1) AS ch FROM (SELECT t, st, unnest(range(length(st))) AS k FROM m)), "
    "sm AS (SELECT *, sum(CASE ch WHEN '(' THEN 1 WHEN ')' THEN -1 ELSE 0 END) OVER (PARTITION BY t ORDER BY k) AS s FROM c), "
    "a AS (SELECT *, s - least(0, min(s) OVER (PARTITION BY t ORDER BY k)) AS d FROM sm), pl AS (SELECT *, lag(d, 1, 0) OVER (PARTITION BY t ORDER BY k) AS e FROM a), "
    "l AS (SELECT t, k, ch, CASE ch WHEN '(' THEN d ELSE e END AS v FROM pl WHERE ch = '(' OR (ch = ')' AND e > 0)), "
    "x AS (SELECT t, k AS i, ch, lead(k) OVER o AS j, lead(ch) OVER o AS cj FROM l WINDOW o AS (PARTITION BY t, v ORDER BY k)), bp AS (SELECT t, count(*) AS n FROM x WHERE ch = '(' AND cj = ')' GROUP BY t)"
)


@query(
    f"WITH RECURSIVE {FOLD_SQL}, {META_SQL}, {SIDES_SQL} SELECT pair, side, sd.t AS transcript_id, replace(sq, 'T', 'U') AS sequence, st AS structure, s0 AS first, s1 AS last, length(sq) = length(st) AND length(sq) > 0 AS valid FROM sd JOIN m ON m.t = sd.t"
)
def drawing_rows(spark, sf_dir):
    one = F.col("highlights")[0]
    return sides_of(spark, sf_dir).select("pair", "side", "transcript_id", "sequence", "structure", one["start"].alias("first"), one["end"].alias("last"), "valid")


@query(
    f"WITH RECURSIVE {FOLD_SQL}, {META_SQL}, {SIDES_SQL}, {PAIRS_SQL} SELECT pair, side, sd.t AS transcript_id, CAST(greatest(100, least(700, length(st))) AS INTEGER) AS width, CAST(coalesce(bp.n, 0) AS INTEGER) AS arcs, 1 AS marks "
    "FROM sd JOIN m ON m.t = sd.t LEFT JOIN bp ON bp.t = sd.t"
)
def drawings(spark, sf_dir):
    made = report.drawings(sides_of(spark, sf_dir))
    return made.select("pair", "side", "transcript_id", "width", "arcs", (F.size(F.split("svg", 'stroke-width="4"')) - 1).alias("marks"))
