"""Whole searches: each step is a function from frames to frames, so a plan is one lazy graph but for what the driver must know."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandseek.operators import alignment, cluster, diagnostics, knn, seeds, stats, windows
from strandseek.params import SearchParams
from strandseek.schema import empty
from strandseek.sources.tables import first_of_each, missing_ids

#: Columns of the result table, in order; the context columns follow where there is metadata.
CORE = (
    "query_id", "target_id", "cluster_id", "score", "query_start", "query_end", "target_start", "target_end", "alignment_length", "avg_cosine",
    "gap_opens", "gap_bases", "seed_count", "max_seed_similarity", "bit_score", "evalue",
)
DIAGONALS = ("diagonal_median", "diagonal_min", "diagonal_max", "diagonal_span", "band_width")


@dataclass
class Result:
    """The tables of a search."""

    queries: DataFrame
    database: DataFrame
    seeds: DataFrame
    members: DataFrame
    clusters: DataFrame
    alignments: DataFrame
    evd: DataFrame | None
    #: One row: how many alignments, the background, lambda and K.
    stats: DataFrame
    #: Frames that are kept while the result is in use.
    held: tuple[DataFrame, ...]

    def release(self) -> None:
        for df in self.held:
            df.unpersist()


def background_of(nodes: DataFrame, p: SearchParams, evd: DataFrame | None) -> tuple[float, float]:
    if evd is not None:
        return tuple(evd.select("background_mu", "background_sigma").first())
    return (0.0, 1.0) if nodes.isEmpty() else tuple(stats.background(nodes, p.background_samples, p.seed).first())


def checked(clusters: DataFrame, nodes: DataFrame, shown: int = 20) -> DataFrame:
    """The clusters, if all their transcripts have nodes."""
    ids = clusters.select(F.col("query_transcript").alias("id")).union(clusters.select("target_transcript")).distinct()
    if missing := [r["id"] for r in missing_ids(nodes, ids).orderBy("id").limit(shown).collect()]:
        raise ValueError(f"no nodes of {', '.join(missing)}")
    return clusters


def align_only(clusters: DataFrame, nodes: DataFrame, p: SearchParams, meta: DataFrame | None = None, evd: DataFrame | None = None) -> DataFrame:
    """Alignments of given clusters, the best of each query, with context where there is metadata. Ids without nodes are an error."""
    return aligned_clusters(checked(clusters, nodes), nodes, p, meta, evd, *background_of(nodes, p, evd))


def aligned_clusters(clusters: DataFrame, nodes: DataFrame, p: SearchParams, meta: DataFrame | None, evd: DataFrame | None, mu: float, sigma: float) -> DataFrame:
    lengths = nodes.groupBy("transcript_id").agg(F.count("*").cast("int").alias("length"))
    places = alignment.regions(clusters, lengths, p)
    rows = alignment.aligned(places, nodes, p, mu, sigma)
    about = places.select(
        F.col("query_transcript").alias("query_id"), F.col("target_transcript").alias("target_id"), "cluster_id", "seed_count", F.col("max_similarity").alias("max_seed_similarity"),
        F.col("diagonal").alias("diagonal_median"), "diagonal_min", "diagonal_max", "diagonal_span", F.col("band").alias("band_width"), "diagonal_offset",
    )
    rows = alignment.top_n(rows, p.top_n).join(about, ["query_id", "target_id", "cluster_id"])
    rows = alignment.scored(rows, lengths, evd, p)
    if meta is None:
        return rows.select(*CORE, *DIAGONALS, "diagonal_offset", "trace")
    rows = alignment.with_strings(alignment.with_context(rows, first_rows(meta)))
    context = [f"{s}_{k}{r}" for k in ("sequence", "structure") for r in ("", "_region") for s in ("query", "target")]
    shown = ["aligned_query_structure", "aligned_target_structure", "aligned_query_sequence", "aligned_target_sequence", "alignment_mask", "alignment_content"]
    return rows.select(*CORE, *context, *shown, *DIAGONALS, "diagonal_offset", "trace")


def first_rows(meta: DataFrame) -> DataFrame:
    """The metadata with the first row of each id, in the order of the source."""
    return first_of_each(meta.withColumn("source_row", F.monotonically_increasing_id()), "transcript_id", F.col("source_row")).drop("source_row")


def search(nodes: DataFrame, queries: DataFrame, p: SearchParams, meta: DataFrame | None = None, structure: str = "secondary_structure", evd: dict | None = None) -> Result:
    """From nodes and query ids to alignments. Node and window tables are kept, as later steps read them again."""
    nodes = nodes.persist()
    meta = None if meta is None else first_rows(meta)
    rows = windows.windows(nodes, p.window_size, p.stride, p.normalize, meta, structure, p.max_unpaired)
    asked, database = windows.split_queries(rows, queries)
    asked, database = windows.renumbered(asked).persist(), database.persist()
    if asked.isEmpty() or database.isEmpty():
        hits = empty(nodes.sparkSession, knn.HITS).drop("exact").withColumns({"rank": F.lit(0), "similarity": F.lit(0.0)})
    else:
        hits = knn.neighbours(asked, database, p)
    found = seeds.seeds(hits, p.threshold).persist()
    members = cluster.members(found, p).persist()
    groups = cluster.clusters(members).persist()
    params = stats.evd_params(nodes, p, evd) if p.evalue and not nodes.isEmpty() else None
    mu, sigma = background_of(nodes, p, params)
    best = aligned_clusters(groups, nodes, p, meta, params, mu, sigma)
    return Result(asked, database, found, members, groups, best, params, alignment.alignment_stats(best, mu, sigma, params), (nodes, asked, database, found, members, groups))


def diagnose(rows: DataFrame, key: str, label: str | None = None) -> dict[str, DataFrame]:
    """Tables that describe window vectors."""
    part = diagnostics.sample(rows, key).persist()
    cosines = diagnostics.pair_cosines(part, key).persist()
    out = {"norms": diagnostics.norm_stats(part), "cosines": diagnostics.cosine_stats(cosines), "histogram": diagnostics.histogram(cosines, "cosine", -1, 1)}
    out["components"], _ = diagnostics.principal_components(part, key)
    if label:
        out["dispersion"] = diagnostics.tightest(diagnostics.label_dispersion(part, label), label=label)
    return out
