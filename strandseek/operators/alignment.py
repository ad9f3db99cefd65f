"""Alignment of clusters: regions, bands, the kernel, statistics, context strings and the best of each query."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from strandseek.functions.scores import adaptive_band, bit_score, cell_score, e_value
from strandseek.functions.vectors import dot
from strandseek.operators.kernel import NAMES, X, Y, align, summary
from strandseek.operators.places import fetched, places_between
from strandseek.operators.stats import scoring
from strandseek.params import SearchParams
from strandseek.schema import ALIGNED, TRACE, empty


def regions(clusters: DataFrame, lengths: DataFrame, p: SearchParams) -> DataFrame:
    """Adds the padded stretches of both transcripts, the band, and the diagonal's offset between the stretches.

    Clusters of transcripts without nodes go, as do none else: lengths is transcript_id, length.
    """
    out = clusters
    for side in ("query", "target"):
        out = out.join(lengths.select(F.col("transcript_id").alias(f"{side}_transcript"), F.col("length").alias(f"{side}_length")), f"{side}_transcript")
        out = out.withColumn(f"{side}_from", F.greatest(F.lit(0), F.col(f"{side}_start") - p.padding)).withColumn(f"{side}_to", F.least(F.col(f"{side}_length"), F.col(f"{side}_end") + p.padding))
    out = out.withColumn("diagonal_offset", F.col("diagonal") + F.col("query_from") - F.col("target_from"))
    return out.withColumn("band", adaptive_band(F.col("diagonal_span"), p.band_width, p.band_buffer, p.band_cap))


#: Places (about 40 bytes each) that are broadcast at most.
BROADCAST_PLACES = 500_000
#: What an alignment needs of a region beside its vectors.
REGION = ("query_transcript", "target_transcript", "cluster_id", "query_from", "target_from", "band", "diagonal_offset")


def with_vectors(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The columns of ``REGION`` and the vectors of both stretches of regions.

    Places of the stretches are joined with the nodes, so only their vectors are collected. Up to ``BROADCAST_PLACES``
    places are broadcast to the nodes, whose vectors then stay where they are unless they are wanted; of more places the
    nodes are joined by a shuffle. A region without nodes on either side goes.
    """
    reach = sum((F.sum(F.col(f"{s}_to") - F.col(f"{s}_from")) for s in ("query", "target")), F.lit(0))
    few = (rows.agg(reach).first()[0] or 0) <= BROADCAST_PLACES
    sides = [rows.select(*REGION, F.lit(s).alias("side"), F.col(f"{s}_transcript").alias("transcript_id"), F.explode(places_between(F.col(f"{s}_from"), F.col(f"{s}_to"))).alias("at")) for s in ("query", "target")]
    each = sides[0].unionByName(sides[1])
    found = each.join(fetched(nodes, each, few), ["transcript_id", "at"])
    of = lambda s: F.sort_array(F.collect_list(F.when(F.col("side") == s, F.struct("at", "embedding"))))["embedding"].alias(f"{s}_vectors")
    return found.groupBy(*REGION).agg(of("query"), of("target")).where("size(query_vectors) > 0 AND size(target_vectors) > 0")


def stacked(column: pa.Array) -> list[np.ndarray]:
    """The matrix of each row of a column of lists of vectors, as views of the column's own numbers."""
    inner = column.flatten()
    if not len(inner):
        return [np.zeros((0, 0))] * len(column)
    x = inner.flatten().to_numpy(zero_copy_only=False).reshape(len(inner), -1)
    return np.split(x, np.cumsum(column.value_lengths().to_numpy())[:-1])


def scoring_matrix(rows: DataFrame, nodes: DataFrame, p: SearchParams, mu: float, sigma: float) -> DataFrame:
    """The cells inside the bands of regions: query_transcript, target_transcript, cluster_id, query_pos, target_pos, score.

    A drawing of a scoring matrix is a chart of these rows.
    """
    a = with_vectors(rows, nodes).select(*REGION, "target_vectors", F.posexplode("query_vectors").alias("i", "q"))
    half = F.floor(F.greatest(F.col("band"), F.lit(1)) / 2).cast("int")
    low = F.greatest(F.lit(0), F.col("i") + F.col("diagonal_offset") - half)
    wide = F.least(F.size("target_vectors"), F.col("i") + F.col("diagonal_offset") + half + 1) - low
    b = a.withColumn("low", low).withColumn("part", F.slice("target_vectors", F.col("low") + 1, F.greatest(F.lit(0), wide))).drop("target_vectors")
    b = b.select("*", F.posexplode("part").alias("j", "t"))
    score = cell_score(dot("q", "t"), F.lit(mu), F.lit(sigma), p.gamma, p.score_min, p.score_max)
    return b.select("query_transcript", "target_transcript", "cluster_id", (F.col("query_from") + F.col("i")).alias("query_pos"), (F.col("target_from") + F.col("low") + F.col("j")).alias("target_pos"), score.alias("score"))


def aligned(rows: DataFrame, nodes: DataFrame, p: SearchParams, mu: float, sigma: float) -> DataFrame:
    """Aligns each region: coordinates on the transcripts, score, mean cosine, gaps and the trace. Scores of 0 go.

    Only the stretches are shipped, and the work is dealt by cluster.
    """
    rule, compat = scoring(p, mu, sigma, p.xdrop), p.compat_coords
    schema = to_arrow_schema(empty(nodes.sparkSession, ALIGNED).schema)
    names = np.array(list(NAMES))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = b.select(list(REGION)).to_pylist()
            kept, numbers, states, query_places, target_places = [], [], [], [], []
            for k, (r, q, t) in enumerate(zip(each, stacked(b.column("query_vectors")), stacked(b.column("target_vectors")), strict=True)):
                q, t = q.astype(np.float64), t.astype(np.float64)  # of one region at a time
                score, path = align(q, t, rule, r["band"], r["diagonal_offset"])
                if not path or score <= 0:
                    continue
                state, i, j = np.array(path, np.int64).T
                cosine, opens, bases = summary(state, i, j, q, t)
                if compat:  # as if the path began at the stretches' first nodes
                    i, j = np.maximum(1, i - i[0] + 1), np.maximum(1, j - j[0] + 1)
                on_query, on_target = state != X, state != Y
                at, to = r["query_from"] + i - 1, r["target_from"] + j - 1
                kept.append(k)
                ends = (at[on_query].min(), at[on_query].max() + 1, to[on_target].min(), to[on_target].max() + 1)
                numbers.append((score, *map(int, ends), len(path), cosine, opens, bases))
                states.append(state)
                query_places.append(pa.array(at, pa.int32(), mask=~on_query))
                target_places.append(pa.array(to, pa.int32(), mask=~on_target))
            if not kept:
                continue
            places = [pa.concat_arrays(x) for x in (query_places, target_places)]
            steps = pa.StructArray.from_arrays([pa.array(names[np.concatenate(states)]), *places], names=["state", "query_pos", "target_pos"])
            edges = np.concatenate(([0], np.cumsum([len(x) for x in states]))).astype(np.int32)
            ids = [b.column(c).take(pa.array(kept)) for c in REGION[:3]]
            yield pa.RecordBatch.from_arrays([*ids, *(pa.array([x[c] for x in numbers], schema.types[c + 3]) for c in range(9)), pa.ListArray.from_arrays(pa.array(edges), steps).cast(schema.types[-1])], schema=schema)

    rows = with_vectors(rows, nodes).repartition("query_transcript", "target_transcript", "cluster_id")
    return rows.mapInArrow(run, ALIGNED)


def scored(alignments: DataFrame, lengths: DataFrame, evd: DataFrame | None, p: SearchParams) -> DataFrame:
    """Adds bit_score and evalue, null without statistics; the lengths are those of the whole transcripts."""
    if evd is None or not p.evalue:
        return alignments.withColumns({"bit_score": F.lit(None).cast("double"), "evalue": F.lit(None).cast("double")})
    row = evd.select("evd_lambda", "evd_K").first()
    lam, k = F.lit(row[0]), F.lit(row[1])
    out = alignments.join(lengths.select(F.col("transcript_id").alias("query_id"), F.col("length").alias("m")), "query_id", "left")
    if p.search_space == "database":
        out = out.withColumn("n", F.lit(lengths.agg(F.sum("length")).first()[0]))
    else:
        out = out.join(lengths.select(F.col("transcript_id").alias("target_id"), F.col("length").alias("n")), "target_id", "left")
    m, n = F.coalesce("m", F.lit(0)), F.coalesce("n", F.lit(0))
    return out.withColumn("bit_score", bit_score(F.col("score"), lam, k)).withColumn("evalue", e_value(F.col("score"), lam, k, m, n)).drop("m", "n")


def top_n(alignments: DataFrame, n: int) -> DataFrame:
    """The n best of each query; none for 0; for a negative n all but the -n worst. Ties by target and cluster."""
    order = [F.desc("score"), F.col("target_id"), F.col("cluster_id")]
    if n >= 0:
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
        return alignments.withColumn("place", place).where(F.col("place") <= n).drop("place")
    worst = F.row_number().over(Window.partitionBy("query_id").orderBy(F.asc("score"), F.desc("target_id"), F.desc("cluster_id")))
    return alignments.withColumn("place", worst).where(F.col("place") > -n).drop("place")


def sequence_columns(columns: list[str], sequence: str | None = None, structure: str | None = None) -> tuple[str | None, str | None]:
    """The first columns with "sequence" and "struct" in their names, where none are given."""
    pick = lambda given, part: given or next((c for c in columns if part in c.lower()), None)
    return pick(sequence, "sequence"), pick(structure, "struct")


def with_context(alignments: DataFrame, meta: DataFrame, sequence: str | None = None, structure: str | None = None) -> DataFrame:
    """Adds whole sequences and structures of both transcripts, and their aligned stretches."""
    named = sequence_columns([c for c in meta.columns if c != "transcript_id"], sequence, structure)
    out = alignments
    for side in ("query", "target"):
        chosen = [(F.col(c) if c else F.lit(None).cast("string")).alias(f"{side}_{kind}") for c, kind in zip(named, ("sequence", "structure"), strict=True)]
        out = out.join(meta.select(F.col("transcript_id").alias(f"{side}_id"), *chosen), f"{side}_id", "left")
        for kind in ("sequence", "structure"):
            stretch = F.substring(F.col(f"{side}_{kind}"), F.col(f"{side}_start") + 1, F.col(f"{side}_end") - F.col(f"{side}_start"))
            out = out.withColumn(f"{side}_{kind}_region", stretch)
    return out


def strings(trace: Column, query: Column, target: Column) -> tuple[Column, Column, Column]:
    """Both rows of an alignment and the mask between them; a place beyond a string is N."""
    at = lambda text, pos: F.when(pos < F.length(text), F.substring(text, pos + 1, F.lit(1))).otherwise(F.lit("N"))
    upper = F.transform(trace, lambda x: F.when(x["state"] == "X", F.lit("-")).otherwise(at(query, x["query_pos"])))
    lower = F.transform(trace, lambda x: F.when(x["state"] == "Y", F.lit("-")).otherwise(at(target, x["target_pos"])))
    mask = F.transform(trace, lambda x: F.when(x["state"] == "M", F.lit("|")).otherwise(F.lit(" ")))
    return tuple(F.array_join(x, "") for x in (upper, lower, mask))


def with_strings(rows: DataFrame) -> DataFrame:
    """Adds alignment_content (structure if both have one, else sequence), and the aligned strings of that kind with their mask."""
    has = lambda kind: (F.length(f"query_{kind}") > 0) & (F.length(f"target_{kind}") > 0)
    content = F.when(F.coalesce(has("structure"), F.lit(False)), "structure").when(F.coalesce(has("sequence"), F.lit(False)), "sequence")
    out, masks = rows.withColumn("alignment_content", content), []
    for kind in ("structure", "sequence"):
        upper, lower, mask = strings(F.col("trace"), F.col(f"query_{kind}"), F.col(f"target_{kind}"))
        mine = F.col("alignment_content") == kind
        out = out.withColumn(f"aligned_query_{kind}", F.when(mine, upper)).withColumn(f"aligned_target_{kind}", F.when(mine, lower))
        masks.append(F.when(mine, mask))
    return out.withColumn("alignment_mask", F.coalesce(*masks))


def traces(rows: DataFrame) -> DataFrame:
    """The nested record of each alignment: its ends, diagonal, band and trace."""
    ends = lambda q, t: F.struct(F.col(q).alias("query"), F.col(t).alias("target"))
    diagonal = F.struct(F.col("diagonal_median").alias("median"), F.col("diagonal_min").alias("min"), F.col("diagonal_max").alias("max"), F.col("diagonal_span").alias("span"), F.col("diagonal_offset").alias("offset"))
    return rows.select("query_id", "target_id", "cluster_id", "score", ends("query_start", "target_start").alias("alignment_start"), ends("query_end", "target_end").alias("alignment_end"), diagonal.alias("diagonal"), "band_width", F.col("trace").cast(TRACE).alias("trace"))


def alignment_stats(rows: DataFrame, mu: float, sigma: float, evd: DataFrame | None) -> DataFrame:
    """One row: alignments, the background and lambda and K."""
    lam, k = evd.select("evd_lambda", "evd_K").first() if evd is not None else (None, None)
    return rows.agg(F.count("*").alias("alignments")).select("alignments", F.lit(mu).alias("background_mu"), F.lit(sigma).alias("background_sigma"), F.lit(lam).cast("double").alias("evd_lambda"), F.lit(k).cast("double").alias("evd_K"))
