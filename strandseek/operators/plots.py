"""Scoring matrices as tables: the cells of a region with the alignment's path among them, and what stands on and around the chart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandseek.functions.scores import safe_filename

#: How regions name an alignment's columns.
KEYS = {"query_transcript": "query_id", "target_transcript": "target_id", "cluster_id": "cluster_id"}


def path_cells(alignments: DataFrame) -> DataFrame:
    """query_id, target_id, cluster_id, step (from 0), state, query_pos, target_pos of all steps; a gap stays at the other side's last place."""
    steps = alignments.select(*KEYS.values(), F.posexplode("trace").alias("step", "x")).select(*KEYS.values(), "step", "x.*")
    so_far = Window.partitionBy(*KEYS.values()).orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True).over(so_far).alias(c)
    return steps.select(*KEYS.values(), "step", "state", last("query_pos"), last("target_pos"))


def marked_matrix(cells: DataFrame, alignments: DataFrame) -> DataFrame:
    """The cells of ``scoring_matrix`` with ``state``, what the alignment's path does there, null beside the path."""
    path = path_cells(alignments).select(*[F.col(old).alias(new) for new, old in KEYS.items()], "query_pos", "target_pos", "state")
    return cells.join(path, [*KEYS, "query_pos", "target_pos"], "left")


def matrix_plots(alignments: DataFrame, places: DataFrame) -> DataFrame:
    """One row an alignment: its rank within the query, a file name, title and caption of the chart, the region's rectangle and the path's points.

    places: the regions of the clusters, with the transcripts' lengths, which are the chart's extent.
    """
    about = places.select(
        *[F.col(new).alias(old) for new, old in KEYS.items()], "query_length", "target_length", F.col("query_from").alias("region_query_start"), F.col("query_to").alias("region_query_end"),
        F.col("target_from").alias("region_target_start"), F.col("target_to").alias("region_target_end"), F.col("diagonal").alias("its_diagonal"), F.col("diagonal_span").alias("its_span"), F.col("band").alias("its_band"),
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "target_id", "cluster_id"))
    rows = alignments.select(*KEYS.values(), "score", "trace").withColumn("rank", rank).join(about, [*KEYS.values()])
    name = F.format_string("rank_%02d_%s_vs_%s_cluster_%d_score_%.2f", "rank", safe_filename(F.col("query_id")), safe_filename(F.col("target_id")), "cluster_id", "score")
    title = F.format_string("Rank %d: %s vs %s (cluster %d)", "rank", "query_id", "target_id", "cluster_id")
    caption = F.concat_ws(
        " | ",
        F.format_string("Score %.3f", "score"),
        F.format_string("Q[%d,%d) vs T[%d,%d)", "region_query_start", "region_query_end", "region_target_start", "region_target_end"),
        F.format_string("Diagonal μ %d, span %d", "its_diagonal", "its_span"),
        F.format_string("Band %d", "its_band"),
    )
    points = path_cells(alignments).groupBy(*KEYS.values()).agg(F.sort_array(F.collect_list(F.struct("step", F.col("target_pos").alias("x"), F.col("query_pos").alias("y")))).alias("steps"))
    rows = rows.withColumns({"name": safe_filename(name), "title": title, "caption": caption}).join(points, [*KEYS.values()], "left")
    ticks = lambda n: F.when(F.col(n) > 1, F.array(F.lit(0), F.col(n) - 1)).otherwise(F.array(F.lit(0)))
    return rows.select(
        *KEYS.values(), "rank", "name", "title", "caption", "region_query_start", "region_query_end", "region_target_start", "region_target_end",
        ticks("query_length").alias("query_ticks"), ticks("target_length").alias("target_ticks"), points_of(F.col("steps")).alias("points"),
    )


def points_of(steps: Column) -> Column:
    return F.transform(steps, lambda s: F.struct(s["x"].alias("x"), s["y"].alias("y")))
