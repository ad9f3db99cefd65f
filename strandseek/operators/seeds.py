"""Seeds: neighbours above the threshold, on their diagonals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS = (
    "query_transcript", "target_transcript", "query_window_start", "query_window_end", "target_window_start", "target_window_end",
    "query_window_index", "target_window_index", "similarity", "rank", "diagonal",
)


def without_self(hits: DataFrame) -> DataFrame:
    """Drops hits of a transcript on itself; ranks stay as they were."""
    return hits.where(F.col("query_transcript") != F.col("target_transcript"))


def above(hits: DataFrame, threshold: float | Column) -> DataFrame:
    return hits.where(F.col("similarity") >= threshold)


def seeds(hits: DataFrame, threshold: float) -> DataFrame:
    rows = without_self(above(hits, threshold))
    return rows.withColumn("diagonal", F.col("target_window_start") - F.col("query_window_start")).select(*COLUMNS)


def seed_stats(rows: DataFrame, queries: DataFrame, k: int, threshold: float, rescored: bool) -> DataFrame:
    """One row a query transcript: its windows, the seeds kept, and the settings."""
    n = queries.groupBy(F.col("transcript_id").alias("query_transcript")).agg(F.count("*").alias("windows"))
    kept = rows.groupBy("query_transcript").agg(F.count("*").alias("seeds_kept"))
    return n.join(kept, "query_transcript", "left").select(
        "query_transcript", "windows", F.coalesce("seeds_kept", F.lit(0)).alias("seeds_kept"), F.lit(k).alias("top_k"), F.lit(threshold).alias("threshold"), F.lit(rescored).alias("rescored")
    )
