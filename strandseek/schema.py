"""Schemas of the engine's tables, as DDL; an empty result has its table's schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

NODES = "transcript_id string, node_index int, embedding array<float>"
WINDOWS = "transcript_id string, window_index int, window_start int, window_end int, window_size int, transcript_length int, vector array<float>"
SEEDS = (
    "query_transcript string, target_transcript string, query_window_start int, query_window_end int, target_window_start int, target_window_end int, "
    "query_window_index int, target_window_index int, similarity double, rank int, diagonal int"
)
MEMBERS = f"cluster_id int, {SEEDS}"
CLUSTERS = (
    "cluster_id int, query_transcript string, target_transcript string, diagonal int, seed_count int, query_start int, query_end int, target_start int, "
    "target_end int, max_similarity double, diagonal_min int, diagonal_max int, diagonal_span int"
)
TRACE = "array<struct<state:string,query_pos:int,target_pos:int>>"
ALIGNED = (
    "query_id string, target_id string, cluster_id int, score double, query_start int, query_end int, target_start int, target_end int, "
    f"alignment_length int, avg_cosine double, gap_opens int, gap_bases int, trace {TRACE}"
)


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], ddl)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """The frame itself, if it has the columns."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}; there are {', '.join(df.columns)}")
    return df
