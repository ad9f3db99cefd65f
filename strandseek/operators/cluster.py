"""Clusters of seeds that follow one another on about the same diagonal.

The state of the fold, the least and greatest diagonal since the last cut, depends on where that cut
was, so no window function expresses it. It runs once for each pair of transcripts, in numpy-free
Python over columns; pairs are independent, and the rest is plain aggregation.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandseek.operators.seeds import COLUMNS
from strandseek.params import SearchParams
from strandseek.schema import require


def fold(starts: list[int], targets: list[int], span: int, tolerance: int, most: int) -> list[int]:
    """A running number for each seed (in order): it grows where a seed does not continue the open cluster."""
    out, number = [], -1
    last_q = last_t = low = high = 0
    for q, t in zip(starts, targets, strict=True):
        d = t - q
        goes_on = number >= 0 and q - last_q <= span and t - last_t <= span and low - tolerance <= d <= high + tolerance
        if goes_on and most > 0:
            goes_on = max(high, d) - min(low, d) <= most
        if goes_on:
            low, high = min(low, d), max(high, d)
        else:
            number += 1
            low = high = d
        last_q, last_t = q, t
        out.append(number)
    return out


def members(seeds: DataFrame, p: SearchParams) -> DataFrame:
    """The seeds of kept clusters with cluster_id, which counts from 0 within a query, over targets in order."""
    require(seeds, *COLUMNS)
    span, tolerance, most = p.cluster_span, p.diagonal_tolerance, p.max_diagonal_span
    schema = f"{', '.join(f'{n} {t}' for n, t in seeds.select(*COLUMNS).dtypes)}, run int"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["query_window_start", "target_window_start", "rank"], kind="stable")
        return pdf.assign(run=fold(pdf["query_window_start"].tolist(), pdf["target_window_start"].tolist(), span, tolerance, most))

    runs = seeds.select(*COLUMNS).groupBy("query_transcript", "target_transcript").applyInPandas(run, schema)
    size = F.count("*").over(Window.partitionBy("query_transcript", "target_transcript", "run"))
    kept = runs.withColumn("size", size).where(F.col("size") >= p.min_seeds)
    number = F.dense_rank().over(Window.partitionBy("query_transcript").orderBy("target_transcript", "run")) - 1
    return kept.select(number.cast("int").alias("cluster_id"), *COLUMNS)


def clusters(rows: DataFrame) -> DataFrame:
    """One row a cluster; its diagonal is the median's whole part, towards zero."""
    return rows.groupBy("cluster_id", "query_transcript", "target_transcript").agg(
        F.expr("cast(median(diagonal) as int)").alias("diagonal"),
        F.count("*").cast("int").alias("seed_count"),
        F.min("query_window_start").alias("query_start"),
        F.max("query_window_end").alias("query_end"),
        F.min("target_window_start").alias("target_start"),
        F.max("target_window_end").alias("target_end"),
        F.max("similarity").alias("max_similarity"),
        F.min("diagonal").alias("diagonal_min"),
        F.max("diagonal").alias("diagonal_max"),
        (F.max("diagonal") - F.min("diagonal")).alias("diagonal_span"),
    )


def cluster_stats(seeds: DataFrame, rows: DataFrame) -> DataFrame:
    """One row a query: its seeds, clusters and clustered seeds."""
    n = seeds.groupBy("query_transcript").agg(F.count("*").alias("seeds"))
    m = rows.groupBy("query_transcript").agg(F.countDistinct("cluster_id").alias("clusters"), F.count("*").alias("clustered_seeds"))
    return n.join(m, "query_transcript", "left").select("query_transcript", "seeds", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("clusters", "clustered_seeds")])
