"""Nodes by their place on a transcript: what is wanted is narrowed down before any vector moves.

A node's place is how many nodes of its transcript come before it, so gaps in node_index close. Places
are counted over ids and indexes alone, of the transcripts that are asked for; vectors are then joined
by id and index. Indexes are taken to be unique within a transcript.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ids that one task numbers, about.
NUMBERED = 1_000_000
#: Sampled ids for each boundary between tasks.
DRAWN = 32


def placed(nodes: DataFrame) -> DataFrame:
    """transcript_id, node_index and at, the place."""
    at = F.row_number().over(Window.partitionBy("transcript_id").orderBy("node_index")) - 1
    return nodes.select("transcript_id", "node_index").withColumn("at", at)


def fetched(nodes: DataFrame, wanted: DataFrame, bounded: bool = False) -> DataFrame:
    """transcript_id, at, embedding of the wanted places (transcript_id, at); ``bounded``: a parameter bounds how many, so they may be broadcast."""
    hint = F.broadcast if bounded else lambda df: df
    wanted = wanted.select("transcript_id", "at").distinct()
    ids = wanted.select("transcript_id").distinct()
    known = placed(nodes.select("transcript_id", "node_index").join(hint(ids), "transcript_id", "left_semi"))
    named = known.join(hint(wanted), ["transcript_id", "at"], "left_semi")
    return nodes.select("transcript_id", "node_index", "embedding").join(hint(named), ["transcript_id", "node_index"]).select("transcript_id", "at", "embedding")


def places_between(first: Column, last: Column) -> Column:
    """An array of the places from first up to last, last excluded; empty if there are none."""
    return F.when(last > first, F.sequence(first, last - 1)).otherwise(F.array().cast("array<int>"))


def numbered(ids: DataFrame, about: int = NUMBERED) -> DataFrame:
    """ids with their place among all in the order of transcript_id, from 0.

    Boundaries drawn by hash cut the ids into ranges of about so many; a range is numbered by one task, after as many
    as the ranges before it hold. The number of boundaries follows the number of ids, and the numbers don't depend on them.
    """
    parts = ids.count() // about + 1
    drawn = [r[0] for r in ids.select("transcript_id", F.xxhash64("transcript_id").alias("h")).orderBy("h", "transcript_id").limit(DRAWN * parts if parts > 1 else 0).collect()]
    bounds = sorted(drawn)[DRAWN - 1 :: DRAWN] if parts > 1 else []
    part = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]).cast("array<string>"), lambda b: b <= F.col("transcript_id")))
    rows = ids.withColumn("part", part)
    before, total = [], 0
    for r in rows.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():  # as many rows as boundaries, and one
        before.append((r["part"], total))
        total += r["n"]
    start = F.broadcast(ids.sparkSession.createDataFrame(before, "part int, start long"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("transcript_id")) - 1
    return rows.withColumn("place", place).join(start, "part").withColumn("place", (F.col("start") + F.col("place")).cast("long")).drop("part", "start")
