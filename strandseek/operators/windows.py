"""Sliding windows over the nodes of each transcript."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandseek.functions.scores import unpaired_share
from strandseek.functions.vectors import norm, unit
from strandseek.schema import require


def keeps_structure(structure: Column, start: Column, size: int, most: float | None) -> Column:
    """Strictly fewer unpaired nodes than the limit; without limit or structure, or past its end, a window stays."""
    if most is None:
        return F.lit(True)
    if not 0 <= most <= 1:
        raise ValueError("max_unpaired must lie in [0, 1]")
    unknown = structure.isNull() | (structure == "") | (start + size > F.length(structure))
    return unknown | (unpaired_share(structure, start, size) < most)


def enumerated(nodes: DataFrame, size: int, stride: int = 1) -> DataFrame:
    """All windows before any filter, with their parts: places are counted in node order, so gaps in node_index close."""
    by = Window.partitionBy("transcript_id").orderBy("node_index")
    frame = by.rowsBetween(0, size - 1)
    rows = nodes.select(
        "transcript_id",
        (F.row_number().over(by) - 1).alias("window_start"),
        F.collect_list("embedding").over(frame).alias("parts"),
        F.count(F.lit(1)).over(Window.partitionBy("transcript_id")).cast("int").alias("transcript_length"),
    )
    rows = rows.where((F.size("parts") == size) & (F.col("window_start") % stride == 0))
    return rows.withColumn("window_index", (F.col("window_start") / stride).cast("int"))


def windows(nodes: DataFrame, size: int, stride: int = 1, normalize: bool = True, meta: DataFrame | None = None, structure: str = "secondary_structure", max_unpaired: float | None = None) -> DataFrame:
    """transcript_id, window_index, window_start, window_end, window_size, transcript_length, vector.

    window_index counts the windows before the structure filter. One shuffle by transcript serves all window functions.
    """
    rows = enumerated(require(nodes, "transcript_id", "node_index", "embedding"), size, stride)
    if meta is not None and max_unpaired is not None:
        rows = rows.join(meta.select("transcript_id", F.col(structure).alias("structure")), "transcript_id", "left")
        rows = rows.where(keeps_structure(F.col("structure"), F.col("window_start"), size, max_unpaired))
    flat = F.flatten("parts")
    return rows.select(
        "transcript_id",
        "window_index",
        "window_start",
        (F.col("window_start") + size).alias("window_end"),
        F.lit(size).alias("window_size"),
        "transcript_length",
        (unit(flat) if normalize else flat).alias("vector"),
    )


def split_queries(rows: DataFrame, ids: DataFrame, column: str = "transcript_id") -> tuple[DataFrame, DataFrame]:
    """(queries, database): rows whose transcript is asked for, and all others."""
    asked = ids.select(F.col("id").alias(column))
    return rows.join(asked, column, "left_semi"), rows.join(asked, column, "left_anti")


def renumbered(queries: DataFrame) -> DataFrame:
    """Query windows counted anew, from 0 within each transcript, without the gaps of filtered ones."""
    place = F.row_number().over(Window.partitionBy("transcript_id").orderBy("window_start")) - 1
    return queries.withColumn("window_index", place.cast("int"))


def window_norms(rows: DataFrame) -> DataFrame:
    return rows.select("transcript_id", "window_start", norm("vector").alias("norm"))


def window_stats(nodes: DataFrame, queries: DataFrame, kept: DataFrame, size: int, stride: int = 1) -> DataFrame:
    """One row: transcripts, those long enough, queries, and windows possible, kept and filtered, in all and by side."""
    lengths = nodes.groupBy("transcript_id").agg(F.count("*").alias("n"))
    possible = F.when(F.col("n") >= size, F.floor((F.col("n") - size) / stride) + 1).otherwise(0)
    all_ = lengths.agg(
        F.count("*").alias("transcripts"), F.sum((F.col("n") >= size).cast("int")).alias("long_enough"), F.coalesce(F.sum(possible), F.lit(0)).alias("possible_windows")
    )
    asked = queries.select(F.col("id").alias("q")).distinct()
    sides = kept.join(asked, kept["transcript_id"] == asked["q"], "left").agg(
        F.count("*").alias("kept_windows"), F.count("q").alias("query_windows"), (F.count("*") - F.count("q")).alias("database_windows")
    )
    n = asked.agg(F.count("*").alias("queries"))
    return all_.crossJoin(n).crossJoin(sides).withColumn("filtered_windows", F.col("possible_windows") - F.col("kept_windows"))


def merge_chunks(chunks: list[DataFrame], same: tuple[str, ...] = ()) -> DataFrame:
    """All rows of chunks with the same columns; columns in ``same`` must have one value over all of them."""
    if not chunks:
        raise ValueError("no chunks")
    for c in chunks[1:]:
        if c.columns != chunks[0].columns:
            raise ValueError(f"chunk columns differ: {c.columns} and {chunks[0].columns}")
    out = reduce(DataFrame.unionByName, chunks)
    for name in same:
        if out.select(name).distinct().count() > 1:
            raise ValueError(f"chunks differ in {name}")
    return out


def merge_stats(chunks: list[DataFrame]) -> DataFrame:
    """Chunk statistics added up; the number of queries is the same in all chunks, not a sum."""
    out = merge_chunks(chunks)
    return out.agg(*[(F.max(c) if c == "queries" else F.sum(c)).alias(c) for c in out.columns])


@dataclass
class Chunk:
    """The windows of a part of the database: vectors of both sides and one row of statistics (those of ``window_stats``, window_size, stride)."""

    chunk_id: str
    database: DataFrame
    queries: DataFrame
    stats: DataFrame


def merge_windows(chunks: list[Chunk]) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(database, queries, chunks, total): all windows of both sides, where each chunk's begin (by chunk id), and the statistics added up.

    Chunk ids must differ and be those of the statistics, which must count the windows that are there; dimension,
    window size and stride must be the same in all chunks. What reaches the driver is a row a chunk.
    """
    if not chunks:
        raise ValueError("no chunks")
    chunks = sorted(chunks, key=lambda c: c.chunk_id)
    ids = [c.chunk_id for c in chunks]
    if len(set(ids)) < len(ids):
        raise ValueError(f"repeated chunk ids: {sorted({x for x in ids if ids.count(x) > 1})}")
    database, queries = merge_chunks([c.database for c in chunks]), merge_chunks([c.queries for c in chunks])
    said = [c.stats.withColumn("of", F.lit(c.chunk_id)) for c in chunks]
    said = {r["of"]: r for r in reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), said).collect()}
    sides = [s.select(F.lit(c.chunk_id).alias("of"), F.lit(k).alias("side"), F.size("vector").alias("d")) for c in chunks for k, s in (("database", c.database), ("query", c.queries))]
    there = reduce(DataFrame.unionByName, sides).groupBy("of", "side").agg(F.count("*").alias("n"), F.min("d").alias("low"), F.max("d").alias("high")).collect()
    count = {(r["of"], r["side"]): r["n"] for r in there}
    for c in ids:
        if said[c].asDict().get("chunk_id") not in (None, c):
            raise ValueError(f"the statistics of chunk {c} says it is chunk {said[c]['chunk_id']}")
        for side in ("database", "query"):
            if (n := said[c][f"{side}_windows"]) != count.get((c, side), 0):
                raise ValueError(f"the statistics of chunk {c} says {n} {side} windows, there are {count.get((c, side), 0)}")
    for name in ("window_size", "stride"):
        if len({said[c][name] for c in ids}) > 1:
            raise ValueError(f"chunks differ in {name}")
    if len(dimension := {x for r in there for x in (r["low"], r["high"])}) > 1:
        raise ValueError(f"chunks differ in dimension: {sorted(dimension)}")
    first, rows = {"database": 0, "query": 0}, []
    for c in ids:
        rows.append((c, *(x for side in ("database", "query") for x in (first[side], count.get((c, side), 0)))))
        for side in first:
            first[side] += count.get((c, side), 0)
    spark = database.sparkSession
    placed = spark.createDataFrame(rows, "chunk_id string, database_first long, database_windows long, query_first long, query_windows long")
    summed = [n for n in ("transcripts", "long_enough", "possible_windows", "kept_windows", "query_windows", "database_windows", "filtered_windows") if n in said[ids[0]].asDict()]
    total = [sum(said[c][n] for c in ids) for n in summed]
    row = (*total, max(said[c]["queries"] for c in ids), said[ids[0]]["window_size"], said[ids[0]]["stride"], max(dimension, default=0), len(ids))
    ddl = ", ".join([*(f"{n} long" for n in summed), "queries long, window_size int, stride int, dimension int, chunks int"])
    return database, queries, placed, spark.createDataFrame([row], ddl)
