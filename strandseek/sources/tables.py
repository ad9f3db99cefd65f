"""Readers of the pipeline's tables: transcripts, queries, node embeddings, metadata, vectors, parameters."""

from __future__ import annotations

import io
import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandseek.schema import require

#: Names that the order of a node may have, first found first.
ORDER_COLUMNS = ("node_index", "position", "idx", "node_idx", "node_position")
VECTOR_PREFIXES = ("emb", "gin", "feat_")


def delimiter(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return "\t" if "." not in name or name.rsplit(".", 1)[-1].lower() in ("tsv", "txt") else ","


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A headered text table, by suffix tab- or comma-separated, all strings, cells trimmed."""
    return spark.read.csv(path, sep=delimiter(path), header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True, inferSchema=False)


def read_transcripts(spark: SparkSession, path: str, id_column: str = "transcript_id") -> DataFrame:
    df = read_table(spark, path)
    require(df, id_column)
    return df.select([F.coalesce(F.col(f"`{c}`"), F.lit("")).alias("transcript_id" if c == id_column else c) for c in df.columns])


def query_ids(df: DataFrame, column: str = "id") -> DataFrame:
    """The distinct ids, nulls dropped."""
    return require(df, column).select(F.col(f"`{column}`").cast("string").alias("id")).dropna().distinct()


def read_queries(spark: SparkSession, path: str, column: str = "id") -> DataFrame:
    return query_ids(read_table(spark, path), column)


def parse_vector(text: Column) -> Column:
    """A comma-separated vector; an empty or null string is null."""
    return F.when(F.length(F.trim(text)) > 0, F.transform(F.split(text, ","), lambda x: F.trim(x).cast("float")))


def nodes_of(df: DataFrame, id_column: str = "transcript_id", index_column: str = "node_index", vector_column: str = "embedding_vector") -> DataFrame:
    """Nodes from a table whose vectors are arrays or comma-separated strings; empty vectors are skipped."""
    require(df, id_column, index_column, vector_column)
    vector = F.col(vector_column) if dict(df.dtypes)[vector_column].startswith("array") else parse_vector(F.col(vector_column))
    nodes = df.select(F.col(id_column).cast("string").alias("transcript_id"), F.col(index_column).cast("int").alias("node_index"), vector.cast("array<float>").alias("embedding"))
    return nodes.where(F.size("embedding") > 0)


def read_nodes(spark: SparkSession, path: str, **names: str) -> DataFrame:
    """Nodes from Parquet or text; a folder without a suffix is taken for tab-separated parts."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    df = spark.read.parquet(path) if name.endswith(".parquet") else read_table(spark, path)
    return nodes_of(df, **names)


def normalise_nested(df: DataFrame, id_column: str, vector_column: str = "node_embeddings") -> DataFrame:
    """Nodes from one row a transcript whose vectors are a list of lists, as a literal or an array."""
    nested = F.col(vector_column) if dict(df.dtypes)[vector_column].startswith("array") else F.from_json(vector_column, "array<array<float>>")
    return df.select(F.col(id_column).cast("string").alias("transcript_id"), F.posexplode(nested).alias("node_index", "embedding")).select(
        "transcript_id", "node_index", F.col("embedding").cast("array<float>").alias("embedding")
    )


def normalise_wide(df: DataFrame, id_column: str) -> DataFrame:
    """Nodes from one row a node: the first order column that there is, and the vector columns by prefix, else all others."""
    order = next((c for c in ORDER_COLUMNS if c in df.columns), None)
    if order is None:
        raise ValueError(f"none of the order columns {', '.join(ORDER_COLUMNS)} is there")
    rest = [c for c in df.columns if c not in (id_column, order)]
    chosen = [c for c in rest if c.lower().startswith(VECTOR_PREFIXES)] or rest
    if len(chosen) == 1 and dict(df.dtypes)[chosen[0]] == "string":
        return nodes_of(df, id_column, order, chosen[0])
    vector = F.array(*[F.col(f"`{c}`").cast("float") for c in chosen])
    return df.select(F.col(id_column).cast("string").alias("transcript_id"), F.col(order).cast("int").alias("node_index"), vector.alias("embedding"))


def only_ids(nodes: DataFrame, ids: DataFrame, column: str = "id") -> DataFrame:
    """The nodes of the given ids."""
    return nodes.join(ids.select(F.col(column).alias("transcript_id")), "transcript_id", "left_semi")


def missing_ids(nodes: DataFrame, ids: DataFrame, column: str = "id") -> DataFrame:
    """The ids without any node."""
    return ids.select(F.col(column).alias("id")).join(nodes.select(F.col("transcript_id").alias("id")), "id", "left_anti").distinct()


def structure_column(columns: list[str], name: str | int | None = None) -> str:
    """By name, by number, or the first that has "struct" in its name."""
    if isinstance(name, int):
        if not 0 <= name < len(columns):
            raise ValueError(f"there is no column {name}")
        return columns[name]
    found = [c for c in columns if c == name] if name is not None else [c for c in columns if "struct" in c.lower()]
    if not found:
        raise ValueError(f"no structure column in {', '.join(columns)}")
    return found[0]


def meta_projection(df: DataFrame, id_column: str = "transcript_id", structure: str | int | None = None) -> DataFrame:
    """The id, every column with "sequence" in its name, and the structure."""
    named = structure_column(df.columns, structure)
    sequences = [c for c in df.columns if "sequence" in c.lower() and c not in (id_column, named)]
    return require(df, id_column).select(F.col(id_column).cast("string").alias("transcript_id"), *sequences, named)


def first_of_each(df: DataFrame, key: str, order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    rest = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(key).agg(F.min_by(rest, order).alias("r")).select("r.*")


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Rows of .npy matrices as (path, row, vector)."""

    @F.pandas_udf("array<struct<row:int,vector:array<float>>>")
    def rows(content: pd.Series) -> pd.Series:
        def one(data: bytes) -> list:
            x = np.load(io.BytesIO(data))
            if x.ndim != 2:
                raise ValueError("a matrix is expected")
            return [{"row": k, "vector": v} for k, v in enumerate(x.astype(np.float32).tolist())]

        return content.map(one)

    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.inline(rows("content")))


def read_evd(spark: SparkSession, path: str) -> dict:
    """The statistics' parameters from JSON."""
    return json.loads("\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def driver_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes from a table of labelled vectors: each label is a transcript, in the order of vector ids."""
    from pyspark.sql import Window

    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    index = F.row_number().over(Window.partitionBy("label").orderBy("vec_id")) - 1
    return v.select(F.concat(F.lit("T"), F.col("label").cast("string")).alias("transcript_id"), index.cast("int").alias("node_index"), "embedding")
