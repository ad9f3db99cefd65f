"""Writers: Parquet by default, and the text formats of the pipeline."""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str) -> None:
    """A headered tab-separated table; arrays are comma-joined, so a table without rows still has its header."""
    flat = [F.array_join(F.col(c).cast("array<string>"), ",").alias(c) if t.startswith("array<") and "struct" not in t else F.to_json(c).alias(c) if t.startswith(("array<struct", "struct")) else F.col(c) for c, t in df.dtypes]
    df.select(flat).write.mode("overwrite").csv(path, sep="\t", header=True)


def write_json(df: DataFrame, path: str) -> None:
    """One object a line: statistics of one row, or traces."""
    df.write.mode("overwrite").json(path)


def write_text(df: DataFrame, path: str, column: str) -> None:
    df.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def write_parquet(df: DataFrame, path: str, by: str | None = None) -> None:
    """Parquet, a folder for each value of ``by``; raw values are keys, so no two of them share a folder."""
    w = df.write.mode("overwrite")
    (w.partitionBy(by) if by else w).parquet(path)


def npy(df: DataFrame, column: str, order: list[str], limit: int = 1_000_000) -> bytes:
    """The vectors of a table of at most ``limit`` rows as an .npy matrix, in the given order."""
    rows = df.orderBy(*order).select(column).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} vectors; write Parquet instead")
    out = io.BytesIO()
    np.save(out, np.array([r[0] for r in rows], np.float32))
    return out.getvalue()
