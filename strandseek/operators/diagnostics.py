"""Diagnostics of window vectors: norms, pairwise cosines, histogram, principal components, label dispersion."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandseek.functions.vectors import dot, norm, unit
from strandseek.operators.knn import matrix

SAMPLE, PAIR_ROWS, BINS = 50_000, 2000, 60


def sample(rows: DataFrame, key: str, most: int = SAMPLE, seed: int = 7) -> DataFrame:
    """At most so many rows, those of the least hashes of their key: a random draw without replacement that any engine can repeat."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(most)


def norm_stats(rows: DataFrame) -> DataFrame:
    n = rows.select(norm("vector").alias("n"))
    return n.agg(F.count("*").alias("rows"), F.min("n").alias("norm_min"), F.max("n").alias("norm_max"), F.avg("n").alias("norm_mean"), F.stddev_pop("n").alias("norm_std"))


def pair_cosines(rows: DataFrame, key: str, most: int = PAIR_ROWS) -> DataFrame:
    """cosine of each unordered pair of at most ``most`` rows, drawn as in ``sample``, whose vectors are held in memory."""
    held = sample(rows, key, most).select(key, unit("vector").alias("vector")).orderBy(key)
    got = held.collect()
    keys, x = [r[0] for r in got], np.array([r[1] for r in got], np.float64).reshape(len(got), -1)
    place = {k: i for i, k in enumerate(keys)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), matrix(b.column(1)), strict=True):
                at = place[k] + 1
                yield pa.RecordBatch.from_arrays([pa.array(x[at:] @ v)], names=["cosine"])

    return held.mapInArrow(run, "cosine double")


def cosine_stats(cosines: DataFrame) -> DataFrame:
    return cosines.agg(F.count("*").alias("pairs"), F.avg("cosine").alias("cosine_mean"), F.stddev_pop("cosine").alias("cosine_std"), F.min("cosine").alias("cosine_min"), F.max("cosine").alias("cosine_max"))


def histogram(values: DataFrame, column: str, low: float, high: float, bins: int = BINS) -> DataFrame:
    """bin (from 0) and count; the last bin holds its upper edge too."""
    place = F.least(F.lit(bins), F.width_bucket(F.col(column), F.lit(float(low)), F.lit(float(high)), F.lit(bins))) - 1
    return values.where(F.col(column).between(low, high)).groupBy(place.cast("int").alias("bin")).agg(F.count("*").alias("count"))


def principal_components(rows: DataFrame, key: str, k: int = 2) -> tuple[DataFrame, list[float]]:
    """(key, component_1 ...) and each component's share of the variance."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    data = rows.select(key, array_to_vector(F.transform("vector", lambda x: x.cast("double"))).alias("v"))
    model = PCA(k=k, inputCol="v", outputCol="c").fit(data)
    out = model.transform(data).withColumn("c", vector_to_array("c"))
    mean = out.agg(*[F.avg(F.get("c", F.lit(j))) for j in range(k)]).first()
    return out.select(key, *[(F.get("c", F.lit(j)) - mean[j]).alias(f"component_{j + 1}") for j in range(k)]), list(map(float, model.explainedVariance.toArray()))


def label_dispersion(rows: DataFrame, label: str = "label") -> DataFrame:
    """label, count, dispersion: 1 less the mean inner product with the label's unit centroid; labels of at least two rows."""
    spread = rows.select(label, F.posexplode("vector").alias("at", "x")).groupBy(label, "at").agg(F.avg(F.col("x").cast("double")).alias("x"))
    centre = spread.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("c")).select(label, F.col("c.x").alias("c"))
    centre = centre.select(label, "c", norm("c").alias("size")).where((F.col("size") > 0) & ~F.isnan("size"))
    out = rows.join(centre, label).groupBy(label).agg(F.count("*").alias("count"), (1 - F.avg(dot("vector", "c") / F.col("size"))).alias("dispersion"))
    return out.where(F.col("count") >= 2)


def tightest(dispersion: DataFrame, n: int = 10, label: str = "label") -> DataFrame:
    return dispersion.orderBy("dispersion", F.desc("count"), label).limit(n)
