"""Background of node similarities, null alignments and the parameters of their extreme values.

Samples are drawn by arithmetic on row numbers, so they depend on the seed and the data alone, not
on partitions or the number of cores.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandseek.functions.vectors import dot
from strandseek.operators.kernel import Scoring, align
from strandseek.operators.places import fetched, numbered
from strandseek.params import SearchParams

#: A prime modulus and multipliers of the sampler; each draw takes its own multiplier.
PRIME, STEPS = 2147483647, (48271, 69621, 16807, 39373)
LEAST_LENGTH, LEAST_SCORES = 20, 10
DEFAULT_LAMBDA, DEFAULT_K = 0.1, 0.01


def draw(i: Column, which: int, seed: int) -> Column:
    """The i-th number of a sampler, from 0 below PRIME."""
    return ((i + 1) * STEPS[which] + F.lit(seed) * 7919 + which * 104729) % PRIME * STEPS[(which + 1) % 4] % PRIME


def sequences(nodes: DataFrame) -> DataFrame:
    """Each transcript's vectors in node order: transcript_id, vectors, length."""
    rows = nodes.groupBy("transcript_id").agg(F.sort_array(F.collect_list(F.struct("node_index", "embedding"))).alias("nodes"))
    return rows.select("transcript_id", F.col("nodes.embedding").alias("vectors"), F.size("nodes").alias("length"))


def background(nodes: DataFrame, samples: int, seed: int = 42) -> DataFrame:
    """background_mu and background_sigma (of the population) of inner products of random nodes of random transcripts.

    Places are drawn first; only the drawn nodes' vectors are fetched, at most two a sample.
    """
    lengths = numbered(nodes.groupBy("transcript_id").agg(F.count("*").alias("length")))
    n = lengths.count()
    if not n:
        raise ValueError("no nodes to sample from")
    pairs = nodes.sparkSession.range(samples).select("id", F.explode(F.array(*[F.struct(F.lit(k).alias("side"), (draw(F.col("id"), k, seed) % n).alias("place")) for k in (0, 1)])).alias("x")).select("id", "x.*")
    at = F.when(F.col("side") == 0, draw(F.col("id"), 2, seed)).otherwise(draw(F.col("id"), 3, seed)) % F.col("length")
    drawn = lengths.join(F.broadcast(pairs), "place").select("id", "side", "transcript_id", at.cast("int").alias("at"))
    found = fetched(nodes, drawn, bounded=True).join(F.broadcast(drawn), ["transcript_id", "at"])
    side = lambda k, name: F.max_by(F.when(F.col("side") == k, F.col("embedding")), F.col("side") == k).alias(name)
    both = found.groupBy("id").agg(side(0, "first"), side(1, "second"))
    sigma = F.stddev_pop("d")
    return both.select(dot("first", "second").alias("d")).agg(F.avg("d").alias("background_mu"), F.when(sigma < 1e-6, 1.0).otherwise(sigma).alias("background_sigma"))


def sampled_ids(nodes: DataFrame, most: int, seed: int) -> DataFrame:
    """At most so many transcripts, those of the least hashes; 0 takes all."""
    lengths = nodes.groupBy("transcript_id").agg(F.count("*").alias("length"))
    return lengths if most <= 0 else lengths.orderBy(F.xxhash64("transcript_id", F.lit(seed)), "transcript_id").limit(most)


def scoring(p: SearchParams, mu: float, sigma: float, xdrop: float | None) -> Scoring:
    return Scoring(mu, sigma, p.gamma, p.score_min, p.score_max, p.gap_open, p.gap_extend, xdrop)


def null_scores(nodes: DataFrame, p: SearchParams, mu: float, sigma: float) -> DataFrame:
    """sample, score, m, n of alignments of shuffled random pairs of sequences, whole, on diagonal 0, without X-drop; those above 0."""
    eligible = numbered(sampled_ids(nodes, p.sampled_sequences, p.seed).where(F.col("length") >= LEAST_LENGTH).select("transcript_id"))
    n = eligible.count()
    ddl = "sample long, score double, m int, n int"
    if n < 2:
        return nodes.sparkSession.createDataFrame([], ddl)
    pairs = nodes.sparkSession.range(p.evd_samples).select(F.col("id").alias("sample"), *[(draw(F.col("id"), k, p.seed + 1) % n).alias(s) for k, s in enumerate("ab")])
    drawn = eligible.join(F.broadcast(pairs.select(F.explode(F.array("a", "b")).alias("place")).distinct()), "place")  # at most two a sample
    wanted = F.broadcast(drawn.select("transcript_id"))
    full = drawn.join(sequences(nodes.join(wanted, "transcript_id", "left_semi")), "transcript_id").select("place", "vectors")
    for s in "ab":
        pairs = pairs.join(full.select(F.col("place").alias(s), F.col("vectors").alias(f"{s}_vectors")), s)
    rule, band, seed = scoring(p, mu, sigma, None), p.band_width, p.seed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k in range(b.num_rows):
                sample = b.column(0)[k].as_py()
                rng = np.random.default_rng([seed, sample])
                x, y = (np.stack(b.column(c)[k].values.to_numpy(zero_copy_only=False)) for c in (1, 2))
                score, _ = align(rng.permutation(x), rng.permutation(y), rule, band, trace=False)
                if score > 0:
                    out.append((sample, score, len(x), len(y)))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.float64(), pa.int32(), pa.int32()))], names=["sample", "score", "m", "n"])

    return pairs.repartition("sample").select("sample", "a_vectors", "b_vectors").mapInArrow(run, ddl)


def fit_gumbel(scores: np.ndarray) -> tuple[float, float]:
    """Location and scale by maximum likelihood: the scale solves b = mean(x) - sum(x e^(-x/b)) / sum(e^(-x/b))."""
    x = np.asarray(scores, np.float64)
    least = x.min()
    y = x - least

    def gap(b: float) -> float:
        w = np.exp(-y / b)
        return y.mean() - float((y * w).sum() / w.sum()) - b

    low, high = 1e-9, max(1e-6, float(y.mean()) * 2 + 1e-6)
    while gap(high) > 0:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if gap(mid) > 0 else (low, mid)
    b = (low + high) / 2
    return least - b * float(np.log(np.exp(-y / b).mean())), b


def evd_params(nodes: DataFrame, p: SearchParams, given: dict | None = None) -> DataFrame:
    """One row: lambda, K, the background and the settings. Given parameters come first, then lambda and K of the settings, then an estimate."""
    spark = nodes.sparkSession
    lengths = nodes.groupBy("transcript_id").agg(F.count("*").alias("n")).agg(F.count("*").alias("n")).first()["n"]
    if given:
        mu, sigma = given.get("background_mu"), given.get("background_sigma")
    if not given or mu is None or sigma is None:
        mu, sigma = background(nodes, p.background_samples, p.seed).first()
    if given:
        lam, k = float(given["evd_lambda"]), float(given["evd_K"])
    elif p.evd_lambda is not None and p.evd_k is not None:
        lam, k = p.evd_lambda, p.evd_k
    else:
        rows = null_scores(nodes, p, mu, sigma).orderBy("sample").collect()  # at most evd_samples rows
        lam, k = DEFAULT_LAMBDA, DEFAULT_K
        if len(rows) >= LEAST_SCORES:
            at, scale = fit_gumbel(np.array([r["score"] for r in rows]))
            lam = 1 / scale
            k = np.exp(-lam * at) if p.evd_mode == "compat" else np.exp(lam * at) / np.mean([r["m"] * r["n"] for r in rows])
    sampled = min(lengths, p.sampled_sequences) if p.sampled_sequences > 0 else lengths
    row = (float(lam), float(k), float(mu), float(sigma), p.gamma, p.band_width, p.gap_open, p.gap_extend, float(p.xdrop), p.score_min, p.score_max, p.evd_samples, p.background_samples, p.seed, lengths, sampled, lengths, sampled < lengths)
    return spark.createDataFrame(
        [row],
        "evd_lambda double, evd_K double, background_mu double, background_sigma double, gamma double, band_width int, gap_open double, gap_extend double, xdrop double, score_min double, score_max double, "
        "evd_samples int, background_samples int, random_seed int, num_sequences long, sampled_sequences long, total_sequences_in_database long, sequences_sampled boolean",
    )
