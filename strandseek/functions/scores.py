"""Scores and their statistics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandseek.functions.vectors import clip


def cell_score(dot: Column, mu: Column | float, sigma: Column | float, gamma: float = 1.5, low: float = -4.0, high: float = 8.0) -> Column:
    """The clamped, scaled z-score of an inner product."""
    return clip(gamma * (dot - mu) / sigma, low, high)


def bit_score(score: Column, lam: Column, k: Column) -> Column:
    """(lambda S - ln K) / ln 2, or 0 where lambda or K isn't positive."""
    return F.when((lam > 0) & (k > 0), (lam * score - F.ln(k)) / F.ln(F.lit(2.0))).otherwise(F.lit(0.0))


def e_value(score: Column, lam: Column, k: Column, m: Column, n: Column) -> Column:
    """m n 2^-bits, or infinity where a length is 0 or lambda or K isn't positive."""
    bits = bit_score(score, lam, k)
    valid = (lam > 0) & (k > 0) & (m > 0) & (n > 0)
    return F.when(valid, m.cast("double") * n.cast("double") * F.pow(F.lit(2.0), -bits)).otherwise(F.lit(float("inf")))


def significance(e: Column) -> Column:
    """The documented bands of E-values."""
    return (
        F.when(e < 0.001, "highly significant").when(e < 0.01, "significant").when(e < 0.1, "marginal").when(e < 1, "weak").otherwise("not significant")
    )


def adaptive_band(span: Column, width: int = 96, buffer: int = 32, cap: int = 0) -> Column:
    """At least ``width``, enough for the span and a buffer (made even), at most ``cap`` if that is positive."""
    need = span + buffer
    band = F.greatest(F.lit(width), need + need % 2)
    return F.greatest(F.lit(1), F.least(band, F.lit(cap)) if cap > 0 else band)


def safe_filename(name: Column) -> Column:
    return F.regexp_replace(name, r"[^A-Za-z0-9_-]", "_")


def unpaired_share(structure: Column, start: Column, size: int) -> Column:
    """The share of dots in a stretch of a dot-bracket string."""
    part = F.substring(structure, start + 1, F.lit(size))
    return F.length(F.regexp_replace(part, "[^.]", "")) / F.lit(float(size))
