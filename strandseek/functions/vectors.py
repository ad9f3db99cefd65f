"""Vector expressions: all of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a: Column | str, b: Column | str) -> Column:
    """The inner product in doubles."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def unit(a: Column | str) -> Column:
    """The vector over its norm; a zero vector as it is.

    The norm is bound to a lambda's variable: written in place it would be worked out again for each element.
    """
    bound = F.array(F.struct(as_column(a).alias("v"), norm(a).alias("n")))
    return F.get(F.transform(bound, lambda s: F.when(s["n"] > 0, F.transform(s["v"], lambda x: (x / s["n"]).cast("float"))).otherwise(s["v"])), F.lit(0))


def clip(x: Column, low: Column | float, high: Column | float) -> Column:
    as_lit = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    return F.greatest(as_lit(low), F.least(as_lit(high), x))


def cosine_of_distance(squared: Column) -> Column:
    """The cosine of two unit vectors of this squared distance."""
    return clip(1 - squared / 2, -1, 1)
