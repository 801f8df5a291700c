"""Vector expressions on ARRAY<FLOAT/DOUBLE> columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from levyline.functions.text import col


def dot(a, b) -> Column:
    return F.aggregate(
        F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Cosine of two vectors, NULL when one has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def unit(a) -> Column:
    length = norm(a)
    return F.when(length > 0, F.transform(col(a), lambda x: x.cast("double") / length)).otherwise(col(a).cast("array<double>"))


LETTERS = "abcdefghijklmnopqrstuvwxyz"


def letter_profile(text) -> Column:
    """Counts of the 26 letters: a model-free embedding that any SQL engine can recompute."""
    lowered = F.lower(F.coalesce(col(text), F.lit("")))
    size = F.length(lowered)
    return F.array(
        *[(size - F.length(F.replace(lowered, F.lit(c), F.lit("")))).cast("double") for c in LETTERS]
    )
