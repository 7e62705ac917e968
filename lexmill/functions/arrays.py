"""Column functions on arrays: padding, arg-max, vector arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pad(a: Column, length: int, fill: Column, truncating: str = "post") -> Column:
    """Exactly ``length`` items: ``fill`` at the end, surplus cut at the end (``post``) or the front (``pre``)."""
    if truncating == "post":
        kept = F.slice(a, 1, length)
    elif truncating == "pre":
        kept = F.slice(a, F.greatest(F.size(a) - length, F.lit(0)) + 1, F.lit(length))
    else:
        raise ValueError(f"unknown truncation: {truncating}")
    return F.slice(F.concat(kept, F.array_repeat(fill, length)), 1, length)


def argmax(a: Column) -> Column:
    """Index of the greatest item; the first one on ties."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def mean_or_scalar(a: Column) -> Column:
    """Mean of a list of values; a single value is its own mean."""
    return total(a) / F.size(a)


def zeros(dim: int, kind: str = "float") -> Column:
    return F.array_repeat(F.lit(0.0).cast(kind), dim)
