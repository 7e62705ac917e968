"""Reproducible draws from a seed and an id, independent of partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def id_digest(row_id: Column, seed: int | str = 42) -> Column:
    """32 hex digits that look random but follow from seed and id."""
    return F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))


def id_number(row_id: Column, seed: int | str = 42) -> Column:
    """Whole number in [0, 2^32)."""
    return F.conv(F.substring(id_digest(row_id, seed), 1, 8), 16, 10).cast("long")


def id_fraction(row_id: Column, seed: int | str = 42) -> Column:
    """Number in [0, 1)."""
    return id_number(row_id, seed) / F.lit(4294967296.0)
