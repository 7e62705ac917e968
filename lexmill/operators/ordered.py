"""Running totals and ranks over a whole table, without a one-task window."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.session import stage


def running_totals(df: DataFrame, order: Sequence[Column], sums: Mapping[str, Column],
                   slices: int | None = None) -> DataFrame:
    """Add the running total of each of ``sums`` in the given, unique order.

    The rows are cut into ordered ranges, by default as many as the session has shuffle partitions. A range holds its own running totals,
    and one row per range (at most ``slices`` in all) carries what lies before it.
    The ranges are staged because their bounds come from a sample and must be the
    same for both uses.
    """
    if slices is None:
        slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = stage(
        df.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()), "ranges")
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (ranged.groupBy("_slice").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
               .select("_slice", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_{n}")
                                   for n in sums]))
    inside = W.partitionBy("_slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    # The offsets have at most `slices` rows, so broadcasting them is safe.
    return (ranged.join(F.broadcast(offsets), "_slice")
            .select(*df.columns, *[(F.sum(c).over(inside) + F.col(f"_{n}")).alias(n)
                                   for n, c in sums.items()]))


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Add the 1-based position in a unique order."""
    return running_totals(df, order, {name: F.lit(1).cast("long")})
