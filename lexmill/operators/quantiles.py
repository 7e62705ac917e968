"""Exact quantiles of any number of distinct values, without a map of them in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.session import stage

EDGES = 128  # equal steps of the sketch between which a rank is sought


def order_statistics(df: DataFrame, value: str, ranks: DataFrame, by: Sequence[str] = (), limit: int = 10_000) -> DataFrame:
    """(by.., rank, value): the values at 0-based ranks (by.., rank) in ascending order; ``rank`` is a long.

    Distributed selection. A wanted rank lies in an open range of values, at first all of them. One scan per round
    sketches the values of each open range; the range then narrows to the steps of the sketch around the rank, which
    hold a few hundredths of it, and the next scan counts exactly what lies below, on both
    ends and inside. A rank on an end is found, however many rows have that value; a range with at most
    ``limit`` rows inside is ranked as it is. So rounds grow with the logarithm of the rows, and no group holds more than ``limit``.

    Null values do not count; NaN is the greatest. A rank beyond the rows of its group gives no row.
    """
    by, spark = list(by), df.sparkSession
    v = F.col(value).cast("double")
    rows = df.where(F.col(value).isNotNull()).select(*by, v.alias("_v"))
    key = [*by, "rank"]
    ends = rows.groupBy(*by).agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    wanted = ranks.select(*by, F.col("rank").cast("long")).distinct()
    # ``below`` counts the rows under ``lo``.

    def beside(left: DataFrame, right: DataFrame) -> DataFrame:
        """Each row with the ranges of its group; without groups these are few and come as one list."""
        if by:
            return left.join(right, by)
        listed = right.agg(F.collect_list(F.struct(*right.columns)).alias("all")).scalar()
        return left.withColumn("_r", F.explode(listed)).select(*left.columns, "_r.*")

    ranges = beside(wanted, ends)
    ranges = stage(ranges.withColumn("below", F.lit(0).cast("long")), "ranges")
    fractions = [k / EDGES for k in range(EDGES + 1)]
    found = None
    while True:
        inside = beside(rows, ranges).where(
            (F.col("_v") >= F.col("lo")) & (F.col("_v") <= F.col("hi")))
        mid = (F.col("_v") > F.col("lo")) & (F.col("_v") < F.col("hi"))
        counted = stage(inside.groupBy(*key, "lo", "hi", "below").agg(
            F.count_if(F.col("_v") == F.col("lo")).alias("at_lo"), F.count_if(mid).alias("mid"),
            F.count_if((F.col("_v") == F.col("hi")) & (F.col("hi") > F.col("lo"))).alias("at_hi"),
            F.percentile_approx(F.when(mid, F.col("_v")), fractions, 10_000).alias("edges")), "counted")
        place = F.col("rank") - F.col("below")
        place_mid = place - F.col("at_lo")
        on_lo = (place >= 0) & (place < F.col("at_lo"))
        on_hi = (place_mid >= F.col("mid")) & (place_mid < F.col("mid") + F.col("at_hi"))
        within = (place_mid >= 0) & (place_mid < F.col("mid"))
        ready = counted.where(on_lo | on_hi).select(*key, F.when(on_lo, F.col("lo")).otherwise(F.col("hi")).alias("value"))
        few = counted.where(within & (F.col("mid") <= limit)).select(*key, "lo", "hi", place_mid.alias("_place"))
        pairs = beside(rows, few)
        ranked = pairs.where((F.col("_v") > F.col("lo")) & (F.col("_v") < F.col("hi"))).withColumn(
            "_at", F.row_number().over(W.partitionBy(*key).orderBy("_v")) - 1).where(F.col("_at") == F.col("_place"))
        done = stage(ready.unionByName(ranked.select(*key, F.col("_v").alias("value"))), "found")
        found = done if found is None else found.unionByName(done)
        step = F.floor(place_mid / F.col("mid") * EDGES).cast("int")
        last = F.lit(EDGES)
        narrow = counted.where(within & (F.col("mid") > limit)).select(
            *key, "lo", "at_lo", "below", F.get("edges", F.greatest(step - 1, F.lit(0))).alias("new_lo"),
            F.get("edges", F.least(step + 2, last)).alias("hi"))
        # What lies between the old and the new lower end is counted exactly.
        between = beside(rows, narrow).where(
            (F.col("_v") > F.col("lo")) & (F.col("_v") < F.col("new_lo")))
        passed = between.groupBy(*key).agg(F.count("*").alias("passed"))
        ranges = stage(narrow.join(passed, key, "left").select(
            *key, F.col("new_lo").alias("lo"), "hi",
            (F.col("below") + F.col("at_lo") + F.coalesce("passed", F.lit(0))).alias("below")), "ranges")
        if ranges.isEmpty():
            return found


def exact_quantiles(df: DataFrame, value: str, shares: Sequence[float], by: Sequence[str] = (), limit: int = 10_000
                    ) -> DataFrame:
    """(by.., share, value): quantiles with linear interpolation between neighbours, one row for each share and group.

    The same numbers as a sort of the whole group gives; groups without a value are left out.
    """
    by = list(by)
    counts = stage(df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n")).where("n > 0"), "sizes")
    at = F.col("share") * (F.col("n") - 1)
    asked = counts.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares]))).select(
        *by, "share", F.floor(at).alias("low"), F.ceil(at).alias("high"), (at - F.floor(at)).alias("part"))
    ranks = asked.select(*by, F.explode(F.array("low", "high")).alias("rank"))
    values = stage(order_statistics(df, value, ranks, by, limit), "values")
    out = asked
    for side in ("low", "high"):
        named = values.select(*by, F.col("rank").alias(side), F.col("value").alias(f"{side}_value"))
        out = out.join(named, [*by, side])
    gap = F.when(F.col("part") > 0, F.col("part") * (F.col("high_value") - F.col("low_value"))).otherwise(0.0)
    return out.select(*by, "share", (F.col("low_value") + gap).alias("value"))
