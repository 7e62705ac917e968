"""Connected components of an edge table, without collecting anything."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.session import stage


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of u go to the smallest of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """u (the larger end) and its smaller neighbours go to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    joined = edges.join(least, "u").select("v", "m").where("v <> m").toDF("u", "v")
    return joined.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) pairs of ids to (node, component): the smallest id reachable.

    Alternates large-star and small-star passes until nothing changes, which takes
    about log2 of the longest path. A node with very many neighbours is aggregated
    before the shuffle and its join is one that adaptive execution can split. Every
    round is a table in the shared folder. Nulls and self-pairs count for nothing;
    an id without a pair is not in the result. Repeated pairs change nothing.
    """
    edges = stage(edges.where("u is not null and v is not null and u <> v")
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    while (now := _fingerprint(edges)) != before:
        before = now
        edges = stage(_small_star(_large_star(edges)), "edges")
    roots = edges.groupBy("u").agg(F.min("v").alias("component")).withColumnRenamed("u", "node")
    return roots.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
