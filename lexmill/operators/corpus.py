"""Corpus statistics: lengths, vocabulary, frequencies, label shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.session import stage


def describe_by(df: DataFrame, value: str, *by: str) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max of ``value``.

    ``percentile`` keeps a value-to-count map, small because texts have few distinct lengths.
    """
    q = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = df.groupBy(*by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), q.alias("q"), F.max(value).alias("max"))
    return out.select(*by, "n", "mean", "std", "min", F.col("q")[0].alias("p25"),
                      F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max")


def value_counts(df: DataFrame, value: str) -> DataFrame:
    """(value, n): distinct values with their number, without nulls."""
    return df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(
        F.count("*").alias("n"))


def histogram(df: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed; empty bins are listed."""
    counts = stage(value_counts(df, value), "counts")
    ends = counts.agg(F.struct(F.min("value").cast("double").alias("lo"),
                               F.max("value").cast("double").alias("hi")).alias("e")).scalar()
    width = (ends["hi"] - ends["lo"]) / F.lit(bins)
    place = F.when(width > 0, F.least(F.floor((F.col("value") - ends["lo"]) / width), F.lit(bins - 1))) \
             .otherwise(0).cast("int")
    filled = counts.groupBy(place.alias("bin")).agg(F.sum("n").alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (every.join(filled, "bin", "left")
            .select("bin", (ends["lo"] + F.col("bin") * width).alias("left_edge"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def density_curve(df: DataFrame, value: str, points: int = 200) -> DataFrame:
    """Gaussian density on an even grid over [min, max], bandwidth by Scott's rule.

    Works on distinct values with their count; each meets the fixed grid once.
    """
    counts = stage(value_counts(df, value), "counts")
    v, n = F.col("value").cast("double"), F.col("n")
    total, mean = F.sum(n), F.sum(v * n) / F.sum(n)
    s = counts.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"), total.cast("double").alias("n"),
                            mean.alias("mean")).alias("s")).scalar()
    spread = counts.agg((F.sqrt(F.sum(n * F.pow(v - s["mean"], 2)) / (s["n"] - 1))
                         * F.pow(s["n"], F.lit(-0.2))).alias("h")).scalar()
    # Both measures are one row, taken once and kept as columns of the value table.
    wide = counts.select(v.alias("v"), "n", s["lo"].alias("lo"), s["hi"].alias("hi"),
                         s["n"].alias("total"), spread.alias("h"))
    at = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / F.lit(points - 1)
    bump = F.col("n") * F.exp(-F.pow((F.col("x") - F.col("v")) / F.col("h"), 2) / 2)
    return (wide.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
            .withColumn("x", at)
            .groupBy("point")
            .agg(F.max("x").alias("x"),
                 (F.sum(bump) / F.max(F.col("total") * F.col("h") * F.sqrt(F.lit(2 * 3.141592653589793))))
                 .alias("density")))


def label_shares(df: DataFrame, label: str) -> DataFrame:
    """Count and percent per label."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    # The total goes over one row per label, not over the table again.
    total = F.sum("n").over(W.partitionBy())
    return counts.select(label, "n", (F.lit(100.0) * F.col("n") / total).alias("percent"))


def explode_words(df: DataFrame, tokens: Column, *keep: str, name: str = "word") -> DataFrame:
    """One row per word.

    The outer form and a filter behind it, because for the plain form Spark adds a filter
    on the size of the array below, which makes it tokenise every text twice.
    """
    return df.select(*keep, F.explode_outer(tokens).alias(name)).where(F.col(name).isNotNull())


def vocabulary(df: DataFrame, tokens: Column) -> DataFrame:
    """(word, n): word frequencies, combined per task before the shuffle."""
    return explode_words(df, tokens).groupBy("word").agg(F.count("*").alias("n"))


def vocabulary_size(df: DataFrame, tokens: Column, *by: str, approximate: bool = False) -> DataFrame:
    """Number of distinct words, overall or per group."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return explode_words(df, tokens, *by).groupBy(*by).agg(count(F.col("word")).alias("vocab_size"))


def top_words(counts: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent words, ties by the word itself."""
    return counts.orderBy(F.desc("n"), "word").limit(k)


def frequent_words(counts: DataFrame, min_count: int = 5) -> DataFrame:
    return counts.where(F.col("n") >= min_count)


def rare_words(counts: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` words seen once, with the number of all such words."""
    once = counts.where(F.col("n") == 1)
    n_rare = once.agg(F.count("*").alias("n")).scalar()
    return once.orderBy("word").limit(k).select("word", n_rare.alias("n_rare"))


def long_words(df: DataFrame, tokens: Column, longer_than: int = 20) -> DataFrame:
    """Occurrences of long words, as (word, n)."""
    return vocabulary(df, F.filter(tokens, lambda w: F.length(w) > longer_than))


def covering_length(df: DataFrame, value: str, share: float = 0.95) -> DataFrame:
    """Whole length that covers ``share`` of the rows."""
    return df.agg(F.floor(F.percentile(value, F.lit(share))).cast("long").alias("length"))


def sequence_length_stats(df: DataFrame, value: str, *by: str) -> DataFrame:
    q = F.percentile(value, F.array(F.lit(0.95), F.lit(0.99)))
    return (df.groupBy(*by).agg(F.avg(value).alias("mean_len"), q.alias("q"))
            .select(*by, "mean_len", F.col("q")[0].alias("p95"), F.col("q")[1].alias("p99")))
