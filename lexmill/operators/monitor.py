"""Monitoring of a prediction log: quality, latency, errors, drift, growth of the labelled set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.operators.ordered import running_totals
from lexmill.operators.relational import dedup_by_text, keep_first


def _window(ts: str, width: str) -> Column:
    return F.window(ts, width)


def class_quality(df: DataFrame, ts: str, cls: str, prediction: str, width: str = "1 day") -> DataFrame:
    """(window, class, n, accuracy) of the true class."""
    hit = (F.col(cls) == F.col(prediction)).cast("double")
    return (df.groupBy(_window(ts, width).alias("window"), F.col(cls).alias("class"))
            .agg(F.count("*").alias("n"), F.avg(hit).alias("accuracy"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "class", "n", "accuracy"))


def latency_alerts(df: DataFrame, ts: str, ms: str, limit_ms: float = 300.0, max_share: float = 0.0,
                   width: str = "1 day") -> DataFrame:
    """Predictions, mean and greatest latency and the share above the limit per window."""
    slow = F.avg((F.col(ms) >= limit_ms).cast("double"))
    return (df.groupBy(_window(ts, width).alias("window"))
            .agg(F.count("*").alias("n"), F.avg(ms).alias("mean_ms"), F.max(ms).alias("max_ms"),
                 slow.alias("slow_share"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "n", "mean_ms", "max_ms", "slow_share", (F.col("slow_share") > max_share).alias("breach")))


def latency_percentiles(df: DataFrame, ts: str, ms: str, width: str = "1 day", accuracy: int = 10000) -> DataFrame:
    """Approximate median, 95 % and 99 % latency per window, in bounded memory."""
    q = F.percentile_approx(ms, [0.5, 0.95, 0.99], accuracy)
    return (df.groupBy(_window(ts, width).alias("window")).agg(q.alias("q"))
            .select(F.col("window.start").alias("window_start"), F.col("q")[0].alias("p50"),
                    F.col("q")[1].alias("p95"), F.col("q")[2].alias("p99")))


def error_rate_alerts(df: DataFrame, ts: str, is_error: Column, max_share: float = 0.2,
                      width: str = "1 day") -> DataFrame:
    """Requests, errors and their share per window against a limit."""
    return (df.groupBy(_window(ts, width).alias("window"))
            .agg(F.count("*").alias("n"), F.count_if(is_error).alias("n_errors"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "n", "n_errors", (F.col("n_errors") / F.col("n")).alias("error_share"),
                    (F.col("n_errors") / F.col("n") > max_share).alias("breach")))


def ks_p_value() -> Column:
    """The asymptotic p-value of (statistic, n, m); below lambda = 0.2, where the cut series does not converge, it is 1."""
    lam2 = F.col("statistic") ** 2 * (F.col("n") * F.col("m") / (F.col("n") + F.col("m")))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
                         lambda acc, j: acc + F.when(j % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * j * j * lam2))
    return F.when(lam2 < 0.04, 1.0).otherwise(F.least(F.greatest(2 * series, F.lit(0.0)), F.lit(1.0)))


def ks_drift(base: DataFrame, current: DataFrame, value: str, alpha: float = 0.05) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov test: statistic, sample sizes, p-value, drift flag.

    Both samples are counted per distinct value; running shares give the distance.
    """
    marked = base.select(F.col(value).alias("v"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        current.select(F.col(value).alias("v"), F.lit(0).alias("a"), F.lit(1).alias("b")))
    counts = (marked.where(F.col("v").isNotNull()).groupBy("v")
              .agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    points = running_totals(counts, [F.col("v")], {"ca": F.col("a"), "cb": F.col("b")})
    # The sizes come from the counted values, so neither sample is scanned again.
    sizes = points.agg(F.struct(F.sum("a").alias("n"), F.sum("b").alias("m")).alias("s")).scalar()
    gap = F.abs(F.try_divide(F.col("ca"), F.col("n")) - F.try_divide(F.col("cb"), F.col("m")))
    stat = (points.select("ca", "cb", sizes["n"].cast("double").alias("n"), sizes["m"].cast("double").alias("m"))
            .agg(F.max(gap).alias("statistic"), F.max("n").cast("long").alias("n"),
                 F.max("m").cast("long").alias("m")))
    return stat.withColumn("p_value", ks_p_value()).withColumn("drift", F.col("p_value") < alpha)


def ks_by_window(base: DataFrame, current: DataFrame, value: str, ts: str, by: str, width: str = "1 day",
                 alpha: float = 0.05) -> DataFrame:
    """(by, window_start, statistic, n, m, p_value, drift): the test of each window of a class against its base rows.

    Both samples are counted per distinct value; a running total goes over the distinct values of one class and window.
    """
    windows = current.select(F.col(by).alias("k"), _window(ts, width)["start"].alias("w"), F.col(value).alias("v"))
    old = base.where(F.col(value).isNotNull()).groupBy(F.col(by).alias("k"), F.col(value).alias("v")).agg(
        F.count("*").alias("a"))
    new = windows.where("v is not null").groupBy("k", "w", "v").agg(F.count("*").alias("b"))
    held = new.select("k", "w").distinct().join(old, "k")
    counts = held.select("k", "w", "v", "a", F.lit(0).cast("long").alias("b")).unionByName(
        new.select("k", "w", "v", F.lit(0).cast("long").alias("a"), "b")).groupBy("k", "w", "v").agg(
        F.sum("a").alias("a"), F.sum("b").alias("b"))
    upto = W.partitionBy("k", "w").orderBy("v")
    whole = W.partitionBy("k", "w")
    points = counts.select("k", "w", F.sum("a").over(upto).alias("ca"), F.sum("b").over(upto).alias("cb"),
                           F.sum("a").over(whole).alias("n"), F.sum("b").over(whole).alias("m"))
    gap = F.abs(F.try_divide(F.col("ca"), F.col("n")) - F.try_divide(F.col("cb"), F.col("m")))
    stat = points.groupBy("k", "w", "n", "m").agg(F.max(gap).alias("statistic")).where("statistic is not null")
    return stat.select(F.col("k").alias(by), F.col("w").alias("window_start"), "statistic", "n", "m",
                       ks_p_value().alias("p_value")).withColumn("drift", F.col("p_value") < alpha)


def class_latency(df: DataFrame, ts: str, cls: str, ms: str, limit_ms: float = 300.0, max_share: float = 0.0,
                  width: str = "1 day") -> DataFrame:
    """(class, window_start, window_end, n, slow_share, breach) of each class and window."""
    slow = F.avg((F.col(ms) >= limit_ms).cast("double"))
    return (df.groupBy(F.col(cls).alias("class"), _window(ts, width).alias("window"))
            .agg(F.count("*").alias("n"), slow.alias("slow_share"))
            .select("class", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "n",
                    "slow_share", (F.col("slow_share") > max_share).alias("breach")))


def alert_intervals(windows: DataFrame, k: int = 2, cls: str = "class") -> DataFrame:
    """(class, alert_start, alert_end, windows, state): runs of at least ``k`` breaching windows in a row.

    Windows are in a row if one begins where the other ends, so a window without rows ends a run. An alert fires from the first window of
    its run; it is ``firing`` if the run is the newest that the class has, else ``resolved``. One row per class and window goes in, so
    a class has as many rows in a task as it has windows.
    """
    order = W.partitionBy(cls).orderBy("window_start")
    fresh = ~F.col("breach") | ~F.lag("breach", 1, False).over(order) | (
        F.lag("window_end").over(order) != F.col("window_start"))
    runs = (windows.withColumn("_fresh", fresh.cast("int")).withColumn("_newest", F.max("window_start").over(W.partitionBy(cls)))
            .withColumn("_run", F.sum("_fresh").over(order)).where("breach"))
    out = runs.groupBy(cls, "_run").agg(
        F.min("window_start").alias("alert_start"), F.max("window_end").alias("alert_end"), F.count("*").alias("windows"),
        (F.max("window_start") == F.max("_newest")).alias("_open")).where(F.col("windows") >= k)
    return out.select(cls, "alert_start", "alert_end", "windows",
                      F.when(F.col("_open"), "firing").otherwise("resolved").alias("state"))


def class_shares(df: DataFrame, cls: str, name: str) -> DataFrame:
    # The total goes over one row per class, not over the table again.
    return df.groupBy(F.col(cls).alias("class")).agg(F.count("*").alias("c")).select(
        "class", (F.col("c") / F.sum("c").over(W.partitionBy())).alias(name))


def prediction_shift(base: DataFrame, current: DataFrame, cls: str, floor: float = 1e-6) -> DataFrame:
    """Class shares of two samples, their difference and the class's stability index."""
    both = class_shares(base, cls, "base_share").join(class_shares(current, cls, "current_share"),
                                                      "class", "full").na.fill(0.0)
    a = F.greatest(F.col("base_share"), F.lit(floor))
    b = F.greatest(F.col("current_share"), F.lit(floor))
    return (both.withColumn("abs_diff", F.abs(F.col("current_share") - F.col("base_share")))
            .withColumn("psi", (b - a) * F.log(b / a)))


def incremental_labels(known: DataFrame, new: DataFrame, row_id: str, text: str) -> DataFrame:
    """New labelled rows to append: unknown ids only, first row per id, then per text."""
    fresh = new.join(known.select(row_id), row_id, "left_anti").select(*new.columns)
    fresh = keep_first(fresh, F.col(row_id), F.struct(row_id, text))
    return dedup_by_text(fresh, text, F.col(row_id), unique=True)


def should_retrain(drift: DataFrame) -> DataFrame:
    """One row: whether any watched input drifts."""
    return drift.agg(F.coalesce(F.bool_or("drift"), F.lit(False)).alias("retrain"))
