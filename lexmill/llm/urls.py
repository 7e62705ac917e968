"""URL rules by a sort-merge range join on reversed-host keys. Native expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.session import stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty for null or without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``; empty for null or without ``://``."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _key(labels: Column, path: Column) -> Column:
    """``com.example./en/``: all urls of a rule lie in the interval of keys that start with the rule's key."""
    return F.concat(F.array_join(labels, "."), F.lit("."), path)


def _nested_rules(rules: DataFrame) -> DataFrame:
    """(key, stack): for each rule the rules that are active where it starts, the outermost first, itself last."""
    rule = F.struct(F.col("key"), F.concat("host", "path").alias("rule"), "verdict",
                    F.length(F.concat("host", "path")).alias("size"), F.length("host").alias("host_size"))
    # Of equal rules with different verdicts the blocking one counts.
    own = (rules.where("host <> '' and (path = '' or path like '/%')")
           .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
           .withColumn("key", _key(_reversed_labels(F.col("host")), F.col("path"))).select("key", rule.alias("r")))
    prefixes = own.select(F.col("key").alias("inner"),
                          F.explode(F.transform(F.sequence(F.lit(1), F.length("key")),
                                                lambda n: F.substring("key", F.lit(1), n))).alias("key"))
    return (prefixes.join(own, "key").groupBy("inner")
            .agg(F.array_sort(F.collect_list("r")).alias("stack")).withColumnRenamed("inner", "key"))


def judge_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to ``df``, whose other columns stay as they are.

    ``rules`` has (host, path, verdict), verdict ``allow`` or ``block``. A rule fits its
    host and all subdomains where the url's path starts with the rule's; the longest rule
    (host and path together, then host) wins. No fitting rule: ``rule`` null and
    ``default``. Rules without host, or whose path starts without ``/``, fit nothing.

    Each distinct url becomes one point for each host suffix that a rule may have. Points
    and rule starts are sorted by key in ranges; a range can cut through a single host. In
    a sweep over each range the last rule start carries the stack of rules nested around
    it, and the deepest that still covers the point is the answer. What is active at the
    start of a range comes with one row per range. Null and repeated urls are judged like
    any other; an empty table stays empty. Columns of ``df`` named as one of the added
    are replaced.
    """
    starts = stage(_nested_rules(rules), "rules")
    labels = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    urls = df.select(F.col(f"`{url_col}`").alias("url")).where("url is not null").distinct()
    parts = urls.select("url", _reversed_labels(host_of(F.col("url"))).alias("labels"),
                        path_of(F.col("url")).alias("path")).where("labels[0] <> '' or size(labels) > 1")
    suffixes = F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(max(labels, 1))))
    points = (parts.select("url", "labels", "path", F.explode(suffixes).alias("n"))
              .select(_key(F.slice("labels", F.lit(1), F.col("n")), F.col("path")).alias("key"), "url",
                      F.lit(1).alias("kind")))
    order = ["key", "kind", "url"]
    events = points.unionByName(starts.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    ranged = stage(events.repartitionByRange(*order).withColumn("slice", F.spark_partition_id()), "ranges")
    earlier = W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    carried = (ranged.groupBy("slice").agg(F.max(F.when(F.col("kind") == 0, F.struct("key", "stack"))).alias("last"))
               .select("slice", F.last("last.stack", ignorenulls=True).over(earlier).alias("carried")))
    inside = W.partitionBy("slice").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    swept = (ranged.withColumn("active", F.last("stack", ignorenulls=True).over(inside)).where("kind = 1")
             .join(carried, "slice"))
    covering = F.filter(F.coalesce("active", "carried"), lambda r: F.startswith(F.col("key"), r["key"]))
    best = (swept.select("url", F.try_element_at(covering, F.lit(-1)).alias("r")).where("r is not null")
            .groupBy("url").agg(F.max(F.struct("r.size", "r.host_size", "r.rule", "r.verdict")).alias("r"))
            .select(F.col("url").alias("_url"), F.col("r.rule").alias("_rule"), F.col("r.verdict").alias("_verdict")))
    kept = df.withColumns({"host": host_of(F.col(f"`{url_col}`")), "path": path_of(F.col(f"`{url_col}`"))})
    joined = kept.join(best, kept[url_col] == best["_url"], "left")
    return joined.withColumns({"rule": F.col("_rule"), "verdict": F.coalesce("_verdict", F.lit(default))}).drop(
        "_url", "_rule", "_verdict")
