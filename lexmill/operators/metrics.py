"""Evaluation of scored rows. Columns: truth (0/1 or class), prediction, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.operators.ordered import running_totals
from lexmill.session import stage


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient, zero where it is undefined."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def f1(precision: Column, recall: Column) -> Column:
    return ratio(2 * precision * recall, precision + recall)


def confusion_matrix(df: DataFrame, truth: str, prediction: str, classes: Sequence = (0, 1)) -> DataFrame:
    """One row per true class, one column ``pred_<class>`` per predicted class, zeros filled.

    ``classes`` always appear; any others that occur as truth or prediction are added, so
    every row with both is counted. Runs a job for the few distinct classes.
    """
    seen = df.select(F.explode(F.array(truth, prediction)).alias("c")).where("c is not null").distinct()
    classes = sorted({*classes, *(r["c"] for r in seen.collect())})
    counts = (df.groupBy(truth).pivot(prediction, list(classes)).agg(F.count(F.lit(1)))
              .na.fill(0, [str(c) for c in classes]))
    every = df.sparkSession.createDataFrame([(c,) for c in classes], [truth]) \
              .select(F.col(truth).cast(df.schema[truth].dataType))
    return (every.join(counts, truth, "left")
            .select(F.col(truth).alias("truth"),
                    *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(f"pred_{c}") for c in classes]))


def accuracy(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    hit = (F.col(truth) == F.col(prediction)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"), (100 * F.avg(hit)).alias("accuracy_percent"))


def precision_recall_f1(df: DataFrame, truth: str, prediction: str, positive=1) -> DataFrame:
    """Measures of the positive class; zero where undefined."""
    t, p = F.col(truth) == positive, F.col(prediction) == positive
    counts = df.agg(F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"),
                    F.count_if(t & ~p).alias("fn"))
    rates = counts.select(ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                          ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))
    return rates.withColumn("f1", f1(F.col("precision"), F.col("recall")))


def classification_report(df: DataFrame, truth: str, prediction: str) -> DataFrame:
    """(class, precision, recall, f1, support) per class, then accuracy and both averages.

    Rows are first counted per (truth, prediction), so all else runs on a few rows.
    """
    t, p = F.col(truth), F.col(prediction)
    cells = stage(df.groupBy(t.cast("string").alias("t"), p.cast("string").alias("p"))
                  .agg(F.count("*").alias("n")), "cells")
    sides = cells.select("n", F.inline(F.array(
        F.struct(F.col("t").alias("class"), F.lit(1).alias("is_t"), (F.col("t") == F.col("p")).cast("int")
                 .alias("is_hit"), F.lit(0).alias("is_p")),
        F.struct(F.col("p").alias("class"), F.lit(0).alias("is_t"), F.lit(0).alias("is_hit"),
                 F.lit(1).alias("is_p")))))
    n = F.col("n")
    per_class = sides.groupBy("class").agg(
        F.sum(n * F.col("is_hit")).alias("tp"), F.sum(n * F.col("is_p")).alias("predicted"),
        F.sum(n * F.col("is_t")).alias("support"))
    per_class = (per_class.withColumn("precision", ratio(F.col("tp"), F.col("predicted")))
                 .withColumn("recall", ratio(F.col("tp"), F.col("support")))
                 .withColumn("f1", f1(F.col("precision"), F.col("recall"))))
    per_class = stage(per_class.select("class", "precision", "recall", "f1", "support"), "report")
    names = ("precision", "recall", "f1")
    rows = F.sum("support")
    macro = per_class.agg(*[F.avg(c).alias(c) for c in names], rows.alias("support"))
    weighted = per_class.agg(*[ratio(F.sum(F.col(c) * F.col("support")), rows).alias(c) for c in names],
                             rows.alias("support"))
    hits = cells.agg(ratio(F.sum(F.when(F.col("t") == F.col("p"), n)), F.sum(n)).alias("a"),
                     F.sum(n).alias("support"))
    overall = hits.select(*[F.col("a").alias(c) for c in names], "support")
    out = per_class
    for name, part in (("accuracy", overall), ("macro avg", macro), ("weighted avg", weighted)):
        out = out.unionByName(part.select(F.lit(name).alias("class"), *names, "support"))
    return out


def flatten_report(report: DataFrame, prefix: str = "test") -> DataFrame:
    """(metric, value) with names ``<prefix>_<class>_<measure>``; accuracy is one value."""
    wide = report.where(F.col("class") != "accuracy")
    long = wide.select("class", F.expr(
        "stack(4, 'precision', precision, 'recall', recall, 'f1-score', f1, 'support', cast(support as double))"
    ).alias("measure", "value")).select(
        F.concat_ws("_", F.lit(prefix), "class", "measure").alias("metric"), "value")
    single = report.where(F.col("class") == "accuracy").select(
        F.lit(f"{prefix}_accuracy").alias("metric"), F.col("precision").alias("value"))
    return long.unionByName(single)


# --- measures over all thresholds --------------------------------------------------------------

def score_totals(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Distinct scores in falling order with p positives of n rows and running totals cp, cn."""
    counts = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(truth).cast("long")).alias("p"), F.count("*").alias("n"))
    return running_totals(counts, [F.desc("threshold")], {"cp": F.col("p"), "cn": F.col("n")})


def _totals(points: DataFrame) -> Column:
    return points.agg(F.struct(F.sum("p").alias("tp"), F.sum("n").alias("n")).alias("t")).scalar()


def roc_auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Area under the ROC curve, ties counting half; null when one class is missing."""
    return score_totals(df, truth, score).agg(_roc_auc().alias("roc_auc"))


def _roc_auc() -> Column:
    wins = F.sum((F.col("n") - F.col("p")) * ((F.col("cp") - F.col("p")) + F.col("p") / 2))
    pairs = F.sum("p").cast("double") * (F.sum("n") - F.sum("p")).cast("double")
    return F.try_divide(wins, pairs)


def roc_curve(df: DataFrame, truth: str, score: str) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, with the origin (no threshold) as first point."""
    points = stage(score_totals(df, truth, score), "scores")
    t = _totals(points)
    curve = points.select("threshold",
                          ratio(F.col("cn") - F.col("cp"), t["n"] - t["tp"]).alias("fpr"),
                          ratio(F.col("cp"), t["tp"]).alias("tpr"))
    return curve.unionByName(_end_point(df, threshold=None, fpr=0.0, tpr=0.0))


def pr_curve(df: DataFrame, truth: str, score: str) -> DataFrame:
    """(threshold, precision, recall) per distinct score, with the closing point (1, 0)."""
    points = stage(score_totals(df, truth, score), "scores")
    t = _totals(points)
    curve = points.select("threshold", ratio(F.col("cp"), F.col("cn")).alias("precision"),
                          ratio(F.col("cp"), t["tp"]).alias("recall"))
    return curve.unionByName(_end_point(df, threshold=None, precision=1.0, recall=0.0))


def _end_point(df: DataFrame, **values) -> DataFrame:
    return df.sparkSession.range(1).select(
        *[F.lit(v).cast("double").alias(name) for name, v in values.items()])


def average_precision(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Step sum of precision over the gains in recall."""
    return score_totals(df, truth, score).agg(_average_precision().alias("average_precision"))


def _average_precision() -> Column:
    gain = F.sum(F.col("p") * F.col("cp") / F.col("cn"))
    return F.coalesce(F.try_divide(gain, F.sum("p").cast("double")), F.lit(0.0))


# --- choice of measures -------------------------------------------------------------------------

def evaluate(df: DataFrame, truth: str, prediction: str, score: str | None = None,
             metrics: Sequence[str] = ("accuracy", "precision", "recall", "f1")) -> DataFrame:
    """(metric, value) for the requested measures only."""
    known = {"accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"}
    unknown = set(metrics) - known
    if unknown:
        raise ValueError(f"unknown metrics: {', '.join(sorted(unknown))}")
    parts = []
    simple = [m for m in metrics if m in ("accuracy", "precision", "recall", "f1")]
    ranked = [m for m in metrics if m not in simple]
    if simple:
        t, p = F.col(truth) == 1, F.col(prediction) == 1
        precision = ratio(F.count_if(t & p), F.count_if(p))
        recall = ratio(F.count_if(t & p), F.count_if(t))
        values = {"accuracy": F.avg((F.col(truth) == F.col(prediction)).cast("double")),
                  "precision": precision, "recall": recall, "f1": f1(precision, recall)}
        parts.append(_as_rows(df.agg(*[values[m].alias(m) for m in simple]), simple))
    if ranked:
        values = {"roc_auc": _roc_auc(), "average_precision": _average_precision()}
        row = score_totals(df, truth, score).agg(*[values[m].alias(m) for m in ranked])
        parts.append(_as_rows(row, ranked))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _as_rows(row: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row of measures as (metric, value) rows."""
    pairs = ", ".join(f"'{m}', `{m}`" for m in names)
    return row.select(F.expr(f"stack({len(names)}, {pairs})").alias("metric", "value"))


def score_with_default(df: DataFrame, score: str, threshold: float = 0.5) -> DataFrame:
    """Add score and prediction with class 0, score 0 for failed rows, and the flag ``failed``."""
    failed = F.col(score).isNull()
    filled = F.coalesce(F.col(score), F.lit(0.0))
    return (df.withColumn("failed", failed).withColumn(score, filled)
            .withColumn("prediction", F.when(F.col("failed"), 0)
                        .otherwise((F.col(score) >= threshold).cast("int"))))
