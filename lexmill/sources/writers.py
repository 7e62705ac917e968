"""Sinks: split tables, cleaned tables, vectors, metrics, predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.sources.schemas import RAW_POST, require_columns


def feature_table(df: DataFrame, row_id: str, text: str) -> DataFrame:
    """Project to (id, feature, split)."""
    require_columns(df, row_id, text, "split")
    return df.select(F.col(row_id).alias("id"), F.col(text).alias("feature"), "split")


def label_table(df: DataFrame, row_id: str, label: str) -> DataFrame:
    """Project to (id, label, split)."""
    require_columns(df, row_id, label, "split")
    return df.select(F.col(row_id).alias("id"), F.col(label).alias("label"), "split")


def write_posts(posts: DataFrame, path: str) -> None:
    """Headerless CSV of raw posts, all values quoted; blanks at the ends are kept."""
    posts.select(*RAW_POST.names).write.mode("overwrite").option("quoteAll", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def write_by_split(df: DataFrame, path: str) -> None:
    """One table, one folder per split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_vectors(vectors: DataFrame, path: str) -> None:
    """(id, vec) as Parquet, so that no row order ties vectors to their rows."""
    require_columns(vectors, "id", "vec")
    vectors.select("id", F.col("vec").cast("array<double>").alias("vec")).write.mode("overwrite").parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Metric rows as JSON lines."""
    require_columns(metrics, "metric", "value")
    metrics.write.mode("overwrite").json(path)


def write_predictions(scored: DataFrame, path: str) -> None:
    """Predictions with their id, so that row order carries no meaning."""
    require_columns(scored, "id", "prediction")
    keep = [c for c in ("id", "score", "prediction") if c in scored.columns]
    scored.select(*keep).write.mode("overwrite").json(path)
