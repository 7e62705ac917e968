"""Row filters and the report on what they removed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import is_present, is_valid, is_valid_bounded
from lexmill.operators.relational import sync_labels


def drop_empty(df: DataFrame, text: str = "feature") -> DataFrame:
    """Rows whose text is neither null nor exactly empty."""
    return df.where(is_present(F.col(text)))


def rows_with_null(df: DataFrame) -> DataFrame:
    """Rows with a null in any column."""
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in df.columns]))


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of nulls per column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def keep_valid(df: DataFrame, text: str = "feature", max_words: int | None = None) -> DataFrame:
    """Rows with non-blank text, optionally of at most ``max_words`` words."""
    c = F.col(text)
    return df.where(is_valid(c) if max_words is None else is_valid_bounded(c, max_words))


def split_valid(df: DataFrame, text: str = "feature") -> tuple[DataFrame, DataFrame]:
    """Valid rows and rejected rows; a bad row never stops the job."""
    ok = is_valid(F.col(text))
    return df.where(ok), df.where(~ok)


def keep_complete(df: DataFrame, text: str, label: str) -> DataFrame:
    """Rows with a label and non-blank text."""
    return keep_valid(df.na.drop(subset=[text, label]), text)


def cleaning_report(x: DataFrame, y: DataFrame, valid: Column, row_id: str = "id") -> DataFrame:
    """One row: rows in, valid, removed, and labels left after synchronising."""
    left = sync_labels(x.where(valid), y, row_id).agg(F.count("*").alias("n"))
    return (x.agg(F.count("*").alias("n_in"), F.count_if(valid).alias("n_valid"))
            .select("n_in", "n_valid", (F.col("n_in") - F.col("n_valid")).alias("n_removed"),
                    left.scalar().alias("n_labels_left")))
