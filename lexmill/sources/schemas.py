"""Explicit schemas and the schema guard. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

RAW_POST = T.StructType([
    T.StructField("polarity", T.IntegerType()),
    T.StructField("post_id", T.LongType()),
    T.StructField("date", T.StringType()),
    T.StructField("query", T.StringType()),
    T.StructField("user", T.StringType()),
    T.StructField("text", T.StringType()),
])
FEATURE = T.StructType([T.StructField("id", T.LongType()), T.StructField("feature", T.StringType())])
LABEL = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.IntegerType())])
EVALUATION = T.StructType([T.StructField("tweet", T.StringType()), T.StructField("id", T.IntegerType())])
REQUEST = T.StructType([T.StructField("tweet", T.StringType()), T.StructField("true_label", T.StringType())])

# The strings a pandas CSV reader takes for a missing value.
NA_STRINGS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
              "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` itself, or an error naming the missing columns. Runs no job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_files(paths: list[str], count: int = 6) -> list[str]:
    """The given paths, or an error when there are not exactly ``count``."""
    if len(paths) != count:
        raise ValueError(f"expected {count} input files, got {len(paths)}")
    return paths
