"""Scans: raw posts, feature and label tables, word vectors."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.functions.text import SPACE, strip
from lexmill.sources.delimited import read_csv
from lexmill.sources.schemas import EVALUATION, FEATURE, LABEL, NA_STRINGS, RAW_POST

READ_PARTITIONS = "lexmill.read.partitions"


def blank_to_null(df: DataFrame, *columns: str) -> DataFrame:
    """Missing-value strings become nulls, as a pandas CSV reader has it."""
    return df.withColumns({c: F.when(~F.col(c).isin(*NA_STRINGS), F.col(c)) for c in columns})


def _plain_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool) -> DataFrame:
    return spark.read.schema(schema).option("quote", '"').option("escape", '"').csv(path, header=header)


def _csv(spark: SparkSession, path: str, schema: T.StructType, header: bool, multi_line: bool) -> DataFrame:
    return read_csv(spark, path, schema, header) if multi_line else _plain_csv(spark, path, schema, header)


def read_posts(spark: SparkSession, path: str, na_strings: bool = False, multi_line: bool = True) -> DataFrame:
    """Headerless CSV of raw posts; quoted texts may hold line breaks, and a file is read by many tasks.

    Only where it is known that no text holds a line break, ``multi_line=False`` spares the pass that counts quotes;
    such a break would part a post without an error.
    """
    df = _csv(spark, path, RAW_POST, False, multi_line)
    text_columns = [f.name for f in RAW_POST.fields if isinstance(f.dataType, T.StringType)]
    return blank_to_null(df, *text_columns) if na_strings else df


def _read_pairs(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = True) -> DataFrame:
    if path.rstrip("/").endswith(".csv"):
        return _csv(spark, path, schema, True, multi_line)
    return spark.read.parquet(path).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_features(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(id, feature) from CSV with header or from Parquet."""
    return _read_pairs(spark, path, FEATURE, multi_line)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """(id, label) from CSV with header or from Parquet."""
    return _read_pairs(spark, path, LABEL, False)


def read_vectors(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """(id, vec) that ``write_vectors`` has written; a vector of another length fails the query."""
    wrong = F.raise_error(F.concat(F.lit("wrong length of the vector of id "), F.col("id").cast("string")))
    df = spark.read.schema("id long, vec array<double>").parquet(path)
    return df.select("id", F.when(F.size("vec") == dim, F.col("vec")).otherwise(wrong).alias("vec"))


def read_table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """One Parquet table of a data folder, cut to ``columns``.

    Where the session sets ``lexmill.read.partitions`` the rows are dealt to so many tasks. That is meant for files of a
    single row group, which one task reads however many cores there are; by default rows stay where they are.
    """
    df = spark.read.parquet(os.path.join(folder, f"{name}.parquet"))
    df = df.select(*columns) if columns else df
    n = spark.conf.get(READ_PARTITIONS, None)
    return df.repartition(int(n)) if n else df


def read_evaluation(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """An already split evaluation file (tweet, id), where ``id`` is the label, as (feature, label)."""
    return _csv(spark, path, EVALUATION, True, multi_line).select(F.col("tweet").alias("feature"), F.col("id").alias("label"))


def parse_word_vectors(lines: DataFrame, dim: int, keep: str = "last") -> DataFrame:
    """(line_no, value) lines ``word f1 .. fD`` to (word, vec); other lines are skipped.

    A repeated word keeps its ``last`` or its ``first`` line.
    """
    if keep not in ("last", "first"):
        raise ValueError(f"unknown choice: {keep}")
    parts = lines.select("line_no", F.split(strip(F.col("value")), f"[{SPACE}]+").alias("p"))
    parsed = (parts.where(F.size("p") == dim + 1)
              .select("line_no", F.col("p")[0].alias("word"),
                      F.transform(F.slice("p", 2, dim), lambda x: x.try_cast("float")).alias("vec"))
              .where(~F.exists("vec", lambda x: x.isNull())))
    pick = F.max_by if keep == "last" else F.min_by
    return parsed.groupBy("word").agg(pick("vec", "line_no").alias("vec"))


def read_word_vectors(spark: SparkSession, path: str, dim: int = 50, keep: str = "last") -> DataFrame:
    """Word-vector text file to (word, vec). The file order decides on repeated words."""
    lines = spark.read.text(path).select(
        F.struct("_metadata.file_path", "_metadata.file_block_start",
                 F.monotonically_increasing_id().alias("row")).alias("line_no"), "value")
    return parse_word_vectors(lines, dim, keep)
