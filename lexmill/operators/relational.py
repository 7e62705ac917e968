"""Joins on the post id and removal of repeated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sync_labels(x: DataFrame, y: DataFrame, row_id: str = "id") -> DataFrame:
    """Labels of the rows that survive in ``x``."""
    return y.join(x.select(row_id), row_id, "left_semi")


def attach_labels(x: DataFrame, y: DataFrame, row_id: str = "id", label: str = "label",
                  order: str | None = None) -> DataFrame:
    """``x`` with its label. A row of ``x`` without a label fails the query.

    With ``order``, a repeated id of ``y`` takes its last label in that order;
    without it a repeated id of ``y`` fails the query.
    """
    if order is not None:
        y = y.groupBy(row_id).agg(F.max_by(label, order).alias(label))
    else:
        several = F.raise_error(F.concat(F.lit("several labels for id "), F.col(row_id).cast("string")))
        y = y.groupBy(row_id).agg(F.first(label).alias(label), F.count("*").alias("_n")).select(
            row_id, F.when(F.col("_n") > 1, several).otherwise(F.col(label)).alias(label))
    found = y.select(row_id, F.struct(F.col(label)).alias("_found"))
    checked = F.when(
        F.col("_found").isNull(),
        F.raise_error(F.concat(F.lit("no label for id "), F.col(row_id).cast("string"))),
    ).otherwise(F.col("_found")[label])
    return x.join(found, row_id, "left").withColumn(label, checked).drop("_found")


def merge_on_id(x: DataFrame, y: DataFrame, row_id: str = "id") -> DataFrame:
    """Inner join on the id."""
    return x.join(y, row_id)


def missing_rows(expected: DataFrame, answered: DataFrame, row_id: str = "id") -> DataFrame:
    """Rows of ``expected`` without a counterpart in ``answered``."""
    return expected.join(answered.select(row_id), row_id, "left_anti")


def require_complete(expected: DataFrame, answered: DataFrame, row_id: str = "id") -> None:
    """Error when some expected row has no answer. Runs a job."""
    if not missing_rows(expected, answered, row_id).isEmpty():
        raise ValueError("some rows have no answer")


def keep_first(df: DataFrame, key: Column, order: Column) -> DataFrame:
    """The first row per key, in a unique order.

    An aggregate instead of a ranked window: each task first reduces its own rows,
    so a key that holds a third of the table still sends one row per task.
    """
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.groupBy(key.alias("_key")).agg(F.min_by(row, order).alias("_row")).select("_row.*")


def _firsts(df: DataFrame, key: Column, order: Column) -> DataFrame:
    """The row with the smallest ``order`` per key, where the order names one row of its key.

    Only key and order are aggregated, by hash; whole rows are neither sorted nor aggregated, they meet the
    few columns of the result in a semi-join, which is a broadcast below the threshold.
    """
    firsts = df.where(key.isNotNull()).groupBy(key.alias("_key")).agg(F.min(order).alias("_order"))
    none = df.where(key.isNull())
    kept = df.join(firsts, (key == F.col("_key")) & (order == F.col("_order")), "left_semi")
    return kept.unionByName(keep_first(none, key, order))


def dedup_by_id(df: DataFrame, row_id: str, order: Column, unique: bool = False) -> DataFrame:
    """The first row per id. With ``unique`` the caller says that no two rows of an id are equal in ``order``.

    Then only ids and order are aggregated; otherwise whole rows are, since equal ones must become one.
    """
    return (_firsts if unique else keep_first)(df, F.col(row_id), order)


def dedup_by_text(df: DataFrame, text: str, order: Column, unique: bool = False) -> DataFrame:
    """The first row per exact text; texts are compared by their SHA-256 digest. ``unique`` as for ids."""
    return (_firsts if unique else keep_first)(df, F.unhex(F.sha2(text, 256)), order)
