"""Reproducible train / validation / test splits.

Every draw follows from the seed and the row id, which must be unique. The result
does not depend on partitioning, retries or row order.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.functions.hashing import id_digest, id_fraction, id_number
from lexmill.operators.ordered import global_rank
from lexmill.session import stage


def split_by_fraction(df: DataFrame, row_id: str, fractions: Mapping[str, float],
                      rest: str = "train", seed: int = 42) -> DataFrame:
    """Row-local split: each name takes its share of [0, 1), ``rest`` the remainder."""
    draw = id_fraction(F.col(row_id), seed)
    edge, column = 0.0, None
    for name, share in fractions.items():
        edge += share
        column = (F.when if column is None else column.when)(draw < F.lit(edge), name)
    return df.withColumn("split", column.otherwise(rest))


def split_two_way(df: DataFrame, row_id: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    return split_by_fraction(df, row_id, {"test": test_size}, seed=seed)


def split_three_way(df: DataFrame, row_id: str, test_size: float = 0.2, val_size: float = 0.25,
                    seed: int = 42) -> DataFrame:
    """``val_size`` is a share of what the test set leaves, by a second, independent draw."""
    return df.withColumn(
        "split",
        F.when(id_fraction(F.col(row_id), seed) < F.lit(test_size), "test")
        .when(id_fraction(F.col(row_id), f"{seed}:val") < F.lit(val_size), "val")
        .otherwise("train"))


def assign_folds(df: DataFrame, row_id: str, folds: int = 5, seed: int = 42) -> DataFrame:
    """Add the shuffled fold, 0 to ``folds - 1``."""
    return df.withColumn("fold", (id_number(F.col(row_id), seed) % folds).cast("int"))


def expand_folds(df: DataFrame, folds: int) -> DataFrame:
    """Every row once per round, as validation row of its own fold and else as training row."""
    return (df.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
            .withColumn("role", F.when(F.col("round") == F.col("fold"), "val").otherwise("train")))


def _share_up(n: Column, share: Decimal) -> Column:
    """ceil(n * share) in whole numbers."""
    top, bottom = share.as_integer_ratio()
    return F.floor((n * F.lit(top) + F.lit(bottom - 1)).cast("decimal(38,0)") / F.lit(bottom))


def class_quotas(counts: DataFrame, label: str, test_size: str, val_size: str) -> DataFrame:
    """(label, n) to (label, q_test, q_val): class shares by largest remainder, ties by label.

    The windows run over one row per class.
    """
    whole = W.partitionBy()
    test, val = Decimal(test_size), Decimal(val_size)
    sized = counts.withColumn("total", F.sum("n").over(whole)).withColumn(
        "t_test", _share_up(F.col("total"), test).cast("long"))
    # val_size is a share of the whole table, hence val_size / (1 - test_size) of the rest.
    rest = F.col("total") - F.col("t_test")
    top, bottom = (val.as_integer_ratio()[0] * (1 - test).as_integer_ratio()[1],
                   val.as_integer_ratio()[1] * (1 - test).as_integer_ratio()[0])
    sized = sized.withColumn(
        "t_val", F.floor((rest * F.lit(top) + F.lit(bottom - 1)).cast("decimal(38,0)")
                         / F.lit(bottom)).cast("long"))

    def with_quota(df: DataFrame, have: str, want: str, name: str) -> DataFrame:
        """Distribute ``want`` over the classes in proportion to ``have``."""
        wide = F.col(have).cast("decimal(18,0)") * F.col(want).cast("decimal(18,0)")
        whole_sum = F.sum(have).over(whole).cast("decimal(18,0)")
        df = df.withColumn("_left", wide % whole_sum)
        df = df.withColumn("_base", ((wide - F.col("_left")) / whole_sum).cast("long"))
        turn = F.row_number().over(W.orderBy(F.desc("_left"), label))
        open_seats = F.col(want) - F.sum("_base").over(whole)
        return df.withColumn(name, F.col("_base") + (turn <= open_seats).cast("long")).drop("_left", "_base")

    out = with_quota(sized, "n", "t_test", "q_test").withColumn("rest_n", F.col("n") - F.col("q_test"))
    return with_quota(out, "rest_n", "t_val", "q_val").select(label, "q_test", "q_val")


def split_stratified_exact(df: DataFrame, row_id: str, label: str, test_size: str = "0.005",
                           val_size: str = "0.07", seed: int = 42) -> DataFrame:
    """Stratified split with exact class quotas.

    Within a class the rows are ordered by digest; the first go to test, the next to
    val. Only the digest at which each quota ends has to be known. Digests are
    uniform, so counting them by their first four digits finds the narrow range that
    holds it, and only that range is ranked. The table itself is never shuffled.
    """
    keys = df.select(F.col(label).alias("_label"), F.col(row_id).alias("_id"),
                     id_digest(F.col(row_id), seed).alias("_digest")) \
             .withColumn("_range", F.substring("_digest", 1, 4))
    ranges = stage(keys.groupBy("_label", "_range").agg(F.count("*").alias("n")), "ranges")
    quotas = class_quotas(ranges.groupBy("_label").agg(F.sum("n").alias("n")), "_label",
                          test_size, val_size)
    upto = F.sum("n").over(W.partitionBy("_label").orderBy("_range"))
    ends = F.explode(F.map_from_arrays(
        F.array(F.lit("test"), F.lit("val")),
        F.array(F.col("q_test"), F.col("q_test") + F.col("q_val")))).alias("cut", "end")
    cuts = stage(
        ranges.withColumn("upto", upto).join(quotas, "_label")
        .select("_label", "_range", "n", "upto", ends)
        .where((F.col("end") > F.col("upto") - F.col("n")) & (F.col("end") <= F.col("upto")))
        .select("_label", "_range", "cut", (F.col("end") - F.col("upto") + F.col("n")).alias("k")),
        "cuts")
    turn = F.row_number().over(W.partitionBy("_label", "_range", "cut").orderBy("_digest", "_id"))
    last = (keys.join(cuts, ["_label", "_range"]).withColumn("_turn", turn)
            .where(F.col("_turn") == F.col("k"))
            .groupBy("_label")
            .agg(*[F.max(F.when(F.col("cut") == c, F.struct("_digest", "_id"))).alias(f"_{c}")
                   for c in ("test", "val")]))
    here = F.struct(id_digest(F.col(row_id), seed).alias("_digest"), F.col(row_id).alias("_id"))
    joined = df.join(stage(last, "last"), F.col(label).eqNullSafe(F.col("_label")), "left")
    return joined.withColumn(
        "split", F.when(here <= F.col("_test"), "test").when(here <= F.col("_val"), "val")
        .otherwise("train")).drop("_label", "_test", "_val")


def split_tail(df: DataFrame, row_id: str, val_share: float = 0.2) -> DataFrame:
    """The last ``val_share`` of the rows, in id order, is the validation set."""
    ids = global_rank(df.select(F.col(row_id).alias("_id")), [F.col("_id")], "_rank")
    n = ids.agg(F.count("*").alias("n")).scalar()
    cut = stage(ids.where(F.col("_rank") == F.floor(n * F.lit(1 - val_share)).cast("long"))
                .agg(F.max("_id").alias("cut")), "cut")
    first_part = F.col(row_id) <= cut.scalar()
    return df.withColumn("split", F.when(first_part, "train").otherwise("val"))


def split(df: DataFrame, strategy: str, row_id: str = "id", **options) -> DataFrame:
    """Split by the name of the strategy; an unknown name raises."""
    known = {"trainValTest": split_three_way, "trainTest": split_two_way, "crossValidation": assign_folds}
    if strategy not in known:
        raise ValueError(f"unknown split strategy: {strategy}")
    return known[strategy](df, row_id, **options)
