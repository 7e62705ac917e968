"""Quality by a sparse rule ensemble: tree paths as rules, lasso weights, Spark columns."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.session import stage

Condition = tuple[str, str, float]  # statistic, "<=" or ">", threshold


def with_statistics(df: DataFrame, text_col: str = "text", prefix: str = "s_") -> DataFrame:
    """``df`` and statistics of each whole text; a null text counts as an empty one."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")
    base = df.withColumns({
        "_n": F.length(text).cast("double"), "_words": words,
        "_letters": F.length(F.regexp_replace(text, r"[^\p{L}]+", "")),
        "_upper": F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")),
        "_digits": F.length(F.regexp_replace(text, r"[^\p{Nd}]+", "")),
        "_marks": F.length(F.regexp_replace(text, r"[\p{L}\p{N}\s]+", "")),
        "_bars": F.length(text) - F.length(F.replace(text, F.lit("|"), F.lit(""))),
        "_calls": F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit(""))),
        "_lines": F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))),
    })
    size = F.size("_words")
    again = F.filter(F.arrays_zip(F.slice("_words", F.lit(1), F.greatest(size - 1, F.lit(0))).alias("a"),
                                  F.slice("_words", F.lit(2), F.greatest(size - 1, F.lit(0))).alias("b")),
                     lambda p: p["a"] == p["b"])
    n, w = F.greatest("_n", F.lit(1.0)), F.greatest(size, F.lit(1))
    stats = {
        "chars": F.col("_n"), "words": size, "word_length": F.col("_n") / w, "letters": F.col("_letters") / n,
        "upper": F.col("_upper") / n, "digits": F.col("_digits") / n, "marks": F.col("_marks") / n,
        "bars": F.col("_bars") / n, "calls": F.col("_calls") / n, "lines": F.col("_lines") / n,
        "repeats": F.size(again) / w, "distinct": F.size(F.array_distinct("_words")) / w,
    }
    return base.withColumns({prefix + k: v.cast("double") for k, v in stats.items()}).drop(
        "_n", "_words", "_letters", "_upper", "_digits", "_marks", "_bars", "_calls", "_lines")


@dataclass
class Rules:
    """Conjunctive rules with weights; ``base`` is the score (log-odds) where none holds."""

    weighted: list[tuple[tuple[Condition, ...], float]]
    base: float

    def column(self, prefix: str = "s_") -> Column:
        """The ensemble as one column expression."""
        total = F.lit(self.base)
        for conditions, weight in self.weighted:
            total = total + F.when(holds(conditions, prefix), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def holds(conditions: tuple[Condition, ...], prefix: str = "s_") -> Column:
    out = F.lit(True)
    for name, sign, at in conditions:
        c = F.col(prefix + name)
        out = out & ((c <= at) if sign == "<=" else (c > at))
    return out


def tree_rules(text: str, names: list[str]) -> list[tuple[Condition, ...]]:
    """Every path from the root of a printed tree to one of its other nodes."""
    path: list[Condition] = []
    rules = []
    for line in text.splitlines():
        if m := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-\d.eE]+)\)", line):
            depth = len(m[1]) - 2
            del path[max(0, depth):]
            path.append((names[int(m[2])], m[3], float(m[4])))
            rules.append(tuple(sorted(path)))
    return rules


def train(docs: DataFrame, labels: DataFrame, rows: int = 20_000, trees: int = 20, depth: int = 3,
          lasso: float = 0.001, seed: int = 3, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Rules:
    """Rules from at most ``rows`` labelled rows, the first in the order of a hash of the id.

    The ids of the sample are bounded by ``rows`` and so are broadcast; documents are read
    once and not shuffled. Rows without a label teach nothing; null and empty texts do.
    With one class only, or no row, the score is constant.
    """
    marks = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("label"))
    picked = marks.where("label is not null").orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    sample = stage(with_statistics(texts.join(F.broadcast(picked), "id")).drop("text"), "sample")
    names = [c[2:] for c in sample.columns if c.startswith("s_")]
    share, n = sample.agg(F.avg("label"), F.count("*")).first()
    if not n or share in (0.0, 1.0):
        return Rules([], 0.0 if not n else 5.0 if share else -5.0)
    seen = VectorAssembler(inputCols=[f"s_{c}" for c in names], outputCol="features").transform(sample).select(
        "features", "label", *sample.columns[2:]).coalesce(4)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, maxBins=64,
                                    featureSubsetStrategy="sqrt").fit(seen)
    rules = sorted({r for tree in forest.trees for r in tree_rules(tree.toDebugString, names)})
    fired = F.array(*[F.when(holds(r), 1.0).otherwise(0.0) for r in rules])
    lasso_fit = LogisticRegression(elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=60).fit(
        seen.select("label", array_to_vector(fired).alias("features")))
    weights = lasso_fit.coefficients.toArray().tolist()
    return Rules([(r, w) for r, w in zip(rules, weights) if w], float(lasso_fit.intercept))


def score(docs: DataFrame, rules: Rules, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` and a score from 0 to 1 of each whole text, higher where label 1 is likelier.

    Native, row by row, without a shuffle. Null and empty texts score as texts whose
    statistics are all zero; repeated rows score alike; a column called ``name`` is replaced.
    """
    docs = docs.drop(name)
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(f"`{text_col}`").alias("text"))
    return with_statistics(whole).select("row.*", rules.column().alias(name))
