"""Column functions on labels, scores and class names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.text import strip

# Label names and the class names each source uses.
POLARITY_NAMES = {0: "negative", 2: "neutral", 4: "positive"}
POSITIVE_CLASS_NAMES = ("1", "label", "Positive_1", "pos")
POSITIVE_TRUTH_NAMES = ("1", "positive", "pos")
POSITIVE, NEGATIVE = "positif", "negatif"


def recode_polarity(c: Column, mode: str = "keep") -> Column:
    """4 becomes 1; other values stay (``keep``) or become 0 (``binary``)."""
    if mode not in ("keep", "binary"):
        raise ValueError(f"unknown recode mode: {mode}")
    return F.when(c == 4, F.lit(1)).otherwise(c if mode == "keep" else F.lit(0)).cast("int")


def threshold_class(score: Column, threshold: float = 0.5, strict: bool = False) -> Column:
    """1 at or above the threshold (above it when ``strict``), else 0."""
    return ((score > threshold) if strict else (score >= threshold)).cast("int")


def map_label(c: Column, mapping: Mapping, default=None) -> Column:
    """Value-to-value lookup with a default for all other values."""
    out = F.lit(default)
    for key, value in mapping.items():
        out = F.when(c == F.lit(key), F.lit(value)).otherwise(out)
    return out


def sentiment_of_class(name: Column) -> Column:
    """Sentiment of a predicted class name."""
    return F.when(name.isin(*POSITIVE_CLASS_NAMES), POSITIVE).otherwise(NEGATIVE)


def sentiment_of_truth(name: Column) -> Column:
    """Sentiment of a true label, given as a number or a name."""
    return F.when(name.cast("string").isin(*POSITIVE_TRUTH_NAMES), POSITIVE).otherwise(NEGATIVE)


def class_of_sentiment(name: Column) -> Column:
    """0 for the negative sentiment, else 1."""
    return F.when(name == NEGATIVE, 0).otherwise(1)


def class_of_name(name: Column, positive: str = "label") -> Column:
    """1 for the positive class name of a scorer, else 0."""
    return (name == positive).cast("int")


def normalise_truth(name: Column) -> Column:
    """Lower-case label name without blanks around it."""
    return strip(F.lower(name))


def correctness(predicted: Column, truth: Column) -> Column:
    """``correct`` when the prediction equals the normalised truth."""
    return F.when(predicted == normalise_truth(truth), "correct").otherwise("incorrect")
