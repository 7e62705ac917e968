"""End-to-end flows: raw posts to prepared tables, features, model and report."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexmill.functions.labels import recode_polarity
from lexmill.functions.text import clean_base, clean_extended, clean_words, feature_terms
from lexmill.operators.features import fit_idf, tfidf
from lexmill.operators.filters import keep_valid
from lexmill.operators.metrics import classification_report
from lexmill.operators.models import fit_text_vectors, logistic
from lexmill.operators.relational import attach_labels, dedup_by_id, dedup_by_text, sync_labels
from lexmill.operators.scoring import prediction_log, route, validate_requests
from lexmill.operators.splits import split_stratified_exact
from lexmill.operators.words import filter_frequent, keep_vocabulary, lemmatize, prepare_tokens, repair_words
from lexmill.session import stage
from lexmill.sources.schemas import require_columns
from lexmill.sources.writers import feature_table, label_table


def split_posts(posts: DataFrame, order: Column | None = None, test_size: str = "0.005",
                val_size: str = "0.07", seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Raw posts to (features, labels), de-duplicated and split, each with a column ``split``.

    ``order`` says which of several equal posts is first; by default the one whose
    (id, text) sorts first.
    """
    require_columns(posts, "post_id", "polarity", "text")
    posts = posts.withColumn("polarity", recode_polarity(F.col("polarity")))
    first = order if order is not None else F.struct("post_id", "text")
    unique = dedup_by_text(dedup_by_id(posts, "post_id", first), "text", first)
    marked = split_stratified_exact(stage(unique, "posts"), "post_id", "polarity", test_size, val_size, seed)
    return feature_table(marked, "post_id", "text"), label_table(marked, "post_id", "polarity")


def normalise_words(clean: DataFrame, stop: Sequence[str] = (), min_length: int | None = None,
                    lexicon: DataFrame | None = None, allowed: DataFrame | None = None) -> DataFrame:
    """Word steps on staged clean text, in their fixed order.

    Stop words and short words go before lemmatising, the allowed vocabulary comes after it.
    """
    tokens = prepare_tokens(F.col("feature"), list(stop), min_length)
    if lexicon is not None:
        words = lemmatize(clean, "id", tokens, lexicon)
    else:
        words = clean.select("id", F.concat_ws(" ", tokens).alias("feature"))
    if allowed is not None:
        words = keep_vocabulary(stage(words, "words"), "id", clean_words(F.col("feature")), allowed)
    return words


def preprocess_posts(posts: DataFrame, stop: Sequence[str], min_length: int = 3,
                     lexicon: DataFrame | None = None, allowed: DataFrame | None = None) -> DataFrame:
    """(id, feature): extended cleaning, then the word steps."""
    clean = stage(posts.select("id", clean_extended(F.col("feature")).alias("feature")), "clean")
    return normalise_words(clean, stop, min_length, lexicon, allowed)


def repair_and_filter(posts: DataFrame, allowed: DataFrame, min_count: int = 5,
                      max_word_length: int = 20) -> DataFrame:
    """(id, feature): known words kept, glued words split, then words rare in the result dropped."""
    repaired = stage(repair_words(posts, "id", clean_words(F.col("feature")), allowed, max_word_length), "repaired")
    return filter_frequent(repaired, "id", clean_words(F.col("feature")), min_count)


def clean_and_sync(x: DataFrame, y: DataFrame, stop: Sequence[str] = (), lexicon: DataFrame | None = None
                   ) -> tuple[DataFrame, DataFrame]:
    """Base cleaning and word steps on all splits, then only valid rows and their labels.

    The cleaned table is written before it is filtered: a filter on a cleaned column
    would be pushed below the cleaning and clean every text twice.
    """
    clean = stage(x.withColumn("feature", clean_base(F.col("feature"))), "clean")
    if stop or lexicon is not None:
        words = normalise_words(clean, stop, lexicon=lexicon)
        clean = stage(clean.drop("feature").join(words, "id"), "words")
    valid = keep_valid(clean)
    return valid, sync_labels(valid, y)


def serve(requests: DataFrame, scorer: Callable[[DataFrame], DataFrame], response_ms: Column, *keep: str,
          body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(log, rejected): requests checked, scored and logged; those that fail the check keep code and reason.

    ``scorer`` adds ``predicted_sentiment`` to rows with ``tweet``. Works on a table and on a stream.
    """
    accepted, rejected = route(validate_requests(requests, body, with_truth=True))
    log = prediction_log(scorer(accepted), "tweet", F.col("predicted_sentiment"), F.col("true_label"), response_ms, *keep)
    return log, rejected


def top_terms_by_class(x: DataFrame, y: DataFrame, k: int = 10) -> DataFrame:
    """(label, term, weight): the terms of greatest total TF-IDF weight per class, train split."""
    train = stage(attach_labels(x.where(F.col("split") == "train"), y.select("id", "label"))
                  .select("id", "label", feature_terms(F.col("feature")).alias("tokens")), "tokens")
    weights = tfidf(train, "id", F.col("tokens"), stage(fit_idf(train, F.col("tokens")), "idf"))
    sums = (weights.join(train.select("id", "label"), "id").groupBy("label", "term")
            .agg(F.round(F.sum("weight"), 6).alias("weight")))
    place = F.row_number().over(W.partitionBy("label").orderBy(F.desc("weight"), "term"))
    return sums.withColumn("place", place).where(F.col("place") <= k).drop("place")


def train_and_report(x: DataFrame, y: DataFrame, max_features: int | None = None, **params):
    """(vectors, model, report): TF-IDF and logistic regression on train, report on test."""
    rows = attach_labels(x, y.select("id", "label")).withColumn("tokens", clean_words(F.col("feature")))
    rows = stage(rows.select("id", "split", "label", "tokens"), "rows")
    train = rows.where(F.col("split") == "train")
    vectors = fit_text_vectors(train, max_features=max_features)
    ready = stage(vectors.transform(train).select("id", "label", "features"), "vectors")
    model = logistic(ready.count(), **params).fit(ready)
    scored = model.transform(vectors.transform(rows.where(F.col("split") == "test")))
    return vectors, model, classification_report(
        scored.withColumn("prediction", F.col("prediction").cast("int")), "label", "prediction")
