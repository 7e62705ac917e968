import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.functions import text
from lexmill.functions.stopwords import ENGLISH

CASES = [  # raw, base cleaning, extended cleaning
    ("@bob I'm SO happy!!! see http://t.co/x1 #win", "im so happy see", "im so happy see"),
    ("   ", "", ""),
    ("https://a.b", "", ""),
    ("don't stop_now -- cooool 2day", "dont stop_now cooool 2day", "dont stop_now col day"),
    ("mail joe@site.com now", "mail joecom now", "mail joecom now"),
    ("#tag#tag2 @a@b", "", ""),
    ("www.x.y/z,next word", "word", "word"),
    ("wwwhat httpie is", "is", "is"),
    ("Soooo   good\t\nday", "soooo good day", "so good day"),
    ("ℹ️ info 😀 1️⃣ ①", "ℹ info 1 ①", "info ①"),
    ("été À L'ÉCOLE", "été à lécole", "été à lécole"),
    ("null", "null", "null"),
    (None, None, None),
]


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[1] for r in sorted(df.select("i", f(F.col("t"))).collect())]


def python_clean(t):
    t = t.lower()
    for p in (r"http\S+|www\S+", r"@\w+", r"#\w+", r"[^\w\s]"):
        t = re.sub(p, "", t)
    return re.sub(r"\s+", " ", t).strip()


def test_cleaning_cases(spark):
    raw, base, extended = zip(*CASES)
    assert column(spark, raw, text.clean_base) == list(base)
    assert column(spark, raw, text.clean_extended) == list(extended)


TEXTS = st.lists(st.text(alphabet="ab1_ \t\n@#!.,'é-À/:htpw \x85", max_size=40), min_size=1, max_size=200)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_cleaning_equals_python(spark, texts):
    assert column(spark, texts, text.clean_base) == [python_clean(t) for t in texts]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(TEXTS)
def test_cleaning_is_idempotent_and_words_match_python(spark, texts):
    once = column(spark, texts, text.clean_base)
    stable = [t for t in once if "http" not in t and "www" not in t]
    if stable:
        assert column(spark, stable, text.clean_base) == stable
    assert column(spark, texts, text.words) == [t.split() for t in texts]
    assert column(spark, texts, text.word_count) == [len(t.split()) for t in texts]
    assert column(spark, texts, text.is_valid) == [bool(t.strip()) for t in texts]


def test_validity(spark):
    values = ["good day", "", None, " ", "bad", "a b c"]
    assert column(spark, values, text.is_valid) == [True, False, False, False, True, True]
    assert column(spark, values, text.is_present) == [True, False, False, True, True, True]
    assert column(spark, values, lambda c: text.is_valid_bounded(c, 2)) == [True, False, False, False, True, False]
    assert column(spark, values, lambda c: text.word_count(c, null_as_word=True)) == [2, 0, 1, 0, 1, 3]


def test_tokens(spark):
    assert len(ENGLISH) == 179
    stop = column(spark, ["the cat and the hat"], lambda c: text.drop_words(text.clean_words(c), ENGLISH))
    assert stop == [["cat", "hat"]]
    grams = column(spark, ["a b c", "a", ""], lambda c: text.ngrams(text.clean_words(c), 1, 2))
    assert grams == [["a", "b", "c", "a b", "b c"], ["a"], []]
    assert column(spark, ["Good, day-out!", None], text.index_words) == [["good", "day", "out"], []]
    assert column(spark, ["A bb, ccc d_d", None], text.feature_terms) == [["bb", "ccc", "d_d"], []]


def test_insets_not_linear_search(spark):
    df = spark.createDataFrame([("a b",)], "t string").select(text.drop_words(text.clean_words(F.col("t")), ENGLISH))
    assert "INSET" in df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("mode,want", [("keep", [0, 2, 1]), ("binary", [0, 0, 1])])
def test_recode(spark, mode, want):
    from lexmill.functions.labels import recode_polarity

    df = spark.createDataFrame([(0,), (2,), (4,)], "p int")
    assert [r[0] for r in df.select(recode_polarity(F.col("p"), mode)).collect()] == want
    with pytest.raises(ValueError):
        recode_polarity(F.col("p"), "other")


def test_class_names(spark):
    from lexmill.functions import labels

    names = ["1", "label", "Positive_1", "pos", "neg", "0"]
    assert column(spark, names, labels.sentiment_of_class) == ["positif"] * 4 + ["negatif"] * 2
    assert column(spark, ["positive", "1", "0"], labels.sentiment_of_truth) == ["positif", "positif", "negatif"]
    assert column(spark, [" Positif ", "negatif"], lambda c: labels.correctness(F.lit("positif"), c)) == [
        "correct", "incorrect"]


def test_arrays(spark):
    from lexmill.functions import arrays

    df = spark.createDataFrame([([1, 2, 3, 4],), ([1],)], "a array<int>")
    pad = lambda how: [r[0] for r in df.select(arrays.pad(F.col("a"), 3, F.lit(0), how)).collect()]
    assert pad("pre") == [[2, 3, 4], [1, 0, 0]]
    assert pad("post") == [[1, 2, 3], [1, 0, 0]]
    assert [r[0] for r in df.select(arrays.argmax(F.col("a"))).collect()] == [3, 0]
    assert [r[0] for r in df.select(arrays.mean_or_scalar(F.col("a"))).collect()] == [2.5, 1.0]
    assert [r[0] for r in df.select(arrays.dot(F.col("a"), F.col("a"))).collect()] == [30.0, 1.0]
