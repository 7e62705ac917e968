"""Column functions on text. All native: no Python runs per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode word and white-space classes, spelt out because
# Java's \w and \s are ASCII-only.
WORD = r"\p{L}\p{N}_"
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"

# Fixed value: the punctuation a word index drops (each becomes a blank).
INDEX_PUNCTUATION = r"""!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~\t\n"""


def strip(c: Column) -> Column:
    """Text without white space at both ends."""
    return F.regexp_replace(c, f"^[{SPACE}]+|[{SPACE}]+$", "")


def is_valid(c: Column) -> Column:
    """Neither null nor blank."""
    return c.isNotNull() & F.coalesce(c.rlike(f"[^{SPACE}]"), F.lit(False))


def is_present(c: Column) -> Column:
    """Neither null nor exactly empty (blanks count as text)."""
    return c.isNotNull() & (c != "")


def words(c: Column) -> Column:
    """White-space separated words of raw text; none for null or blank text."""
    return F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(f"[^{SPACE}]+"), F.lit(0))


def clean_words(c: Column) -> Column:
    """Words of text that is already single-spaced and trimmed.

    Names ``c`` once: inside a generator Spark evaluates every mention again.
    """
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), " "), "")


def word_count(c: Column, null_as_word: bool = False) -> Column:
    """Number of words; ``null_as_word`` counts a null as one word."""
    n = F.size(words(c)).cast("long")
    return F.when(c.isNull(), F.lit(1)).otherwise(n).cast("long") if null_as_word else n


def is_valid_bounded(c: Column, max_words: int = 10000) -> Column:
    """Not blank and at most ``max_words`` words."""
    # "At least one word" needs no count, so the words are counted once.
    return is_valid(c) & (word_count(c) <= max_words)


def clean_base(c: Column) -> Column:
    """Lower case; links, mentions, hashtags and punctuation out; single blanks.

    Mentions, hashtags and other punctuation go in one pass: removing the first
    two can never put a word character behind a ``#`` that had none.
    """
    c = F.lower(c)
    # Most texts hold no link, and a plain search costs less than a pattern.
    c = F.when(c.contains("http") | c.contains("www"),
               F.regexp_replace(c, f"(?:http|www)[^{SPACE}]+", "")).otherwise(c)
    c = F.regexp_replace(c, f"[@#][{WORD}]+|[^{WORD}{SPACE}]", "")
    return F.trim(F.regexp_replace(c, f"[{SPACE}]+", " "))


def squeeze_runs(c: Column) -> Column:
    """Three or more equal characters in a row become one."""
    return F.regexp_replace(c, r"(.)\1{2,}", "$1")


def clean_extended(c: Column) -> Column:
    """``clean_base``, then digits and emoji out and letter runs squeezed."""
    return extend_cleaning(clean_base(c))


def extend_cleaning(c: Column) -> Column:
    """The further steps on text that ``clean_base`` made.

    U+2139 is the one emoji that is a letter and so survives ``clean_base``.
    """
    c = F.regexp_replace(c, "[\\p{Nd}ℹ]+", "")
    return F.trim(F.regexp_replace(squeeze_runs(c), " +", " "))


def drop_words(tokens: Column, stop: Sequence[str]) -> Column:
    """Tokens outside ``stop``; repeats and order are kept."""
    stop = list(stop)
    return F.filter(tokens, lambda w: ~w.isin(stop)) if stop else tokens


def keep_long_enough(tokens: Column, min_length: int = 3) -> Column:
    """Tokens of at least ``min_length`` characters."""
    return F.filter(tokens, lambda w: F.length(w) >= min_length)


def feature_terms(c: Column) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"[{WORD}]{{2,}}"), F.lit(0))


def index_words(c: Column) -> Column:
    """Words for a word index: lower case, punctuation as blanks."""
    plain = F.trim(F.regexp_replace(F.lower(c), f"[{INDEX_PUNCTUATION} ]+", " "))
    return clean_words(plain)


def ngrams(tokens: Column, low: int, high: int) -> Column:
    """All word n-grams of the lengths ``low`` to ``high``, joined by a blank."""
    grams = []
    for n in range(low, high + 1):
        size = F.greatest(F.size(tokens) - (n - 1), F.lit(0))
        joined = F.slice(tokens, F.lit(1), size)
        for shift in range(1, n):
            joined = F.zip_with(joined, F.slice(tokens, F.lit(shift + 1), size),
                                lambda a, b: F.concat(a, F.lit(" "), b))
        grams.append(joined)
    return F.concat(*grams)
