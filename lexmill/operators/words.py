"""Word-level operators.

What depends on a word alone (lemma, stem, split of glued words) is computed once
per distinct word and joined back to the texts. Post ids must be unique, and a
vocabulary holds each word once, as ``corpus.vocabulary`` makes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import clean_words, drop_words, is_valid, keep_long_enough
from lexmill.operators.corpus import frequent_words, vocabulary
from lexmill.operators.lookup import by_id, flat_words, known_words, with_entries
from lexmill.session import stage

# Noun endings and what replaces them, tried in this order.
NOUN_ENDINGS = (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
                ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"))


def explode_tokens(df: DataFrame, row_id: str, tokens: Column) -> DataFrame:
    """(id, pos, word); a text without words keeps one row with a null word."""
    return df.select(F.col(row_id), F.posexplode_outer(tokens).alias("pos", "word"))


def rebuild_text(tokens: DataFrame, row_id: str, word: str = "word", name: str = "feature") -> DataFrame:
    """Words back to one text per id, in position order; null words drop out.

    A group is one text, so it is as long as one input row at most.
    """
    joined = F.expr(f"listagg(`{word}`, ' ') within group (order by pos)")
    return tokens.groupBy(row_id).agg(F.coalesce(joined, F.lit("")).alias(name))


def translate_words(df: DataFrame, row_id: str, tokens: Column, table: DataFrame,
                    keep_unknown: bool, name: str = "feature") -> DataFrame:
    """Replace each word by its entry in ``table`` (word, new_word), which holds a word once.

    A word without an entry stays or drops out. One text per id, in position order.
    """
    def rebuild(texts, entries):
        import pyarrow as pa
        import pyarrow.compute as pc

        rows, places, old, at = flat_words(texts, known_words(entries))
        new = entries.column("new_word").combine_chunks().cast(pa.string()).take(pa.array(at, mask=at < 0))
        new = pc.coalesce(new, old) if keep_unknown else new
        ids, lists = by_id(texts, rows, places, new, new.is_valid().to_numpy(zero_copy_only=False))
        return pa.table({row_id: ids, name: pc.binary_join(lists, " ")})

    schema = f"`{row_id}` {df.schema[row_id].dataType.simpleString()}, `{name}` string"
    return with_entries(df, row_id, tokens, table.select("word", "new_word"), rebuild, schema)


def keep_vocabulary(df: DataFrame, row_id: str, tokens: Column, allowed: DataFrame,
                    name: str = "feature") -> DataFrame:
    """Keep the words found in ``allowed`` (column word), in order."""
    table = allowed.select("word").distinct().select("word", F.col("word").alias("new_word"))
    return translate_words(df, row_id, tokens, table, keep_unknown=False, name=name)


def keep_words_with_vector(df: DataFrame, row_id: str, text: str, vectors: DataFrame
                           ) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): words without a vector drop out; blank texts go to the rejects.

    A word without a vector has no nearest neighbour either, so nothing replaces it.
    """
    ok = is_valid(F.col(text))
    kept = keep_vocabulary(df.where(ok), row_id, clean_words(F.col(text)), vectors)
    return kept, df.where(~ok)


def filter_frequent(df: DataFrame, row_id: str, tokens: Column, min_count: int = 5) -> DataFrame:
    """Keep the words seen at least ``min_count`` times in the corpus."""
    often = stage(frequent_words(vocabulary(df, tokens), min_count).select("word"), "frequent")
    return keep_vocabulary(df, row_id, tokens, often)


def token_coverage(df: DataFrame, row_id: str, tokens: Column, allowed: DataFrame) -> DataFrame:
    """Per text: number of words and of words found in ``allowed``."""
    marked = allowed.select("word").distinct().withColumn("known", F.lit(1))
    found = explode_tokens(df, row_id, tokens).join(marked, "word", "left")
    return found.groupBy(row_id).agg(F.count("word").alias("n_tokens"),
                                     F.count("known").alias("n_known"))


# --- lemmas -----------------------------------------------------------------------------------

def _detached(forms: Column) -> Column:
    """All results of one detachment over an array of forms, in rule order."""
    def each(form: Column) -> Column:
        options = [F.when(form.endswith(end),
                          F.concat(form.substr(F.lit(1), F.length(form) - len(end)), F.lit(new)))
                   for end, new in NOUN_ENDINGS]
        return F.array_compact(F.array(*options))
    return F.flatten(F.transform(forms, each))


def lemma_table(vocab: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(word, new_word) for the words that have a lemma in ``lexicon`` (column word).

    Candidates are the word and its one-step detachments; further steps count only if
    no earlier one is in the lexicon. Among candidates of a step the shortest wins, the earliest rule on ties.
    All steps of a word are made inside its row, so this is one pass over the vocabulary however long a word is. Forms
    longer than the longest entry cannot match and are not kept; a run of ``s`` that reaches beyond it is cut down to it first,
    since only one ``s`` a step comes off such a run.
    """
    lexicon = stage(lexicon.select("word").distinct(), "lexicon")
    longest = lexicon.agg(F.coalesce(F.max(F.length("word")), F.lit(0)).alias("n")).scalar()
    base = F.regexp_replace("word", "s+\\z", "")
    run = F.length("word") - F.length(base)
    room = F.greatest(F.lit(2), F.col("_longest") + 2 - F.length(base))
    rows = vocab.select("word", longest.alias("_longest")).withColumn(
        "_w", F.when(run > room, F.concat(base, F.repeat(F.lit("s"), room))).otherwise(F.col("word")))
    steps = F.when(F.col("_w").rlike("(s|men)\\z"), F.sequence(F.lit(1), F.length("_w"))).otherwise(
        F.array().cast("array<int>"))

    def options(forms: Column, step: Column, first: int) -> Column:
        listed = F.transform(forms, lambda f, i: F.struct(step.cast("int").alias("step"), F.length(f).alias("size"),
                                                          (i + first).cast("int").alias("rule"), f.alias("form")))
        return F.filter(listed, lambda x: x["size"] <= F.col("_longest"))

    def further(state: Column, k: Column) -> Column:
        forms = F.array_distinct(_detached(state["forms"]))
        return F.struct(forms.alias("forms"), F.concat(state["options"], options(forms, k - 1, 1)).alias("options"))

    start = F.struct(F.array("_w").alias("forms"), options(F.array("_w"), F.lit(0), 0).alias("options"))
    found = rows.select("word", F.explode(F.aggregate(steps, start, further)["options"]).alias("x")).select("word", "x.*")
    known = lexicon.select(F.col("word").alias("form"))
    return found.join(known, "form", "left_semi").groupBy("word").agg(
        F.min_by("form", F.struct("step", "size", "rule")).alias("new_word"))


def lemmatize(df: DataFrame, row_id: str, tokens: Column, lexicon: DataFrame) -> DataFrame:
    """Each word replaced by its lemma; words without one stay."""
    table = stage(lemma_table(vocabulary(df, tokens), lexicon)
                  .where(F.col("word") != F.col("new_word")), "lemmas")
    return translate_words(df, row_id, tokens, table, keep_unknown=True)


# --- glued words ------------------------------------------------------------------------------

def segment_table(unknown: DataFrame, allowed: DataFrame) -> DataFrame:
    """(word, new_word): the first split of a word into two words of ``allowed``.

    Only split points that leave both halves no longer than the longest allowed word
    can succeed, so a long junk word yields few candidates or none.
    """
    allowed = allowed.select("word")
    longest = allowed.agg(F.max(F.length("word")).alias("n")).scalar()
    size = F.length("word")
    first, last = F.greatest(F.lit(1), size - longest), F.least(size - 1, longest)
    points = (unknown.select("word")
              .withColumn("_first", first).withColumn("_last", last)
              .where(F.col("_first") <= F.col("_last"))
              .select("word", F.explode(F.sequence("_first", "_last")).alias("i")))
    halves = points.select("word", "i", F.col("word").substr(F.lit(1), F.col("i")).alias("left_half"),
                           F.col("word").substr(F.col("i") + 1, F.length("word")).alias("right_half"))
    for half in ("left_half", "right_half"):
        halves = halves.join(allowed.withColumnRenamed("word", half), half, "left_semi")
    return halves.groupBy("word").agg(
        F.min_by(F.concat_ws(" ", "left_half", "right_half"), "i").alias("new_word"))


def repair_table(vocab: DataFrame, allowed: DataFrame, max_word_length: int | None = None) -> DataFrame:
    """(word, new_word): known words as they are, other words split where possible.

    With ``max_word_length`` a longer word is never kept as it is, only split.
    """
    allowed = allowed.select("word")
    keep = allowed if max_word_length is None else allowed.where(F.length("word") <= max_word_length)
    words = vocab.select("word")
    kept = words.join(keep, "word", "left_semi").select("word", F.col("word").alias("new_word"))
    return kept.unionByName(segment_table(words.join(keep, "word", "left_anti"), allowed))


def repair_words(df: DataFrame, row_id: str, tokens: Column, allowed: DataFrame,
                 max_word_length: int | None = 20) -> DataFrame:
    """Keep known words, split glued ones, drop the rest."""
    table = stage(repair_table(stage(vocabulary(df, tokens), "vocab"), allowed, max_word_length), "repairs")
    return translate_words(df, row_id, tokens, table, keep_unknown=False)


# --- stems ------------------------------------------------------------------------------------

# Porter's suffix tables (M. F. Porter, "An algorithm for suffix stripping", 1980)
# with the later additions of common implementations.
STEP_2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
          "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
          "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
          "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
          "fulli": "ful", "logi": "log"}
STEP_3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP_4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
          "ou", "ism", "ate", "iti", "ous", "ive", "ize")
IRREGULAR_STEMS = {"sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
                   "news": "news", "innings": "inning", "inning": "inning", "outings": "outing",
                   "outing": "outing", "cannings": "canning", "canning": "canning", "howe": "howe",
                   "proceed": "proceed", "exceed": "exceed", "succeed": "succeed"}

# Consonant run, vowel run, and the patterns over them that the rules ask for.
_C, _V = "[^aeiou][^aeiouy]*", "[aeiouy][aeiou]*"
_HAS_VOWEL = f"^(?:{_C})?[aeiouy]"
_M_OVER_0 = f"^(?:{_C})?{_V}{_C}"
_M_IS_1 = f"^(?:{_C})?{_V}{_C}(?:{_V})?$"
_M_OVER_1 = f"^(?:{_C})?{_V}{_C}{_V}{_C}"
_SHORT_END = f"^(?:{_C}[aeiouy][^aeiouwxy]|[aeiou][^aeiou])$"
_DOUBLE = r"([^aeiou])\1$"


def _ending(w: Column, suffixes) -> tuple[Column, Column]:
    """(stem, longest matching suffix); the suffix is empty when none matches."""
    choice = "|".join(sorted(suffixes, key=len, reverse=True))
    suffix = F.regexp_extract(w, f"({choice})$", 1)
    return F.substring(w, F.lit(1), F.length(w) - F.length(suffix)), suffix


def stem_table(vocab: DataFrame) -> DataFrame:
    """(word, new_word): the Porter stem of each distinct word, in native expressions."""
    df = vocab.select("word", F.lower("word").alias("w"))

    def step(name: str, column: Column) -> None:
        nonlocal df
        df = df.withColumn(name, column)

    w = F.col("w")
    # 1a: plurals.
    step("w", F.when(w.rlike("^.ies$"), F.regexp_replace(w, "s$", ""))
         .otherwise(F.regexp_replace(F.regexp_replace(w, "(ss|i)es$", "$1"), "([^s])s$", "$1")))
    # 1b: -eed, -ed, -ing and the repair of what they leave.
    base = F.regexp_extract(w, "^(.*)(ed|ing)$", 1)
    step("cut", F.when(w.endswith("ied") | w.endswith("eed"), F.lit(None))
         .when(w.rlike("(ed|ing)$") & base.rlike(_HAS_VOWEL), base))
    cut = F.col("cut")
    repaired = (F.when(cut.rlike("(at|bl|iz)$"), F.concat(cut, F.lit("e")))
                .when(cut.rlike(_DOUBLE), F.when(cut.rlike("[lsz]$"), cut)
                      .otherwise(F.regexp_replace(cut, ".$", "")))
                .when(cut.rlike(_M_IS_1) & cut.rlike(_SHORT_END), F.concat(cut, F.lit("e")))
                .otherwise(cut))
    step("w", F.when(w.rlike("^.ied$"), F.regexp_replace(w, "d$", ""))
         .when(w.endswith("ied"), F.regexp_replace(w, "ed$", ""))
         .when(w.endswith("eed"), F.when(F.regexp_replace(w, "eed$", "").rlike(_M_OVER_0),
                                         F.regexp_replace(w, "d$", "")).otherwise(w))
         .when(cut.isNotNull(), repaired).otherwise(w))
    # 1c: final y after a consonant that is not the first letter.
    step("w", F.when(w.rlike("..y$") & w.rlike("(?:[^aeiouy]|[aeiou]y)y$"),
                     F.regexp_replace(w, "y$", "i")).otherwise(w))
    # 2 and 3: double suffixes. -alli goes first and its result may match again.
    bare = F.regexp_replace(w, "alli$", "")
    step("w", F.when(w.endswith("alli") & bare.rlike(_M_OVER_0), F.concat(bare, F.lit("al"))).otherwise(w))
    for table in (STEP_2, STEP_3):
        stem, suffix = _ending(w, table)
        step("suffix", suffix)
        step("stem", stem)
        new = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[F.col("suffix")]
        measured = F.when(F.col("suffix") == "logi", F.concat("stem", F.lit("l"))).otherwise(F.col("stem"))
        step("w", F.when((F.col("suffix") != "") & measured.rlike(_M_OVER_0),
                         F.concat("stem", new)).otherwise(w))
    # 4: single suffixes behind a long stem.
    stem, suffix = _ending(w, STEP_4)
    step("suffix", suffix)
    step("stem", stem)
    step("w", F.when((F.col("suffix") != "") & F.col("stem").rlike(_M_OVER_1)
                     & ((F.col("suffix") != "ion") | F.col("stem").rlike("[st]$")),
                     F.col("stem")).otherwise(w))
    # 5: final e and double l.
    bare = F.regexp_replace(w, "e$", "")
    step("w", F.when(w.endswith("e") & (bare.rlike(_M_OVER_1)
                                        | (bare.rlike(_M_IS_1) & ~bare.rlike(_SHORT_END))),
                     bare).otherwise(w))
    step("w", F.when(w.endswith("ll") & F.regexp_replace(w, "l$", "").rlike(_M_OVER_1),
                     F.regexp_replace(w, "l$", "")).otherwise(w))
    lower = F.lower("word")
    irregular = F.create_map(*[F.lit(x) for pair in IRREGULAR_STEMS.items() for x in pair])[lower]
    return df.select("word", F.coalesce(irregular, F.when(F.length("word") <= 2, lower), w)
                     .alias("new_word"))


def stem_words(df: DataFrame, row_id: str, tokens: Column) -> DataFrame:
    """Each word replaced by its stem."""
    table = stage(stem_table(vocabulary(df, tokens)), "stems")
    return translate_words(df, row_id, tokens, table, keep_unknown=True)


# --- combinations -----------------------------------------------------------------------------

def normalize(df: DataFrame, row_id: str, text: str, technique: str | None = None,
              lexicon: DataFrame | None = None) -> DataFrame:
    """(id, feature) by ``lemmatization``, ``stemming`` or, for any other name, unchanged."""
    tokens = clean_words(F.col(text))
    if technique == "lemmatization":
        if lexicon is None:
            raise ValueError("lemmatization needs a lexicon")
        return lemmatize(df, row_id, tokens, lexicon)
    if technique == "stemming":
        return stem_words(df, row_id, tokens)
    return df.select(row_id, F.col(text).alias("feature"))


def prepare_tokens(clean: Column, stop: list[str], min_length: int | None = None) -> Column:
    """Words of cleaned text without stop words and, if asked, short words.

    Both tests look at the word before it is lemmatised.
    """
    tokens = drop_words(clean_words(clean), stop)
    return tokens if min_length is None else keep_long_enough(tokens, min_length)
