"""Pair encoding, phrases and spelling variants against the library and brute force, and on awkward input."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lexmill.llm import bpe, phrases, variants
from lexmill.llm.tokens import read_tokenizer

DOC = "doc_id long, text string, lang string"


@pytest.fixture(scope="module")
def plan():
    return read_tokenizer(public_tokenizers.path("word_bpe_49k.json"))


# --- byte-pair encoding ---------------------------------------------------------------------------

def awkward_texts():
    rng = random.Random(11)
    mixed = "abcdefghij zeéèü '’sS.,!?0123456789İΣσ  ́日本語🙂\r\n\t\x0b\x1c\x85ſßẞﬁ"
    return [None, "", " ", "a" * 5_000, "ab" * 3_000, "é" * 999, "!" * 3_000, "I'LL'don'T 'S",
            "<|endoftext|>x<|startoftext|> <|endoftext|", "x" * 200_000,
            *["".join(rng.choice(mixed) for _ in range(rng.randint(0, 60))) for _ in range(400)],
            *["".join(rng.choice("aeinstr") for _ in range(rng.randint(0, 60))) for _ in range(400)],
            *["".join(chr(rng.choice([rng.randint(1, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(30))
              for _ in range(200)]]


def test_bpe_equals_the_library(spark, plan):
    texts = awkward_texts() + ["again", "again"]
    library = Tokenizer.from_str(plan)
    docs = spark.createDataFrame([(k, t, "x", b"kept") for k, t in enumerate(texts)],
                                 "doc_id long, text string, ids string, decoded binary")
    coded = bpe.encode_texts(docs, plan)
    assert coded.columns == ["doc_id", "text", "decoded", "ids"]
    out = {r["doc_id"]: r for r in bpe.decode_ids(coded, plan).collect()}
    for k, text in enumerate(texts):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(out[k]["ids"], "<u4").tolist() == want
        assert out[k]["decoded"] == library.decode(want, skip_special_tokens=False)


def test_bpe_of_an_empty_table(spark, plan):
    rows = bpe.decode_ids(bpe.encode_texts(spark.createDataFrame([], DOC), plan), plan)
    assert rows.columns == ["doc_id", "text", "lang", "ids", "decoded"] and rows.count() == 0


def merged(word, merges):
    """Pair merging by its definition: the earliest merge first, from the left."""
    rank = {tuple(m): k for k, m in enumerate(merges)}
    while True:
        due = [(rank[p], k) for k, p in enumerate(zip(word, word[1:])) if p in rank]
        if not due:
            return word
        k = min(due)[1]
        word = word[:k] + [word[k] + word[k + 1]] + word[k + 2:]


@pytest.mark.parametrize("seed", range(20))
def test_backtracking_equals_merging(seed):
    """Small made-up vocabularies: overlapping merges, and tokens that merging never reaches."""
    rng = random.Random(seed)
    names, merges = list("abc"), []
    while len(merges) < 25:
        left, right = rng.choice(names), rng.choice(names)
        if left + right not in names and len(left + right) < 9:
            merges.append([left, right])
            names.append(left + right)
    tables = bpe.MergeTables({"model": {"vocab": {n: k for k, n in enumerate(names)}, "merges": merges}})
    for _ in range(200):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(1, 40)))
        assert [names[k] for k in tables.encode(word)] == merged(list(word), merges)


def test_bpe_refuses_other_tokenizers():
    with pytest.raises(ValueError):
        bpe.WordEncoder(read_tokenizer(public_tokenizers.path("byte_bpe_50k.json")))


# --- phrases --------------------------------------------------------------------------------------

def brute_phrases(rows, least, longest, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, totals = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            ws = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(ws)
            counts.update((lang, tuple(ws[i:i + k])) for k in range(1, longest + 1) for i in range(len(ws) - k + 1))
    often = {p: n for p, n in counts.items() if n >= least}
    inside = defaultdict(int)
    for (lang, ws), n in often.items():
        for k in range(1, len(ws)):
            for i in range(len(ws) - k + 1):
                inside[lang, ws[i:i + k]] = max(inside[lang, ws[i:i + k]], n)
    found = defaultdict(list)
    for (lang, ws), a in often.items():
        if len(ws) > 1 and inside[lang, ws] < a:
            score, _, l, r = min((1000 * a * totals[lang] // (often[lang, ws[:k]] * often[lang, ws[k:]]), k,
                                  often[lang, ws[:k]], often[lang, ws[k:]]) for k in range(1, len(ws)))
            found[lang].append((-score, -a, " ".join(ws).encode(), l, r))
    return {(lang, k): (p.decode(), -a, l, r, totals[lang], -s) for lang, each in found.items()
            for k, (s, a, p, l, r) in enumerate(sorted(each)[:top], 1)}


def phrase_rows(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "x\x00y", "\xa0", "New", "york", "a", "b", "퟿", "z\x1cz"]
    rows = [(k, "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", " "])
                        for _ in range(rng.randint(0, 30))), rng.choice(["en", "fr", None, "und"])) for k in range(n)]
    return rows + [(n, None, "en"), (n + 1, "", None), (n + 2, "a b " * 4_000, "en"), (n + 3, "...", "en"),
                   *rows[:20], (None, "new york a b", None)]


@pytest.mark.parametrize("share,least", [(2, 4), (8, 6), (10 ** 9, 4)])
def test_phrases_equal_brute_force(spark, monkeypatch, share, least):
    """With a sample of nothing every phrase is found by the border and the passes after it."""
    monkeypatch.setattr(phrases, "TOKENS", 500)
    rows = phrase_rows(share % 97, 150)
    docs = spark.createDataFrame(rows, DOC).repartition(5).withColumn("phrase", F.lit("other"))
    got = phrases.collocations(docs, least, 5, 40, share=share).collect()
    assert {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got} == (
        brute_phrases(rows, least, 5, 40))


def test_full_filters_lose_no_phrase(spark, monkeypatch):
    """A filter that is much too small costs counts, not results."""
    monkeypatch.setattr(phrases, "LEAST_BITS", 15)
    monkeypatch.setattr(phrases, "MOST_BITS", 15)
    rng = random.Random(5)
    rows = [(k, " ".join(f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(200)), "en") for k in range(150)]
    got = phrases.collocations(spark.createDataFrame(rows, DOC), 3, 4, 500, share=4).collect()
    assert {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got} == (
        brute_phrases(rows, 3, 4, 500))


def test_phrases_of_an_empty_table(spark):
    assert phrases.collocations(spark.createDataFrame([], DOC)).collect() == []


def test_score_is_exact_beyond_64_bits(spark):
    rows = [(10 ** 11 + 7, 10 ** 14 + 3, 10 ** 12 + 9, 10 ** 11 + 7), (3, 10 ** 15 - 1, 7, 11)]
    got = spark.createDataFrame(rows, "a long, n long, l long, r long").select(
        phrases.cut_score("a", "n", "l", "r").alias("s")).collect()
    assert [r["s"] for r in got] == [1000 * a * n // (l * r) for a, n, l, r in rows]


# --- spelling variants ----------------------------------------------------------------------------

def brute_groups(counts, factor=10):
    by_gap, near = defaultdict(set), defaultdict(set)
    for w in counts:
        for k in range(len(w)):
            by_gap[w[:k], w[k + 1:]].add(w)
            if w[:k] + w[k + 1:] in counts:
                near[w].add(w[:k] + w[k + 1:])
                near[w[:k] + w[k + 1:]].add(w)
    for group in by_gap.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= factor * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (n, form.get(w), root(w), len(near[w]), counts.get(form.get(w))) for w, n in counts.items()}


def groups(spark, counts, **options):
    rows = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = variants.spelling_groups(rows, **options).collect()
    assert len(got) == len(counts)
    return {r["word"]: (r["n"], r["form"], r["root"], r["n_near"], r["form_n"]) for r in got}


@pytest.mark.parametrize("block", [20, 10_000])
def test_near_words_equal_brute_force(spark, block):
    """Few letters, so that many words are near; a hot beginning that fills several blocks."""
    rng = random.Random(block)
    counts = {}
    for _ in range(500):
        w = "".join(rng.choice("abé÷") for _ in range(rng.randint(7, 9)))
        counts[w] = int(2 * 10 ** rng.uniform(0, 6))
    for _ in range(300):
        counts["aaaaaaa" + "".join(rng.choice("ab") for _ in range(rng.randint(0, 7)))] = rng.randint(2, 10 ** 5)
    counts["ÿ" * 3_000] = 5
    counts["ÿ" * 3_001] = 50
    assert groups(spark, counts, block=block) == brute_groups(counts)


def test_index_finds_each_kind_of_change():
    index = variants.WordIndex(sorted(["abcdefg", "abcdefgh", "abcdxfg", "zbcdefg", "bcdefg", "abcddefg"]))
    names = sorted(["abcdefg", "abcdefgh", "abcdxfg", "zbcdefg", "bcdefg", "abcddefg"])
    found = set()
    for forward in (True, False):
        for change in (-1, 0, 1):
            q, w = index.near(["abcdefg"], np.array([change]), forward)
            found |= {(change, names[k]) for k in w.tolist()}
    assert found == {(1, "abcdefgh"), (1, "abcddefg"), (0, "abcdxfg"), (0, "zbcdefg"), (-1, "bcdefg")}


def test_word_counts_and_edges(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice(["Straßenbahn", "straßenbahn9Café", "ÀÖwords×÷", "shorter", "tooshort-x", "ABCDEFGH"])
                         for _ in range(20)), None) for k in range(200)] + [(None, "shorter shorter", "x"), (5, None, "x"),
                                                                           (6, "", "x")]
    want = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for k, text, _ in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(lower)
            h = zlib.crc32(f"{'' if k is None else k}:{w}".encode())
            w = w[:h % len(w)] + w[h % len(w) + 1:] if h % 31 == 0 else w
            want[w] += len(w) >= 7
    docs = spark.createDataFrame(rows, DOC).withColumn("word", F.lit(1)).withColumn("n", F.lit("x"))
    got = {r["word"]: r["n"] for r in variants.word_counts(docs).collect()}
    assert got == {w: n for w, n in want.items() if n >= 2}
    assert variants.spelling_groups(variants.word_counts(spark.createDataFrame([], DOC))).collect() == []
