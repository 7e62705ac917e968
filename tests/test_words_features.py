import math

import pytest
from pyspark.sql import functions as F

from lexmill.functions.text import clean_words, feature_terms
from lexmill.operators import corpus, features, neighbours, ordered, words


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id long, feature string")


def result(df, name="feature"):
    return [r[name] for r in df.orderBy("id").collect()]


@pytest.fixture(scope="module")
def vocab(spark):
    return spark.createDataFrame([(w,) for w in ("good", "day", "bad", "night", "be", "fore", "x" * 21, "a" * 12, "b" * 12)],
                                 "word string")


def test_repair(spark, vocab):
    df = texts(spark, "good dya night", "goodday", "before", "xgood", "x" * 21, "a" * 12 + "b" * 12, "")
    out = words.repair_words(df, "id", clean_words(F.col("feature")), vocab, 20)
    assert result(out) == ["good night", "good day", "be fore", "", "", "a" * 12 + " " + "b" * 12, ""]


def test_vocabulary_filters(spark, vocab):
    df = texts(spark, "good dya night good", "", "zzz")
    t = clean_words(F.col("feature"))
    assert result(words.keep_vocabulary(df, "id", t, vocab)) == ["good night good", "", ""]
    kept, rejected = words.keep_words_with_vector(df, "id", "feature", vocab)
    assert result(kept) == ["good night good", ""] and [r.id for r in rejected.collect()] == [1]
    assert result(words.filter_frequent(df, "id", t, 2)) == ["good good", "", ""]
    cover = words.token_coverage(df, "id", t, vocab).orderBy("id").collect()
    assert [(r.n_tokens, r.n_known) for r in cover] == [(4, 3), (0, 0), (1, 0)]


def test_lemmas(spark):
    lexicon = spark.createDataFrame([(w,) for w in ("cat", "bus", "leaf", "box", "church", "wish", "man", "city", "glass")],
                                    "word string")
    df = texts(spark, "cats buses leaves boxes churches wishes men cities glass dogs")
    out = words.normalize(df, "id", "feature", "lemmatization", lexicon)
    assert result(out) == ["cat bus leaf box church wish man city glass dogs"]
    assert result(words.normalize(df, "id", "feature", "none")) == result(df)
    with pytest.raises(ValueError):
        words.normalize(df, "id", "feature", "lemmatization")


# Word pairs published with the algorithm, and pairs for the later additions.
STEMS = """caresses caress ponies poni ties tie caress caress cats cat feed feed agreed agre plastered plaster
bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall
hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat conditional condit
rational ration valenci valenc digitizer digit conformabli conform radicalli radic differentli differ vileli vile
analogousli analog vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis
hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic
formative form formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv
allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant irrit
replacement replac adjustment adjust dependent depend adoption adopt homologou homolog communism commun activate activ
angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas
controll control roll roll flies fli dies die spied spi died die enjoy enjoy news news is is""".split()


def test_stems(spark):
    pairs = dict(zip(STEMS[::2], STEMS[1::2]))
    vocab = spark.createDataFrame([(w,) for w in pairs], "word string")
    got = {r["word"]: r["new_word"] for r in words.stem_table(vocab).collect()}
    assert {w: (got[w], s) for w, s in pairs.items() if got[w] != s} == {}
    df = texts(spark, "hopping cats", "")
    assert result(words.normalize(df, "id", "feature", "stemming")) == ["hop cat", ""]


def test_tfidf(spark):
    df = texts(spark, "good day good", "bad day", "good night a")
    t = feature_terms(F.col("feature"))
    idf = features.fit_idf(df, t)
    table = {r["term"]: round(r["idf"], 6) for r in idf.collect()}
    assert table == {"bad": 1.693147, "day": 1.287682, "good": 1.287682, "night": 1.693147}
    got = {(r["id"], r["term"]): round(r["weight"], 6) for r in features.tfidf(df, "id", t, idf).collect()}
    assert got == {(0, "day"): 0.447214, (0, "good"): 0.894427, (1, "bad"): 0.795961, (1, "day"): 0.605349,
                   (2, "good"): 0.605349, (2, "night"): 0.795961}
    packed = features.tfidf_rows(texts(spark, "zzz", None, "good"), "id", t, idf).orderBy("id").collect()
    assert [len(r["terms"]) for r in packed] == [0, 0, 1]
    assert {r["term"] for r in features.fit_idf(df, t, 2).collect()} == {"good", "day"}


def test_ml_vectors_equal_table(spark):
    from lexmill.operators.models import fit_text_vectors

    df = texts(spark, "good day good", "bad day", "good night a").withColumn("tokens", feature_terms(F.col("feature")))
    model = fit_text_vectors(df)
    names = model.stages[0].vocabulary
    rows = model.transform(df).select("id", "features").collect()
    got = {(r["id"], names[i]): round(v, 6) for r in rows for i, v in zip(r["features"].indices, r["features"].values)}
    table = features.tfidf(df, "id", F.col("tokens"), features.fit_idf(df, F.col("tokens")))
    assert got == {(r["id"], r["term"]): round(r["weight"], 6) for r in table.collect()}


def test_vectors(spark):
    v = spark.createDataFrame([("good", [1.0, 0.0]), ("day", [0.0, 1.0]), ("bad", [-1.0, 0.0])],
                              "word string, vec array<float>")
    df = texts(spark, "good day xyz", "xyz", "", "good good day")
    t = clean_words(F.col("feature"))
    means = result(features.mean_vector(df, "id", t, v, 2), "vec")
    assert means[:3] == [[0.5, 0.5], [0.0, 0.0], [0.0, 0.0]]
    assert means[3] == pytest.approx([2 / 3, 1 / 3])
    places = features.vector_sequence(texts(spark, "Good xyz", "day day day day bad"), "id", t, v, 2, 3)
    assert result(features.pack_sequence(places, "id"), "sequence") == [
        [[1.0, 0.0], [0.0, 0.0], [0.0, 0.0]], [[0.0, 1.0]] * 3]


def test_word_ids(spark):
    df = texts(spark, "good day good bad", "bad day good", "zzz yyy", "")
    t = clean_words(F.col("feature"))
    counts = corpus.vocabulary(texts(spark, "good day good bad", "bad day good"), t)
    index = features.word_index(counts)
    assert {r["word"]: r["word_id"] for r in index.collect()} == {"good": 1, "bad": 2, "day": 3}
    ids = features.token_ids(df, "id", t, index)
    assert result(ids, "ids") == [[1, 3, 1, 2], [2, 3, 1], [], []]
    assert result(features.pad_ids(ids, length=3), "ids") == [[3, 1, 2], [2, 3, 1], [0, 0, 0], [0, 0, 0]]
    assert result(features.pad_ids(ids, length=3, truncating="post"), "ids")[0] == [1, 3, 1]
    v = spark.createDataFrame([("bad", [2.0])], "word string, vec array<float>")
    matrix = features.embedding_matrix(index, v, 1).orderBy("word_id").collect()
    assert [r["vec"] for r in matrix] == [[0.0], [0.0], [2.0], [0.0]]


def test_subwords(spark, folder):
    public = pytest.importorskip("public_tokenizers")
    import base64

    import tiktoken
    path = public.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(path, "rb"))}
    coder = tiktoken.Encoding("t", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    df = texts(spark, "hello there, world", None, " ", "a " * 100)
    out = features.subword_encode(df, "id", "feature", path, public.PATTERN, 16).orderBy("id").collect()
    for row, raw in zip(out, ["hello there, world", "", "", "a " * 100]):
        ids = coder.encode_ordinary(raw)[:16]
        assert row["input_ids"] == ids + [0] * (16 - len(ids))
        assert row["attention_mask"] == [1] * len(ids) + [0] * (16 - len(ids))


@pytest.mark.parametrize("block", [3, 100])
def test_neighbours_against_brute_force(spark, block):
    import numpy as np

    rng = np.random.default_rng(1)
    m = rng.normal(size=(25, 4))
    m[7] = m[3] * 2  # equal direction: the smaller id wins for everyone else
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "i long, v array<double>")
    got = {r["i"]: (r["neighbour"], round(r["similarity"], 9))
           for r in neighbours.nearest_neighbours(df, df, "i", "v", block_rows=block).collect()}
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    scores = np.round(unit @ unit.T, 12)
    np.fill_diagonal(scores, -9)
    assert got == {i: (int(scores[i].argmax()), round(float(scores[i].max()), 9)) for i in range(25)}
    few = neighbours.nearest_neighbours(df, df, "i", "v", min_similarity=0.99, block_rows=block)
    assert {r["i"] for r in few.collect()} >= {3, 7} and few.count() < 25


def test_running_totals(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    out = ordered.running_totals(df, [F.desc("k")], {"upto": F.col("k")}, slices=5)
    want = {k: sum(range(k, 1000)) for k in range(1000)}
    assert {r["k"]: r["upto"] for r in out.collect()} == want
    assert ordered.global_rank(df, [F.col("k")]).where(F.col("rank") != F.col("k") + 1).isEmpty()


def test_corpus(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 3, 4)], "v double")
    row = corpus.describe_by(df.withColumn("g", F.lit(1)), "v", "g").first()
    assert (row["mean"], row["p25"], row["p50"], row["max"]) == (2.0, 1.0, 2.0, 4.0)
    assert row["std"] == pytest.approx(math.sqrt(2.5))
    assert [r["n"] for r in corpus.histogram(df, "v", 2).orderBy("bin").collect()] == [2, 3]
    same = spark.createDataFrame([(5.0,)] * 3, "v double")
    assert [r["n"] for r in corpus.histogram(same, "v", 2).orderBy("bin").collect()] == [3, 0]
    assert corpus.covering_length(df, "v").first()[0] == 3
    curve = corpus.density_curve(df, "v", 50).orderBy("point").collect()
    assert curve[0]["x"] == 0.0 and curve[-1]["x"] == 4.0
    assert curve[24]["density"] > curve[0]["density"]
    t = texts(spark, "a b a", "a c")
    size = corpus.vocabulary_size(t, clean_words(F.col("feature")), approximate=True).first()[0]
    assert size == 3
