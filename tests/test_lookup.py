from pyspark.sql import functions as F

from lexmill.functions.text import clean_words
from lexmill.operators import features, words


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def tokens():
    return clean_words(F.col("feature"))


def rows(spark):
    return spark.createDataFrame([(1, "a b a c"), (2, ""), (3, None), (4, "c zz")], "id long, feature string")


def test_translated_words_meet_the_table_once_a_part(spark):
    table = spark.createDataFrame([("a", "x"), ("c", "y z"), ("b", None)], "word string, new_word string")
    for keep, expected in ((True, ["x b x y z", "", "", "y z zz"]), (False, ["x x y z", "", "", "y z"])):
        out = words.translate_words(rows(spark), "id", tokens(), table, keep)
        assert "posexplode" not in plan(out)
        assert [r.feature for r in out.orderBy("id").collect()] == expected


def test_word_ids_meet_the_index_once_a_part(spark):
    index = spark.createDataFrame([("a", 7), ("b", 8)], "word string, word_id long")
    out = features.token_ids(rows(spark), "id", tokens(), index)
    assert "posexplode" not in plan(out)
    assert [r.ids for r in out.orderBy("id").collect()] == [[7, 8, 7], [], [], []]


def test_rows_of_one_id_and_null_ids_share_a_text(spark):
    table = spark.createDataFrame([("a", "x")], "word string, new_word string")
    df = spark.createDataFrame([(1, "a b"), (1, "c d"), (None, "a"), (None, "e")], "id long, feature string")
    out = {r.id: r.feature for r in words.translate_words(df, "id", tokens(), table, True).collect()}
    assert sorted(out[1].split()[:2]) == ["c", "x"] and sorted(out[1].split()[2:]) == ["b", "d"]
    assert sorted(out[None].split()) == ["e", "x"] and len(out) == 2


def test_vectors_go_to_parts_and_not_to_each_word(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("c", [4.0, 2.0])], "word string, vec array<float>")
    out = features.mean_vector(rows(spark), "id", tokens(), vectors, 2)
    assert "Summarizer" not in plan(out) and "FlatMapCoGroupsInArrow" in plan(out)
    assert [r.vec for r in out.orderBy("id").collect()] == [[2.0, 2.0 / 3], [0.0, 0.0], [0.0, 0.0], [4.0, 2.0]]


def test_tfidf_counts_inside_the_parts(spark):
    idf = spark.createDataFrame([("a", 1, 1.5), ("c", 2, 1.0)], "term string, df long, idf double")
    out = features.tfidf(rows(spark), "id", tokens(), idf)
    assert "FlatMapCoGroupsInArrow" in plan(out)
    found = {(r.id, r.term): round(r.weight, 9) for r in out.collect()}
    assert found == {(1, "a"): round(3 / 10 ** 0.5, 9), (1, "c"): round(1 / 10 ** 0.5, 9), (4, "c"): 1.0}


def test_subwords_are_cut_text_by_text(spark, tmp_path):
    import base64

    ranks = tmp_path / "ranks"
    ranks.write_text("\n".join(f"{base64.b64encode(bytes([k])).decode()} {k}" for k in range(256)))
    df = spark.range(700).select("id", F.concat(F.lit("w"), F.col("id").cast("string")).alias("feature"))
    out = features.subword_encode(df, "id", "feature", str(ranks), r"\S+|\s+", 4, 0)
    assert "MapInArrow" in plan(out)
    got = {r.id: (r.input_ids, r.attention_mask) for r in out.collect()}
    assert len(got) == 700 and got[5] == ([119, 53, 0, 0], [1, 1, 0, 0]) and got[699][0] == [119, 54, 57, 57]
